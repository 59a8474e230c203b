"""Problem 8: a mixture of sources by target weights.

Weighted fair queueing. The documents of a source are shuffled by hash and given virtual finish times: cumulative
tokens of the source over its weight, going on through as many passes as the source may repeat. All copies that can come
before the cut are range-sorted by finish time, and the order is cut where the token budget is spent. Prefix sums are
taken in two levels, over hash ranges and then inside each, so that no source is handled by one task; the cut is found
by halving ever shorter stretches of the queue, so that no task sorts more than a bounded part of it.
"""

from __future__ import annotations

import math
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlens.session import spread, written

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.json"
ROWS_PER_BUCKET = 50_000
MOST_TARGETS = 100_000
STRETCHES = 1024
"""Stretches a part of the queue is cut into when the cut is looked for."""
_ORDER = ("finish", "source", "doc_id", "pass")


def source_key(c: Column) -> Column:
    """A source name without case and outer blanks, with hyphen, blank and underscore alike; null where blank."""
    key = F.regexp_replace(F.trim(F.regexp_replace(F.lower(c), r"[\s\p{Z}_-]+", " ")), " ", "_")
    return F.when(key != "", key)


def token_counts(docs: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """``doc_id, source, tokens`` of every document; a null or empty text has 0 tokens, special tokens in it are ordinary text."""

    def count(batches):  # noqa: ANN001, ANN202
        from tokenizers import Tokenizer

        tok = Tokenizer.from_str(Path(tokenizer).read_text(encoding="utf-8"))
        tok.encode_special_tokens = True
        tok.no_truncation()
        for batch in batches:
            sizes: list[int] = []
            texts = batch.column(2).to_pylist()
            for i in range(0, len(texts), 256):
                sizes += [len(x.ids) for x in tok.encode_batch_fast([t or "" for t in texts[i : i + 256]], add_special_tokens=False)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sizes, pa.int64())], ["doc_id", "source", "tokens"])

    return spread(docs.select("doc_id", source_key(F.col("source")).alias("source"), "text")).mapInArrow(count, "doc_id bigint, source string, tokens bigint")


def _horizon(plan: list, budget: int) -> float:
    """A virtual time by which the queue has surely given out ``budget`` tokens; infinite if it never does.

    By time t a source has given at least min(all its copies, weight x t) less one document.
    """
    lacking = budget + sum(r["largest"] for r in plan)
    ends = sorted((r["max_repeats"] * r["size_tokens"] / r["target_share"], r["max_repeats"] * r["size_tokens"], r["target_share"]) for r in plan)
    weight, spent = sum(share for _, _, share in ends), 0
    for end, most, share in ends:  # sources run dry one after the other
        if spent + weight * end >= lacking:
            return (lacking - spent) / weight
        weight, spent = weight - share, spent + most
    return math.inf


def _first_beyond(queue: DataFrame, budget: int, most: int = ROWS_PER_BUCKET) -> tuple | None:
    """The first copy of ``queue`` at which the tokens so far pass ``budget``, as its values of _ORDER; null if none.

    Copies without tokens can't be it. The rest is counted in stretches of finish time, and the one that holds the cut in
    stretches again, until it is short, or of a single moment, when each source has only one copy in it.
    """
    part, before = queue.where("tokens > 0").select(*_ORDER, "tokens"), 0
    found = part.agg(F.min("finish").alias("low"), F.max("finish").alias("high"), F.sum("tokens").alias("t"), F.count(F.lit(1)).alias("n")).first()
    if (found["t"] or 0) <= budget:
        return None
    while found["n"] > most and found["low"] < found["high"]:
        width = (found["high"] - found["low"]) / STRETCHES
        stretch = F.least(F.floor((F.col("finish") - F.lit(found["low"])) / F.lit(width)), F.lit(STRETCHES - 1)) if width > 0 else F.when(F.col("finish") > found["low"], 1).otherwise(0)
        counted = part.groupBy(stretch.alias("s")).agg(F.min("finish").alias("low"), F.max("finish").alias("high"), F.sum("tokens").alias("t"), F.count(F.lit(1)).alias("n"))
        for row in sorted(counted.collect(), key=lambda r: r["s"]):  # at most STRETCHES rows
            if before + row["t"] > budget:
                break
            before += row["t"]
        found, part = row, part.where(F.col("finish").between(row["low"], row["high"]))
    upto = F.lit(before) + F.sum("tokens").over(Window.orderBy(*_ORDER).rowsBetween(Window.unboundedPreceding, 0))
    first = part.withColumn("_upto", upto).where(F.col("_upto") > budget).orderBy(*_ORDER).select(*_ORDER).first()
    return tuple(first)


def weighted_mix(sizes: DataFrame, targets: DataFrame, budget: int | None = None, seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """The mixture ``doc_id, source, pass, tokens, finish`` and its report, one row per target.

    ``sizes``: ``doc_id, source, tokens`` (source as of ``source_key``); it is read several times, so give a written
    table. ``targets``: ``source, target_share, max_repeats``; rows with a null source, or a share that is null or
    not above 0, ask for nothing and are left out; a null max_repeats is 1, and with one of 0 or less a source gives no
    copies and can't reach its share. ``budget``: tokens of the mixture, by default those of all of ``sizes``, sources
    without target included. Equal finish times are ordered by source, document, pass. Where a source runs dry
    the others take its place in proportion to their weights.

    Report: ``source, target_share, max_repeats, size_tokens, last_finish, reachable, mixed_tokens, actual_share``.
    A source reaches its share if the queue still holds copies of it, or the end of its last, at the moment when a queue
    that never runs dry has given out ``budget``: that is virtual time ``budget``. ``last_finish`` is the finish of
    its last copy in the queue, which holds no copies that surely come after the cut; null where it has none.
    """
    spark, sizes = sizes.sparkSession, sizes.select("doc_id", "source", "tokens")
    wanted = (
        targets.select(source_key(F.col("source")).alias("source"), F.col("target_share").cast("double").alias("target_share"), F.greatest(F.coalesce("max_repeats", F.lit(1)), F.lit(0)).cast("int").alias("max_repeats"))
        .where("source IS NOT NULL AND target_share > 0")
        .groupBy("source")
        .agg(F.sum("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats"))
    )
    by_source = sizes.groupBy("source").agg(F.sum("tokens").alias("size_tokens"), F.max("tokens").alias("largest"))
    # one row per target: as many as somebody wrote down by hand
    plan = wanted.join(by_source, "source", "left").na.fill(0, ["size_tokens", "largest"]).limit(MOST_TARGETS + 1).collect()
    if len(plan) > MOST_TARGETS:
        raise ValueError("more targets than a report can hold")
    whole = sizes.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("t"), F.count(F.lit(1)).alias("n")).first()
    budget = int(whole["t"]) if budget is None else budget
    horizon = max(_horizon(plan, budget), float(budget))
    report = spark.createDataFrame([tuple(r) for r in plan], "source string, target_share double, max_repeats int, size_tokens bigint, largest bigint")
    buckets = 1 << max(4, math.ceil(math.log2(max(1, whole["n"]) / ROWS_PER_BUCKET + 1)))

    shuffled = (
        sizes.join(F.broadcast(report), "source")  # at most MOST_TARGETS rows
        .withColumn("_h", F.conv(F.substring(F.md5(F.concat_ws(":", "doc_id", F.lit(seed))), 1, 15), 16, 10).cast("bigint"))
        .withColumn("_b", F.shiftright("_h", 60 - int(math.log2(buckets))))
    )
    starts = shuffled.groupBy("source", "_b").agg(F.sum("tokens").alias("_t"))
    before = Window.partitionBy("source").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)  # one row a bucket
    starts = starts.select("source", "_b", F.coalesce(F.sum("_t").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("source", "_b").orderBy("_h", "doc_id", "tokens").rowsBetween(Window.unboundedPreceding, 0)
    once = shuffled.join(starts, ["source", "_b"]).withColumn("_upto", F.col("_start") + F.sum("tokens").over(inside))
    # passes that begin before the horizon, and one document more: the copy at the horizon itself is among them
    room = F.col("target_share") * F.lit(horizon) + F.col("largest") - F.col("_upto")
    passes = F.when((F.col("size_tokens") > 0) & F.lit(math.isfinite(horizon)), F.least(F.col("max_repeats") - 1, F.floor(room / F.col("size_tokens")))).otherwise(F.col("max_repeats") - 1).cast("int")
    copies = (
        once.withColumn("_passes", passes)
        .where("_passes >= 0")
        .select("doc_id", "source", "tokens", "target_share", "size_tokens", "_upto", F.explode(F.sequence(F.lit(0), "_passes")).alias("pass"))
        .withColumn("_work", F.col("pass") * F.col("size_tokens") + F.col("_upto"))
        .select("doc_id", "source", "pass", "tokens", (F.col("_work") / F.col("target_share")).alias("finish"), (F.col("_work") >= F.col("target_share") * F.lit(budget)).alias("_late"))
    )
    queue = written(copies.repartitionByRange(buckets, *_ORDER).sortWithinPartitions(*_ORDER), "queue")
    first = _first_beyond(queue, budget)
    mix = queue
    if first is not None:
        at = [F.lit(v) for v in first]
        beyond = F.lit(False)
        for c, v in reversed(list(zip(_ORDER, at, strict=True))):  # in order at or after the first copy that is left out
            beyond = (F.col(c) > v) | ((F.col(c) == v) & (beyond if c != "pass" else F.col(c) == v))
        mix = queue.where((F.col("finish") <= at[0]) & ~beyond)
    mix = mix.select("doc_id", "source", "pass", "tokens", "finish")
    waiting = queue.groupBy("source").agg(F.max("finish").alias("last_finish"), F.bool_or("_late").alias("reachable"))
    mixed = mix.groupBy("source").agg(F.sum("tokens").alias("mixed_tokens"))
    all_mixed = mix.agg(F.sum("tokens").alias("t")).scalar()
    report = (
        report.join(waiting, "source", "left")
        .join(mixed, "source", "left")
        .na.fill(0, ["mixed_tokens"])
        .na.fill(False, ["reachable"])
        .select("source", "target_share", "max_repeats", "size_tokens", "last_finish", "reachable", "mixed_tokens", F.try_divide(F.col("mixed_tokens"), all_mixed).alias("actual_share"))
    )
    return mix, report
