"""Scans, joins, rankings and reports that the marketplace jobs are made of."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def scan(df: DataFrame, where: Column | str | None = None, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows that meet a condition, and of them the named columns; both reach the Parquet scan."""
    df = df if where is None else df.where(where)
    return df if columns is None else df.select(*columns)


def keyset_page(df: DataFrame, key: str, after: int, n: int) -> DataFrame:
    """The next ``n`` rows by ``key`` after a key."""
    return df.where(F.col(key) > after).orderBy(key).limit(n)


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, greatest by ``order`` (nulls least); one aggregation, no sort of groups. Null keys form a group."""
    rest = [c for c in df.columns if c not in keys]
    ranked = [*order, *(c for c in rest if c not in order)]
    best = df.groupBy(*keys).agg(F.max(F.struct(*ranked)).alias("_r"))
    return best.select(*keys, *[F.col("_r").getField(c).alias(c) for c in rest])


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, least by ``order`` (nulls first)."""
    rest = [c for c in df.columns if c not in keys]
    ranked = [*order, *(c for c in rest if c not in order)]
    best = df.groupBy(*keys).agg(F.min(F.struct(*ranked)).alias("_r"))
    return best.select(*keys, *[F.col("_r").getField(c).alias(c) for c in rest])


def decode(df: DataFrame, dim: DataFrame, on: str, value: str, order: str, default: Column | None = None) -> DataFrame:
    """``df`` with ``value`` looked up in ``dim`` by ``on``: the first entry by ``order`` counts; unknown keys get ``default``."""
    first = first_per_key(dim.select(on, value, *([order] if order != value else [])), [on], [order]).select(on, value)
    out = df.join(first, on, "left")
    return out if default is None else out.withColumn(value, F.coalesce(value, default))


def range_label(df: DataFrame, key: str, ranges: DataFrame, width: int = 256) -> DataFrame:
    """``df`` with the ``label`` of the range its key lies in (both ends inclusive), of several the one of highest ``ordinal``; null outside all.

    An equality join on key buckets of ``width``; the ranges, not the rows, are multiplied.
    """
    spread = ranges.select(
        "lo", "hi", "label", "ordinal", F.explode(F.sequence(F.floor(F.col("lo") / width), F.floor(F.col("hi") / width))).alias("_b")
    ).where("lo <= hi")
    keys = df.select(key).where(F.col(key).isNotNull()).distinct().withColumn("_b", F.floor(F.col(key) / width))
    met = keys.join(spread, "_b").where(F.col(key).between(F.col("lo"), F.col("hi")))
    best = met.groupBy(key).agg(F.max_by("label", "ordinal").alias("label"))
    return df.join(best, key, "left")


def merge_by(left: DataFrame, right: DataFrame, on: Sequence[str], how: str) -> DataFrame:
    """A keyed merge in which same-named columns of ``right`` overwrite those of ``left`` wherever ``right`` has the key.

    ``how``: left, right, inner, full or anti (of left). Both sides should have unique keys.
    """
    if how == "anti":
        return left.join(right.select(*on).distinct(), list(on), "left_anti")
    l, r = left.alias("l"), right.withColumn("_in", F.lit(True)).alias("r")  # noqa: E741
    joined = l.join(r, [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in on], {"full": "full"}.get(how, how))
    columns = [F.coalesce(f"l.{k}", f"r.{k}").alias(k) for k in on]
    for c in dict.fromkeys([*left.columns, *right.columns]):
        if c not in on:
            if c in left.columns and c in right.columns:
                columns.append(F.when(F.col("r._in"), F.col(f"r.{c}")).otherwise(F.col(f"l.{c}")).alias(c))
            else:
                columns.append(F.col(f"l.{c}" if c in left.columns else f"r.{c}"))
    return joined.select(*columns)


def daily_counts(df: DataFrame, ts: str, first: str, last: str) -> DataFrame:
    """``day, n`` for every day from ``first`` to ``last``, days without rows included."""
    days = df.sparkSession.range(1).select(F.explode(F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))).alias("day"))
    counts = df.groupBy(F.to_date(ts).alias("day")).agg(F.count(F.lit(1)).alias("n"))
    return days.join(counts, "day", "left").na.fill(0, ["n"])


def conditional_counts(df: DataFrame, keys: Sequence[str], column: str, values: Sequence[object], prefix: str) -> DataFrame:
    """One row per key with a count for each of the listed values: a pivot in one aggregation, without a pass for the values."""
    return df.groupBy(*keys).agg(*[F.count_if(F.col(column) == v).alias(f"{prefix}{v}") for v in values])


def top_k(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, rank: str = "rank") -> DataFrame:
    """The first ``k`` rows of each group; the partial limit runs before the shuffle."""
    ranked = df.withColumn(rank, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col(rank) <= k).withColumn(rank, F.col(rank).cast("bigint"))


def capped_top_k(df: DataFrame, key: str, group: str, order: Sequence[Column], cap: int, k: int) -> DataFrame:
    """The first ``k`` rows of each key, no more than ``cap`` of any group: the greedy list, for a skipped row never frees a place."""
    return top_k(top_k(df, [key, group], order, cap, "_g").drop("_g"), [key], order, k)


def tiered_fill(df: DataFrame, key: str, group: str, tier: str, order: Sequence[Column], tier_k: int, cap: int, k: int) -> DataFrame:
    """Lower tiers first: the best ``tier_k`` of each tier, then the list filled tier by tier under a cap per group that all tiers share."""
    best = top_k(df, [key, tier], order, tier_k, "_t").drop("_t")
    return capped_top_k(best, key, group, [F.col(tier).asc(), *order], cap, k)


def round_robin(df: DataFrame, order: Sequence[str], n: int, buckets: int = 64) -> DataFrame:
    """``df`` with ``index`` (0, 1, ... by ``order``) and ``part`` = index modulo ``n``, without sorting everything in one task.

    Rows are numbered inside ranges of the first order column, and the ranges' sizes are added up.
    """
    head = order[0]
    edges = df.agg(F.percentile_approx(head, [i / buckets for i in range(1, buckets)]).alias("e")).first()["e"] or []
    bucket = F.aggregate(F.array(*[F.lit(e) for e in sorted(set(edges))]), F.lit(0), lambda a, e: a + (F.col(head) > e).cast("int")) if edges else F.lit(0)
    df = df.withColumn("_b", bucket)
    sizes = df.groupBy("_b").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)  # one row a bucket
    starts = sizes.select("_b", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_s"))
    inside = F.row_number().over(Window.partitionBy("_b").orderBy(*order)) - 1
    out = df.join(F.broadcast(starts), "_b").withColumn("index", (F.col("_s") + inside).cast("bigint"))
    return out.withColumn("part", F.pmod("index", F.lit(n))).drop("_b", "_s")


def dense_index(df: DataFrame, key: str) -> DataFrame:
    """``key, index``: the distinct keys numbered from 1 in their order."""
    return round_robin(df.select(key).where(F.col(key).isNotNull()).distinct(), [key], 1).select(key, (F.col("index") + 1).alias("index"))


def dense_text_index(df: DataFrame, key: str) -> DataFrame:
    """``key, index``: the distinct texts numbered from 1 in their order, by ranges of their first seven bytes."""
    first = F.coalesce(F.conv(F.rpad(F.hex(F.substring(key, 1, 7)), 14, "0"), 16, 10).cast("bigint"), F.lit(0))  # keeps the order of the text
    keys = df.select(key).where(F.col(key).isNotNull()).distinct().withColumn("_h", first)
    return round_robin(keys, ["_h", key], 1).select(key, (F.col("index") + 1).alias("index"))


def interleaved(parts: Sequence[DataFrame], key: str) -> DataFrame:
    """Rows of several sorted inputs in the order of a key; of equal keys the first input's come first."""
    out = None
    for i, part in enumerate(parts):
        part = part.withColumn("_i", F.lit(i))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out.orderBy(key, "_i").drop("_i")
