"""Problem 2: how often items occur together, and how much more often than chance.

Large-basket blocking. Ordinary baskets yield their pairs inside one task. A huge basket is split into item chunks by
item hash; its chunk pairs are distributed across tasks, each of which multiplies two bounded chunks. Both sorts of
products are counted in the task that makes them, by dictionary codes, and only partial counts are shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlens.session import written

CHUNK = 256
"""Items of a chunk; a basket with more items is split."""
SALTS = 16
"""Keys under which the items of a huge basket are looked up."""
FLUSH_PAIRS = 1 << 21
"""Partial counts a task holds before it emits them."""
NO_SKILL = ("", "na", "null", "none")  # fixed values: entries that name no skill
_PAIRS = "item_a string, item_b string, n bigint"


def skill_list(c: Column) -> Column:
    """The distinct skills named in one string: split at comma, semicolon or bar; lower case, single spaces for hyphens and blanks."""
    part = F.split(F.lower(c), "[,;|]")
    clean = F.transform(part, lambda x: F.trim(F.regexp_replace(x, r"[\s\p{Z}\x{85}\x{200B}-]+", " ")))
    return F.array_distinct(F.filter(clean, lambda x: ~x.isin(*NO_SKILL)))


class _Counter:
    """Pairs of the batches so far, as codes into a growing dictionary, with their counts."""

    def __init__(self) -> None:
        self.codes: dict[str, int] = {}
        self.pairs, self.counts = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def encode(self, values: pa.Array) -> np.ndarray:
        encoded = values.dictionary_encode()
        known = np.fromiter((self.codes.setdefault(x, len(self.codes)) for x in encoded.dictionary.to_pylist()), np.int64, len(encoded.dictionary))
        return known[encoded.indices.to_numpy(zero_copy_only=False)] if len(known) else np.zeros(0, np.int64)

    def add(self, left: np.ndarray, right: np.ndarray) -> None:
        pairs, counts = np.unique(np.minimum(left, right) << 32 | np.maximum(left, right), return_counts=True)
        together, place = np.unique(np.concatenate([self.pairs, pairs]), return_inverse=True)
        sums = np.zeros(len(together), np.int64)
        np.add.at(sums, place, np.concatenate([self.counts, counts]))
        self.pairs, self.counts = together, sums

    def drain(self) -> Iterator[pa.RecordBatch]:
        names = pa.array(list(self.codes), pa.string())
        for i in range(0, len(self.pairs), 1 << 16):
            x, y = (names.take(pa.array(p)) for p in (self.pairs[i : i + (1 << 16)] >> 32, self.pairs[i : i + (1 << 16)] & 0xFFFFFFFF))
            swap = pa.compute.greater(x, y)
            yield pa.RecordBatch.from_arrays(
                [pa.compute.if_else(swap, y, x), pa.compute.if_else(swap, x, y), pa.array(self.counts[i : i + (1 << 16)])], ["item_a", "item_b", "n"]
            )
        self.__init__()


def _within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs inside each list of at most CHUNK items."""
    counter = _Counter()
    for batch in batches:
        lists = batch.column(0)
        codes, sizes = counter.encode(lists.flatten()), lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        starts = np.cumsum(sizes) - sizes
        for size in np.unique(sizes):
            if size > 1:
                i, j = np.triu_indices(size, 1)
                at = starts[sizes == size]
                step = max(1, (1 << 21) // len(i))
                for k in range(0, len(at), step):
                    part = at[k : k + step, None]
                    counter.add(codes[part + i].ravel(), codes[part + j].ravel())
                    if len(counter.pairs) > FLUSH_PAIRS:
                        kept = dict(counter.codes)
                        yield from counter.drain()
                        counter.codes = kept
        if len(counter.pairs) > FLUSH_PAIRS // 2 or len(counter.codes) > FLUSH_PAIRS:
            yield from counter.drain()
    yield from counter.drain()


def _across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs between the two lists of each row."""
    counter = _Counter()
    for batch in batches:
        for row in range(batch.num_rows):
            left, right = (counter.encode(batch.column(k)[row].values) for k in (0, 1))
            counter.add(np.repeat(left, len(right)), np.tile(right, len(left)))
            if len(counter.pairs) > FLUSH_PAIRS // 2:
                yield from counter.drain()
    yield from counter.drain()


def item_rows(df: DataFrame, basket: str, items: Column) -> DataFrame:
    """Distinct ``basket, item``: a basket's items are the union over its rows; null baskets, lists and items are left out."""
    return (
        df.select(F.col(basket).alias("basket"), F.explode(items).alias("item"))
        .where(F.col("basket").isNotNull() & F.col("item").isNotNull())
        .distinct()
    )


def pair_counts(items: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """``item_a, item_b, n_ab`` with item_a < item_b, over distinct ``basket, item`` rows; every pair, however rare."""
    tall = items.groupBy("basket").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > chunk).withColumn("_k", F.ceil(F.col("_n") / chunk).cast("int"))
    huge = written(tall.drop("_n"), "huge")
    ordinary = items.join(huge, "basket", "left_anti").groupBy("basket").agg(F.collect_list("item").alias("items"))
    # rows of a huge basket stay where they are read if the huge baskets are few; else they meet their size under one of SALTS keys
    salted = huge.withColumn("_s", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    chunks = (
        items.withColumn("_s", F.pmod(F.xxhash64("item"), F.lit(SALTS)).cast("int"))
        .join(salted, ["basket", "_s"])
        .withColumn("_c", F.pmod(F.xxhash64("item", F.lit(1)), F.col("_k")).cast("int"))
        .groupBy("basket", "_k", "_c")
        .agg(F.collect_list("item").alias("items"))
    )
    # every chunk goes to each chunk pair it is part of; a pair's two chunks meet in one bounded row
    met = (
        chunks.withColumn("_o", F.explode(F.sequence(F.lit(0), F.col("_k") - 1)))
        .where("_o <> _c")
        .groupBy("basket", F.least("_c", "_o").alias("_lo"), F.greatest("_c", "_o").alias("_hi"))
        .agg(F.max(F.when(F.col("_c") < F.col("_o"), F.col("items"))).alias("x"), F.max(F.when(F.col("_c") > F.col("_o"), F.col("items"))).alias("y"))
        .where("x IS NOT NULL AND y IS NOT NULL")
    )
    parts = (
        ordinary.select("items").unionByName(chunks.select("items")).mapInArrow(_within, _PAIRS)
        .unionByName(met.select("x", "y").mapInArrow(_across, _PAIRS))
    )
    return parts.groupBy("item_a", "item_b").agg(F.sum("n").alias("n_ab"))


def associations(df: DataFrame, basket: str, items: Column, chunk: int = CHUNK) -> DataFrame:
    """``item_a, item_b, n_a, n_b, n_ab, n_baskets, ratio`` for every pair that occurs together.

    ``ratio`` = n_ab x n_baskets / (n_a x n_b), what chance would give being 1; ``n_baskets`` counts baskets with at
    least one item. A basket's repeated items count once; a null or empty list adds nothing; no pairs, no rows.
    """
    rows = written(item_rows(df, basket, items), "items")
    counts = rows.groupBy("item").agg(F.count(F.lit(1)).alias("n"))
    total = rows.agg(F.count_distinct("basket").alias("n")).scalar()
    a, b = (counts.select(F.col("item").alias(f"item_{x}"), F.col("n").alias(f"n_{x}")) for x in "ab")
    return (
        pair_counts(rows, chunk)
        .join(a, "item_a")
        .join(b, "item_b")
        .withColumn("n_baskets", total)
        .select("item_a", "item_b", "n_a", "n_b", "n_ab", "n_baskets", (F.col("n_ab") * F.col("n_baskets") / (F.col("n_a") * F.col("n_b"))).alias("ratio"))
    )
