"""Problem 5: the N best items of every group, with a consistent tie rule.

Descending score bands. The score range is cut at quantiles of the scores; the bands are processed from the top. Groups
that N distinct items of the bands so far have filled are anti-joined away before the next, lower and wider band is
touched, so that most rows of big groups are never aggregated or shuffled. A last exact ranking settles ties.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlens.session import written

QUANTILES = (0.95, 0.8, 0.5)


def scored(df: DataFrame, group: Column, item: Column, score: Column, source: str = "", low: int = 0, high: int = 1000) -> DataFrame:
    """``src, group_id, item_id, score`` with a usable score in [low, high], a group, and an item that isn't the group itself."""
    return df.select(F.lit(source).alias("src"), group.cast("bigint").alias("group_id"), item.cast("bigint").alias("item_id"), score.cast("int").alias("score")).where(
        F.col("group_id").isNotNull() & F.col("item_id").isNotNull() & F.col("score").between(low, high) & (F.col("group_id") != F.col("item_id"))
    )


def _best(df: DataFrame, n: int) -> DataFrame:
    """Each item once, with its highest score; of those the first n of each group by score descending, then item."""
    order = Window.partitionBy("src", "group_id").orderBy(F.col("score").desc(), F.col("item_id").asc())
    once = df.groupBy("src", "group_id", "item_id").agg(F.max("score").alias("score"))
    return once.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def top_items(rows: DataFrame, n: int = 10, quantiles: Sequence[float] = QUANTILES) -> DataFrame:
    """``src, group_id, item_id, score, rank``: the first n items of each group of each source by score descending, then item ascending.

    ``rows``: as of ``scored``; several sources may be unioned. All rows of a group are pooled; an item counts once,
    with its highest score; a group with fewer items keeps all. Empty input gives no rows. A band keeps at most n items
    a group: an item ranked lower inside its band has n better ones. Repeats of an item in lower bands can't hurt, for
    they come after as many kept items of higher bands as they could push out.

    The scored rows are written once, in one folder a band, so that every band reads its own rows and no others.
    """
    counts = rows.groupBy("score").agg(F.count(F.lit(1)).alias("c")).collect()  # scores are whole numbers in a stated range
    lows = _edges({r["score"]: r["c"] for r in counts}, quantiles)
    band = F.lit(len(lows))
    for i, low in reversed(list(enumerate(lows))):
        band = F.when(F.col("score") >= low, i).otherwise(band)
    bands = written(rows.withColumn("_band", band.cast("int")), "scored", "_band")
    kept: list[DataFrame] = []
    filled: DataFrame | None = None
    for b in range(len(lows) + 1):
        band_rows = bands.where(F.col("_band") == b).drop("_band")
        if filled is not None:
            band_rows = band_rows.join(filled, ["src", "group_id"], "left_anti")
        best = _best(band_rows, n).drop("rank")
        kept.append(best if b == len(lows) else written(best, "band"))
        if b < len(lows):
            seen = reduce(DataFrame.unionByName, kept).select("src", "group_id", "item_id").distinct()
            filled = seen.groupBy("src", "group_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= n).select("src", "group_id")
    return _best(reduce(DataFrame.unionByName, kept), n)


def _edges(counts: dict[int, int], quantiles: Sequence[float]) -> list[int]:
    """The lowest scores of the upper bands, descending: the scores at the quantiles."""
    total, out = sum(counts.values()), []
    for q in quantiles:
        below = 0
        for score in sorted(counts):
            below += counts[score]
            if below > q * total:
                out.append(score)
                break
    return sorted(set(out), reverse=True)
