"""Master and transaction upserts, watermarks and retention."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def update_present(master: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """Values of ``changes`` overwrite the master's where they aren't null; new keys are added; columns are the master's."""
    m, c = master.alias("m"), changes.alias("c")
    rest = [x for x in master.columns if x != key]
    return m.join(c, F.col(f"m.{key}") == F.col(f"c.{key}"), "full").select(
        F.coalesce(f"c.{key}", f"m.{key}").alias(key), *[(F.coalesce(f"c.{x}", f"m.{x}") if x in changes.columns else F.col(f"m.{x}")).alias(x) for x in rest]
    )


def update_all(master: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """Rows of ``changes`` overwrite the master's, with nulls too; new keys are added; columns are the master's."""
    m, c = master.alias("m"), changes.withColumn("_in", F.lit(True)).alias("c")
    rest = [x for x in master.columns if x != key]
    return m.join(c, F.col(f"m.{key}") == F.col(f"c.{key}"), "full").select(
        F.coalesce(f"c.{key}", f"m.{key}").alias(key),
        *[(F.when(F.col("c._in"), F.col(f"c.{x}")).otherwise(F.col(f"m.{x}")) if x in changes.columns else F.col(f"m.{x}")).alias(x) for x in rest],
    )


def replace_by_key(base: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All base rows of the keys in ``new`` give way to the rows of ``new``."""
    return base.join(new.select(*keys).distinct(), list(keys), "left_anti").unionByName(new, allowMissingColumns=True)


def delete_keys(base: DataFrame, gone: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``base`` without the keys in ``gone``; rows with a null key stay."""
    return base.join(gone.select(*keys).distinct(), list(keys), "left_anti")


def append_after(base: DataFrame, feed: DataFrame, key: str, ts: str, horizon: Column) -> DataFrame:
    """``base`` plus the rows of ``feed`` beyond its highest key, without rows older than ``horizon``."""
    high = base.agg(F.coalesce(F.max(key), F.lit(-1)).alias("h")).scalar()
    return base.unionByName(feed.where(F.col(key) > high), allowMissingColumns=True).where(F.col(ts) >= horizon)


def changed_between(df: DataFrame, columns: Sequence[str], start: Column, end: Column) -> DataFrame:
    """Rows any of whose time columns lies in [start, end)."""
    hit = F.lit(False)
    for c in columns:
        hit = hit | F.coalesce((F.col(c) >= start) & (F.col(c) < end), F.lit(False))
    return df.where(hit)


def refresh_edges(edges: DataFrame, changed: DataFrame, new: DataFrame, a: str, b: str, key: str) -> DataFrame:
    """Edges with an end in ``changed`` are dropped and ``new`` ones added."""
    keys = changed.select(key).distinct()
    kept = edges.join(keys.withColumnRenamed(key, a), a, "left_anti").join(keys.withColumnRenamed(key, b), b, "left_anti")
    return kept.select(*edges.columns).unionByName(new)


def half_changed_edges(edges: DataFrame, changed: DataFrame, a: str, b: str, key: str) -> DataFrame:
    """Edges whose first end changed and whose second didn't."""
    keys = changed.select(key).distinct()
    return edges.join(keys.withColumnRenamed(key, a), a, "left_semi").join(keys.withColumnRenamed(key, b), b, "left_anti").select(*edges.columns)


def fill_from(df: DataFrame, other: DataFrame, on: str, column: str) -> DataFrame:
    """Missing values of ``column`` filled from ``other`` by ``on``: there the least value counts."""
    known = other.where(F.col(column).isNotNull()).groupBy(on).agg(F.min(column).alias("_v"))
    return df.join(known, on, "left").withColumn(column, F.coalesce(column, "_v")).drop("_v")


def add_up(old: DataFrame, new: DataFrame, key: str, measures: Sequence[str]) -> DataFrame:
    """Measures of both summed by key; a measure missing on both sides stays null."""
    return old.select(key, *measures).unionByName(new.select(key, *measures)).groupBy(key).agg(*[F.sum(m).alias(m) for m in measures])


def reconcile(base: DataFrame, result: DataFrame, key: str) -> DataFrame:
    """One row: keys kept, added and removed between two states."""
    b, r = base.select(F.col(key).alias("k")).distinct().withColumn("b", F.lit(1)), result.select(F.col(key).alias("k")).distinct().withColumn("r", F.lit(1))
    return b.join(r, "k", "full").agg(
        F.count_if(F.col("b").isNotNull() & F.col("r").isNotNull()).alias("kept"), F.count_if(F.col("b").isNull()).alias("added"), F.count_if(F.col("r").isNull()).alias("removed")
    )


def retained(df: DataFrame, ts: str, asof: Column, short: int, long: int, mark: str) -> DataFrame:
    """Rows of the last ``long`` days before ``asof``, those of the last ``short`` marked; rows without a date, or from the future, are not kept."""
    age = F.datediff(asof, F.to_date(ts))
    return df.where((age >= 0) & (age < long)).withColumn(mark, age < short)
