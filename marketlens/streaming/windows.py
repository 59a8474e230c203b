"""Windowed counts that run alike on batch and streaming frames, and sinks for them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def tumbling_counts(events: DataFrame, ts: str, kind: str, width: str, late: str | None = None) -> DataFrame:
    """``start, kind, n``: events of each kind in windows of ``width``; with ``late``, rows later than that are dropped and windows closed."""
    if late:
        events = events.withWatermark(ts, late)
    counts = events.groupBy(F.window(ts, width).alias("_w"), F.col(kind).alias("kind")).agg(F.count(F.lit(1)).alias("n"))
    return counts.select(F.col("_w.start").alias("start"), "kind", "n")


def session_counts(events: DataFrame, ts: str, key: str, gap: str, late: str | None = None) -> DataFrame:
    """``key, start, n``: runs of a key's events with less than ``gap`` between neighbours."""
    if late:
        events = events.withWatermark(ts, late)
    counts = events.groupBy(F.session_window(ts, gap).alias("_w"), F.col(key)).agg(F.count(F.lit(1)).alias("n"))
    return counts.select(key, F.col("_w.start").alias("start"), "n")


def file_stream(spark: SparkSession, path: str, schema: str, files_per_batch: int = 100) -> DataFrame:
    """Parquet files of a folder as they arrive."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def upsert_stream(changes: DataFrame, read: Callable[[], DataFrame | None], write: Callable[[DataFrame, int], None], key: str, checkpoint: str) -> StreamingQuery:
    """Every micro-batch replaces the master's rows of its keys; ``write`` gets the new master and the batch's number, so that a replayed batch overwrites its own version."""
    from marketlens.operators.incremental import replace_by_key

    def apply(batch: DataFrame, number: int) -> None:
        master = read()
        write(batch if master is None else replace_by_key(master, batch, [key]), number)

    return changes.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
