"""Session construction, table loading and lineage cutting."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from pyspark import SparkConf
from pyspark.sql import DataFrame, SparkSession

BROADCAST_BYTES = 64 << 20
"""Largest estimated size of a side that an operator may broadcast on its own account."""


def build_session(app: str = "marketlens", cpus: int | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are tested under; what a cluster's submission sets prevails.

    A local master, with as many shuffle partitions as cores, is set only where no master is given.
    """
    given = SparkConf()
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    if not given.contains("spark.master"):
        cores = cpus or os.cpu_count()
        settings |= {"spark.master": f"local[{cores}]", "spark.driver.memory": "12g", "spark.sql.shuffle.partitions": str(cores)}
    builder = SparkSession.builder.appName(app)
    for key, value in ({k: v for k, v in settings.items() if not given.contains(k)} | conf).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table ``name`` of a data directory; nothing is read until an action runs."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir`` of the session; where it is unset (tests), a folder of our own."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="marketlens-")
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def written(df: DataFrame, label: str, *by: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, in folders by the columns ``by``: cuts the lineage, and outlives any executor.

    The table is removed when the driver ends, or by ``release``.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    writer = df.write.partitionBy(*by) if by else df.write
    writer.parquet(path)
    _WRITTEN[path] = spark
    return spark.read.schema(df.schema).parquet(path) if by else spark.read.parquet(path)


_WRITTEN: dict[str, SparkSession] = {}


def release() -> None:
    """Removes all tables written so far: for a long-lived driver, once no frame that reads them is needed any more."""
    while _WRITTEN:
        path, spark = _WRITTEN.popitem()
        _remove(spark, path)


atexit.register(release)


def broadcastable(df: DataFrame, most: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` marked for broadcast if Catalyst's estimate keeps below ``most`` bytes; else as it is, for a shuffled join."""
    from pyspark.sql import functions as F

    return F.broadcast(df) if estimated_bytes(df) <= most else df


def _remove(spark: SparkSession, path: str) -> None:
    try:
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
        target = hadoop.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
    except Exception:  # the JVM may already be gone
        pass


def spread(df: DataFrame) -> DataFrame:
    """``df``, a scan with narrow steps, over all cores, where its files are too small to make a split for each; other tables are left as they are.

    Decided by the size of the files, against the least size of a split: nothing is run.
    """
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    least = spark._jsparkSession.sessionState().conf().filesOpenCostInBytes()
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    size = sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
    return df.repartition(cores) if size < cores * least else df


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of the optimized plan."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
