"""Files written to and read from the shared folder."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.session import shared_dir


def read_csv(spark: SparkSession, path: str | Sequence[str], schema: str, sep: str = ",", header: bool = True) -> DataFrame:
    """CSV under a given schema; a row that doesn't fit gets nulls, nothing is inferred."""
    return spark.read.csv(path if isinstance(path, str) else list(path), schema=schema, sep=sep, header=header, mode="PERMISSIVE", quote='"', escape='"', multiLine=True)


def write_csv(df: DataFrame, path: str, sep: str = ",") -> None:
    df.write.mode("overwrite").csv(path, header=True, sep=sep, quote='"', escape='"')


def csv_round_trip(df: DataFrame) -> DataFrame:
    """``df`` written as CSV and read again under its own schema."""
    path = f"{shared_dir(df.sparkSession)}/csv-{uuid.uuid4().hex}"
    write_csv(df, path)
    return read_csv(df.sparkSession, path, ", ".join(f"{c} {t}" for c, t in df.dtypes))


def written_in_parts(df: DataFrame, n: int) -> DataFrame:
    """``df`` written as ``n`` files of about equal size, replacing what was there, and read again."""
    path = f"{shared_dir(df.sparkSession)}/parts-{uuid.uuid4().hex}"
    df.repartition(n).write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def written_by(df: DataFrame, *columns: str) -> DataFrame:
    """``df`` written in one folder for each value of the columns, and read again; rows of a value are gathered first, so that each has few files."""
    path = f"{shared_dir(df.sparkSession)}/by-{uuid.uuid4().hex}"
    df.repartition(*columns).write.partitionBy(*columns).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def saved_and_loaded(model, spark: SparkSession):  # noqa: ANN001, ANN201
    """A fitted model saved in the shared folder, and loaded from there."""
    path = f"{shared_dir(spark)}/model-{uuid.uuid4().hex}"
    model.write().save(path)
    return type(model).load(path)


def upsert_table(df: DataFrame, base: str, target: str, key: str) -> DataFrame:
    """The table at ``base`` with the rows of ``df`` in place of those with the same key, written to ``target``: readers of ``base`` see no half of it."""
    from marketlens.operators.incremental import replace_by_key

    spark = df.sparkSession
    replace_by_key(spark.read.parquet(base), df, [key]).write.parquet(target)
    return spark.read.parquet(target)


def append_table(df: DataFrame, path: str) -> None:
    """Adds rows to the table at ``path``, which may not exist yet."""
    df.write.mode("append").parquet(path)


def remove_rows(spark: SparkSession, base: str, target: str, where: Column | str) -> DataFrame:
    """The table at ``base`` without the rows that meet a condition, written to ``target``; rows for which it is unknown stay."""
    gone = F.expr(where) if isinstance(where, str) else where
    spark.read.parquet(base).where(~F.coalesce(gone, F.lit(False))).write.parquet(target)
    return spark.read.parquet(target)


def fixed_feed(spark: SparkSession, path: str, schema: str, sep: str) -> DataFrame:
    """A feed without header, under explicit names and types: two separators in a row, and fields that a short line lacks, are null."""
    return spark.read.csv(path, schema=schema, sep=sep, header=False, mode="PERMISSIVE", enforceSchema=True)


def dated_paths(days: Sequence[str], pattern: str) -> list[str]:
    """Paths of the days of the last run without a gap; ``pattern`` has ``{}`` for the day (YYYY-MM-DD)."""
    import datetime as dt

    found = sorted({dt.date.fromisoformat(d) for d in days}, reverse=True)
    run = found[:1]
    for d in found[1:]:
        if run[-1] - d != dt.timedelta(days=1):
            break
        run.append(d)
    return [pattern.format(d.isoformat()) for d in run]


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def daily_lines(spark: SparkSession, paths: Sequence[str], day: str) -> DataFrame:
    """``value``: the lines of several (also compressed) logs that hold a day's stamp."""
    return spark.read.text(list(paths)).where(F.contains("value", F.lit(day)))


def jdbc_table(spark: SparkSession, url: str, query: str, column: str | None = None, lower: int = 0, upper: int = 0, parts: int = 1, **options: str) -> DataFrame:
    """A query against a database, read in ``parts`` ranges of a numeric column; connection settings come as options."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=f"({query}) q", **options)
    if column:
        reader = reader.options(partitionColumn=column, lowerBound=lower, upperBound=upper, numPartitions=parts)
    return reader.load()
