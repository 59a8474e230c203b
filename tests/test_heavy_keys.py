import numpy as np
from pyspark.sql import functions as F

from marketlens.functions.keys import whole_key
from marketlens.operators.heavy_keys import hot_keys, key_totals


def test_totals_equal_group_by(spark):
    rng = np.random.default_rng(1)
    keys = np.where(rng.random(20000) < 0.4, 7, rng.integers(1, 3000, 20000))
    rows = [(None if i % 50 == 0 else int(k), None if i % 3 == 0 else i % 2, None, "x") for i, k in enumerate(keys)]
    df = spark.createDataFrame(rows, "k bigint, f int, ts timestamp_ntz, n_rows string").withColumn("ts", F.expr("timestamp_ntz '2020-01-01 00:00:00' + make_interval(0,0,0,0,0,0,coalesce(k,0))")).repartition(7)
    want = df.where("k IS NOT NULL").groupBy(F.col("k").alias("key")).agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("f") == 1).alias("n_flagged"), F.max("ts").alias("last_ts"))
    for flush in (1 << 20, 100):  # the second emits many partial dictionaries
        got = key_totals(df, F.col("k"), F.col("f") == 1, F.col("ts"), flush_keys=flush)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_hot_share_counts_rows_without_key(spark):
    rows = [("42",)] * 2 + [(" 042.0 ",)] + [("43",)] + [(None,)] * 10 + [("NA",), ("0",), ("-1",), ("", )] + [(str(1000 + i),) for i in range(82)]
    df = spark.createDataFrame(rows, "c string")
    assert [tuple(r) for r in hot_keys(df, whole_key(F.col("c")), 3).collect()] == [(42, 3)]


def test_empty_table(spark):
    df = spark.createDataFrame([], "k bigint")
    assert key_totals(df, F.col("k")).count() == 0 and hot_keys(df, F.col("k")).count() == 0
