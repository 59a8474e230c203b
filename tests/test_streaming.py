import datetime as dt

from marketlens.streaming.windows import file_stream, tumbling_counts, upsert_stream

SCHEMA = "id bigint, ts timestamp, kind string"


def rows(spark, *items):
    return spark.createDataFrame([(i, dt.datetime(2024, 1, 1, h), k) for i, h, k in items], SCHEMA)


def test_stream_equals_batch(spark, tmp_path):
    src = str(tmp_path / "in")
    rows(spark, (1, 0, "a"), (2, 1, "a"), (3, 7, "b")).write.parquet(src)
    rows(spark, (4, 2, "b"), (5, 8, "b")).write.mode("append").parquet(src)
    q = tumbling_counts(file_stream(spark, src, SCHEMA, 1), "ts", "kind", "6 hours", "30 days").writeStream.outputMode("complete").format("memory").queryName("counted").start()
    q.processAllAvailable()
    q.stop()
    want = tumbling_counts(spark.read.parquet(src), "ts", "kind", "6 hours")
    assert sorted(map(tuple, spark.table("counted").collect())) == sorted(map(tuple, want.collect()))


def test_upserts(spark, tmp_path):
    src, out = str(tmp_path / "in"), []
    rows(spark, (1, 0, "a"), (2, 1, "a")).coalesce(1).write.parquet(src)

    def write(df, number):
        df.write.mode("overwrite").parquet(str(tmp_path / f"v{number}"))
        out.append(number)

    read = lambda: spark.read.parquet(str(tmp_path / f"v{out[-1]}")) if out else None
    upsert_stream(file_stream(spark, src, SCHEMA), read, write, "id", str(tmp_path / "cp")).awaitTermination()
    rows(spark, (2, 5, "z"), (3, 5, "n")).coalesce(1).write.mode("append").parquet(src)
    upsert_stream(file_stream(spark, src, SCHEMA), read, write, "id", str(tmp_path / "cp")).awaitTermination()
    assert sorted((r.id, r.kind) for r in read().collect()) == [(1, "a"), (2, "z"), (3, "n")]
