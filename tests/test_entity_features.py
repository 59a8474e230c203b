import datetime as dt

from pyspark.sql import functions as F

from marketlens.operators.entity_features import candidate_features, entity_features, once

M = "candidatematchid bigint, userid string, jobid bigint, matchdate timestamp_ntz, isapply int, applicationdate timestamp_ntz, feed_day date, kind string, ts string, _e int"
A = "activityid bigint, userid string, activitydate timestamp_ntz, type int, feed_day date, user_id string, _k string"
T, DAY = lambda d, h=0: dt.datetime(2015, 6, d, h), dt.date(2015, 6, 10)


def tables(spark, m, a):
    return spark.createDataFrame([(*x, "k", "t", 1) for x in m], M), spark.createDataFrame([(*x, "u", "k") for x in a], A)


def test_counts_dates_and_repeats(spark):
    m, a = tables(
        spark,
        [
            (1, " ABC ", 7, T(9), 1, T(9, 5), DAY), (1, "abc", 7, T(9), 1, T(9, 5), DAY),  # delivered twice
            (2, "abc", 7, T(8), 0, T(8), DAY), (3, "abc", None, None, 2, None, None),  # unknown flag, no dates
            (4, "abc", 7, dt.datetime(2040, 1, 1), 1, dt.datetime(1970, 1, 1), DAY),  # absurd dates
            (5, None, 7, T(9), 1, T(9), DAY), (6, "0", 7, T(9), 1, T(9), DAY), (7, "NULL", 7, T(9), 1, T(9), DAY), (8, "  ", 7, T(9), 1, T(9), DAY),
            (None, "abc", 7, T(1), 0, None, DAY), (None, "abc", 7, T(1), 0, None, DAY),  # no key: both count
        ],
        [(1, "abc", T(7), 2, DAY), (1, "abc", T(7), 2, DAY), (2, "abc", None, 99, DAY), (3, "abc", T(7), 0, DAY), (4, "abc", T(7), None, DAY), (5, "only", T(3), 12, DAY)],
    )
    got = {r["user_id"]: r for r in candidate_features(m, a).collect()}
    assert set(got) == {"abc", "only"}
    r = got["abc"]
    assert (r["n_match"], r["n_application"], r["n_type_2"], r["n_type_99"], r["n_type_12"], r["n_total"]) == (6, 2, 1, 1, 0, 10)
    assert (r["last_match"], r["last_application"], r["last_type_2"], r["last_type_99"], r["last_type_12"]) == (T(9), T(9, 5), T(7), None, None)
    assert (got["only"]["n_match"], got["only"]["n_type_12"], got["only"]["last_total"]) == (0, 1, T(3))


def test_latest_delivery_counts(spark):
    rows = spark.createDataFrame([(1, dt.date(2015, 1, 1), 5), (1, dt.date(2015, 1, 2), 3), (1, None, 9), (2, None, None)], "k int, day date, v int")
    assert {(r.k, r.v) for r in once(rows, "k", ["day"]).collect()} == {(1, 3), (2, None)}


def test_empty_and_salts(spark):
    m, a = tables(spark, [], [])
    assert candidate_features(m, a).count() == 0
    rows = spark.range(5000).select((F.col("id") % 3 * F.lit(0)).cast("string").alias("user_id"), F.lit("x").alias("kind"), F.lit(None).cast("date").alias("ts")).repartition(8)
    one = entity_features(rows, ["x", "y"], salts=4).collect()
    assert [(r["n_x"], r["n_y"], r["n_total"]) for r in one] == [(5000, 0, 5000)]
