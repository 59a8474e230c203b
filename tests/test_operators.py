import datetime as dt
import math
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from marketlens.functions import scoring, text
from marketlens.operators import incremental as inc
from marketlens.operators import relational as rel
from marketlens.operators import similarity as sim


def test_two_upserts_differ_in_nulls(spark):
    m = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0)], "k int, s string, v double")
    c = spark.createDataFrame([(2, None, 5.0), (3, "c", None)], "k int, s string, v double")
    assert sorted(map(tuple, inc.update_present(m, c, "k").collect())) == [(1, "a", 1.0), (2, "b", 5.0), (3, "c", None)]
    assert sorted(map(tuple, inc.update_all(m, c, "k").collect()), key=lambda r: r[0]) == [(1, "a", 1.0), (2, None, 5.0), (3, "c", None)]
    once = inc.update_present(m, c, "k")
    assert sorted(map(tuple, inc.update_present(once, c, "k").collect())) == sorted(map(tuple, once.collect()))


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 4), st.integers(0, 20)), max_size=40))
def test_capped_list_equals_greedy(spark, rows):
    rows = list(dict.fromkeys(rows))
    df = spark.createDataFrame([(u, g, s, i) for i, (u, g, s) in enumerate(rows)], "u int, g int, s int, i int")
    got = {}
    for r in rel.capped_top_k(df, "u", "g", [F.desc("s"), F.asc("i")], 2, 5).orderBy("u", "rank").collect():
        got.setdefault(r.u, []).append(r.i)
    want = {}
    for i, (u, g, s) in sorted(enumerate(rows), key=lambda x: (-x[1][2], x[0])):
        held = want.setdefault(u, [])
        if len(held) < 5 and sum(rows[j][1] == g for j in held) < 2:
            held.append(i)
    assert got == want


def test_anti_and_semi_make_the_whole(spark):
    base, gone = spark.range(20).withColumn("v", F.col("id") * 2), spark.range(5, 9)
    assert inc.delete_keys(base, gone, ["id"]).count() + base.join(gone, "id", "left_semi").count() == 20


def test_round_robin_is_a_numbering(spark):
    df = spark.createDataFrame([(i * 7 % 101,) for i in range(101)], "k int").repartition(5)
    got = {r.k: (r["index"], r["part"]) for r in rel.round_robin(df, ["k"], 6).collect()}
    assert got == {k: (k, k % 6) for k in range(101)}


def test_ranges_later_ordinal_wins(spark):
    df = spark.createDataFrame([(5,), (60,), (150,), (None,), (999,)], "k int")
    ranges = spark.createDataFrame([(0, 99, "a", 1), (50, 400, "b", 2)], "lo bigint, hi bigint, label string, ordinal int")
    assert {r.k: r.label for r in rel.range_label(df, "k", ranges, 10).collect()} == {5: "a", 60: "b", 150: "b", None: None, 999: None}


def test_weights_sum_to_one(spark):
    df = spark.createDataFrame([(5.25,), (4.08,), (-1.0,), (None,), (40.0,)], "e double")
    for r in df.select(F.array(*scoring.component_weights(F.col("e"))).alias("w")).collect():
        assert sum(r.w) == pytest.approx(1.0)


def test_similarity_of_unknowns_is_zero(spark):
    df = spark.createDataFrame([(-1.0, 3.0), (3.0, 3.0), (0.0, 0.0), (None, 2.0)], "a double, b double")
    assert [r.s for r in df.select(scoring.experience_similarity(F.col("a"), F.col("b")).alias("s")).collect()] == [0.0, 1.0, 1.0, 0.0]


def test_text_functions(spark):
    df = spark.createDataFrame([("a, b,a ,c", "<p>x&nbsp;y</p>", "c 2.0", "100%2525", "5yrs at 3 places")], "l string, h string, v string, u string, n string")
    r = df.select(text.dedupe_list(F.col("l")), text.html_text(F.col("h")), text.without_version(F.col("v")), text.decoded_twice(F.col("u")), text.without_units(F.col("n")), text.numbers(F.col("n"))).first()
    assert tuple(r) == ("a,b,c", "x y", "c", "100%", "at 3 places", [5.0, 3.0])
    assert spark.range(1).select(text.ngrams(F.array(F.lit("a"), F.lit("b"), F.lit("c")), 2), text.ngrams(F.array(F.lit("a")), 2)).first()[:] == (["a b", "b c"], [])


def test_co_application_equals_brute_force(spark):
    apps = [(u, i) for u in range(12) for i in range(1, 10) if (u * i) % 4 != 1]
    df = spark.createDataFrame([*apps, *apps[:5], (None, 1), (3, None)], "u int, i int")
    want = {}
    for a in range(1, 10):
        for b in range(a + 1, 10):
            n = len({u for u, i in apps if i == a} & {u for u, i in apps if i == b})
            if n >= 5:
                want[a, b] = n
    for chunk in (200, 2):
        assert {(r.item_a, r.item_b): r.n_ab for r in sim.co_application(df, "u", "i", 5, chunk).collect()} == want


def test_profile_neighbours_equal_brute_force(spark):
    rng, edges = random.Random(3), (3, 8, 15, 25)
    rows = []
    for i in range(90):
        e, s = rng.choice((-1, 0, 2, 5, 9)), rng.choice((-1, 0, 3, 6))
        band = [1 + sum(v > x for x in edges) for v in (e, s)]
        rows.append((i, i % 2, e, s, *band, rng.choice((-1, 1)), rng.choice(("", "a", "b")), rng.choice((-1, 4)), rng.choice(("", "cook", "head cook")), rng.sample("pqrst", rng.randrange(4))))
    df = spark.createDataFrame(rows, "id bigint, fa int, experience int, salary int, exp_band int, sal_band int, ind int, subfa string, insti int, title string, skills array<string>")
    got = {(r.query_id, r.id): r.similarity for r in sim.profile_neighbours(df, df.where("id < 30"), 501).collect()}

    def weights(e):
        raw = [b + s / (1 + math.exp(-g * (f * math.exp(r * max(e, 0)) - o))) for b, s, f, r, o, g in scoring.WEIGHTS]
        return [w / sum(raw) for w in raw]

    def part(n, a, b):
        if a in (-1, "") or b in (-1, ""):
            return 0.0
        lo, hi = (min(a, b), max(a, b)) if n < 2 else (0, 0)
        if n == 0:
            return math.exp(-2 * hi) if lo == 0 else math.exp(-0.4 * ((hi - lo) / lo) ** 2 * lo)
        if n == 1:
            r = (hi - lo) / lo if lo else 0
            return math.exp(-hi) if lo == 0 else math.exp(-1.3 * (0.2 * r**4 + 0.2 * r**2) * lo)
        return float(a == b)

    want, at = {}, (2, 3, 6, 7, 8, 9)
    for x in rows[:30]:
        w = weights(x[2])
        for y in rows:
            if x[0] == y[0] or x[1] != y[1] or abs(x[4] - y[4]) > 1 or abs(x[5] - y[5]) > 1:
                continue
            cheap = sum(w[n] * part(n, x[c], y[c]) for n, c in enumerate(at))
            if cheap >= 0.6 * sum(w[n] for n, c in enumerate(at) if x[c] not in (-1, "")) - 1e-12:
                a, b = set(x[10]), set(y[10])
                dots, own, other = len(a & b), len(a), len(a & b)  # lengths over the query's skills
                cosine = dots / math.sqrt(own * other) if dots else 0.0
                want[x[0], y[0]] = cheap + w[6] * (0.7 * cosine**2 + 0.3 * (len(a & b) / len(a | b) if a | b else 0.0))
    assert len(want) > 20 and got.keys() == want.keys()
    assert all(got[p] == pytest.approx(want[p], abs=6e-5) for p in want)


def test_daily_counts_keep_empty_days(spark):
    df = spark.createDataFrame([(dt.datetime(2015, 1, 2, 3),), (None,)], "t timestamp_ntz")
    assert [(str(r.day), r.n) for r in rel.daily_counts(df, "t", "2015-01-01", "2015-01-03").orderBy("day").collect()] == [("2015-01-01", 0), ("2015-01-02", 1), ("2015-01-03", 0)]


def test_filters_reach_the_scan(spark, tmp_path):
    spark.range(100).withColumn("v", F.col("id") * 2).write.parquet(str(tmp_path / "t"))
    plan = rel.scan(spark.read.parquet(str(tmp_path / "t")), "v > 5", ["id"])._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "GreaterThan(v,5)" in plan
