import math
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketlens.functions.keys import portable_hash
from marketlens.functions.stemming import stem
from marketlens.operators import recommend as rec
from marketlens.operators import models
from marketlens.operators import relational as rel
from marketlens.operators import similarity as sim
from marketlens.operators.entity_features import entity_features
from marketlens.plans import catalog
from marketlens.sources import files


def test_stems():
    pairs = {
        "caresses": "caress", "ponies": "poni", "ties": "ti", "caress": "caress", "cats": "cat", "feed": "feed", "agreed": "agre", "plastered": "plaster", "bled": "bled", "motoring": "motor", "sing": "sing",
        "conflated": "conflat", "troubled": "troubl", "sized": "size", "hopping": "hop", "tanned": "tan", "falling": "fall", "hissing": "hiss", "fizzed": "fizz", "failing": "fail", "filing": "file",
        "happy": "happi", "sky": "sky", "relational": "relat", "conditional": "condit", "rational": "ration", "valenci": "valenc", "digitizer": "digit", "radicalli": "radic", "vietnamization": "vietnam",
        "operator": "oper", "feudalism": "feudal", "decisiveness": "decis", "hopefulness": "hope", "formaliti": "formal", "sensibiliti": "sensibl", "triplicate": "triplic", "formative": "form", "electrical": "electr",
        "goodness": "good", "revival": "reviv", "allowance": "allow", "airliner": "airlin", "adjustable": "adjust", "replacement": "replac", "adoption": "adopt", "homologou": "homolog", "effective": "effect",
        "probate": "probat", "rate": "rate", "cease": "ceas", "controll": "control", "roll": "roll", "engineering": "engin", "is": "is", "c3po": "c3po",
    }
    assert {w: stem(w) for w in pairs} == pairs


def test_city_scores_with_capitals(spark):
    matrix = spark.createDataFrame([("a", "b", 0.5), ("a", "a", 1.0), ("cap", "b", 0.7), ("b", "cap", 0.4)], "a string, b string, score double")
    capitals = spark.createDataFrame([("state", "cap"), ("other", "b")], "state string, capital string")
    rows = [(1, ["a"], ["b"], 0.5), (2, ["x", "a"], ["a", "b"], 1.0), (3, ["state"], ["b"], 0.7), (4, ["b"], ["state"], 0.4), (5, ["state"], ["other"], 0.0), (6, [], ["a"], 0.0), (7, None, None, 0.0), (8, ["zz"], ["a"], 0.0)]
    df = spark.createDataFrame([(i, a, b) for i, a, b, _ in rows], "k int, x array<string>, y array<string>")
    assert {r.k: r.city_score for r in rec.city_score(df, ["k"], "x", "y", matrix, capitals).collect()} == {i: s for i, _, _, s in rows}


def test_best_common(spark):
    df = spark.sql("SELECT map('a', 1.0D, 'b', 3.0D) AS m, array('a', 'c') AS k UNION ALL SELECT map('a', 1.0D), array('z') UNION ALL SELECT map('a', 1.0D, 'b', 3.0D), array('b', 'a', 'a')")
    assert [r[0] for r in df.select(rec.best_common(F.col("m"), F.col("k"))).collect()] == [1.0, None, 3.0]


def test_product_scores_equal_brute_force(spark):
    rng = random.Random(1)
    similar = [(u, o, rng.randrange(100)) for u in range(6) for o in range(6) if u != o]
    apps = [(u, i) for u in range(6) for i in range(8) if rng.random() < 0.4]
    linked = [(i, j, rng.randrange(50)) for i in range(8) for j in range(8) if i != j and rng.random() < 0.5]
    want = defaultdict(int)
    for u, o, s in similar:
        for v, i in apps:
            for a, b, c in linked:
                if v == o and a == i:
                    want[u, b] += s * c
    cut = sorted(want.values())[len(want) // 2]
    got = rec.product_scores(
        spark.createDataFrame(similar, "user int, other int, sim bigint"), spark.createDataFrame([*apps, *apps[:3]], "user int, item int"), spark.createDataFrame(linked, "item int, other int, cosine bigint"), cut
    )
    assert {(r.user, r.item): r.score for r in got.collect()} == {k: v for k, v in want.items() if v >= cut}


@pytest.mark.parametrize("block", [2_000_000, 60])
def test_linked_sums_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(sim, "PRODUCTS", 50)
    rng = random.Random(3)
    bound, level = {f"u{u}": rng.randrange(6) for u in range(40)}, {j: rng.randrange(6) for j in range(90)}
    rows = [(f"u{u}", i, rng.randrange(4), bound[f"u{u}"]) for u in range(40) for i in range(30) if i == 0 or rng.random() < 0.1] + [("u3", 0, 2, bound["u3"]), (None, 1, 1, 1), ("u4", None, 1, 1)]
    links = [(i, j, rng.randrange(3), level[j]) for i in range(20) for j in range(90) if i == 0 or rng.random() < 0.1]
    skip = [(f"u{u}", j) for u in range(45) for j in range(95) if rng.random() < 0.05]
    want = defaultdict(int)
    for u, i, w, b in rows:
        for k, j, c, v in links:
            if u is not None and k == i and v >= b and (u, j) not in set(skip):
                want[u, j] += w * c
    args = (
        spark.createDataFrame(rows, "user string, item bigint, weight int, bound int"), spark.createDataFrame(links, "item bigint, other bigint, cosine bigint, level int"), spark.createDataFrame(skip, "user string, item bigint"),
    )
    got = [tuple(r) for r in sim.linked_sums(*args, block=block).collect()]  # sums of 0 are rows too
    assert len(got) == len(want) and {(u, j): s for u, j, s in got} == want
    best = defaultdict(list)
    for (u, j), s in want.items():
        best[u] += [(-s, j)] if s >= 2 else []
    got = {(r.user, r.item, r.score) for r in sim.linked_sums(*args, least=2, first=7, block=block).collect()}
    assert got == {(u, j, -s) for u, found in best.items() for s, j in sorted(found)[:7]}


@pytest.mark.parametrize("which", ["collaborative", "product"])
def test_products_are_not_shuffled(spark, which):
    """A popular item has 2,000 users and 300 links: 600,000 products from 2,300 rows."""
    apps = spark.range(2000).select(F.col("id").alias("user"), F.lit(0).cast("bigint").alias("item"))
    links = spark.range(1, 301).select(F.lit(0).cast("bigint").alias("item"), F.col("id").alias("other"), F.lit(7).cast("bigint").alias("cosine"))
    if which == "collaborative":
        out = sim.collaborative_scores(apps, "user", "item", links)
    else:
        similar = spark.range(2000).select(F.col("id").alias("user"), F.expr("id ^ 1").alias("other"), F.lit(3).cast("bigint").alias("sim"))
        out = rec.product_scores(similar, apps, links, 21)
    assert out.count() == 600_000
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan[: plan.index("MapInArrow")] and "Join" not in plan[: plan.index("MapInArrow")]  # nothing follows the products


def test_product_scores_end_with_the_products(spark):
    """The whole query: a popular job's products are summed where they arise, and go to no aggregation, join or shuffle."""
    out = catalog.QUERIES["product_scores"](spark, "/root/testdata/sf0.01")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1 and plan.split()[0] == "MapInArrow"
    assert out.where("score < 50000").count() == 0 < out.count()


def test_double_cut(spark):
    df = spark.createDataFrame([(1, i, 100 - i, float(i)) for i in range(10)] + [(2, 1, 5, 1.0)], "u int, i int, s int, f double")
    got = [(r.u, r.i, r["rank"]) for r in rec.double_cut(df, "u", "i", "s", F.col("f"), 4, 2).orderBy("u", "rank").collect()]
    assert got == [(1, 3, 1), (1, 2, 2), (2, 1, 1)]  # 9 has the best product, but isn't among the first four


def test_routes(spark):
    a = spark.createDataFrame([(1, [1, 2, 3, 4, 5]), (3, [1, 2, 9]), (4, [7])], "u int, items array<int>")
    b = spark.createDataFrame([(2, [8, 9]), (3, [9, 10, 11]), (4, [7])], "u int, items array<int>")
    got = {r.u: tuple(r)[1:] for r in rec.routed(a, b, "u", 2).collect()}
    assert got == {1: ("a", [1, 2], None, [3, 4], [5]), 2: ("b", None, [8, 9], None, None), 3: ("both", [1, 2], [9, 10], None, [11]), 4: ("both", None, [7], None, None)}


def test_incremental_neighbours(spark):
    base = spark.createDataFrame([(1, 2, 900), (1, 3, 800), (2, 1, 900)], "u1 int, u2 int, sim int")
    new = spark.createDataFrame([(1, 9, 799), (1, 8, 800), (2, 9, 1), (5, 6, 1)], "u1 int, u2 int, sim int")
    assert {tuple(r) for r in rec.accepted_edges(base, new, 2).collect()} == {(1, 8, 800), (2, 9, 1), (5, 6, 1)}
    fresh = spark.createDataFrame([(1, 2, 5), (1, 2, 6), (7, 8, 9)], "u1 int, u2 int, sim int")
    assert {tuple(r) for r in rec.linked_updates(base, fresh).collect()} == {(1, 2, 6), (1, 3, 800), (2, 1, 900)}


def test_appended_ids_and_interleaving(spark):
    known = spark.createDataFrame([("b", 7), ("x", 3)], "u string, n int")
    keys = spark.createDataFrame([("a",), ("b",), (None,), ("é",), ("a",)], "u string")
    assert {tuple(r) for r in rec.appended_ids(known, keys, "u", "n").collect()} == {("b", 7), ("x", 3), ("a", 8), ("é", 9)}
    parts = [spark.createDataFrame([(1, "p"), (2, "p")], "k int, s string"), spark.createDataFrame([(1, "q"), (0, "q")], "k int, s string")]
    assert [tuple(r) for r in rel.interleaved(parts, "k").collect()] == [(0, "q"), (1, "p"), (1, "q"), (2, "p")]


def test_latent_vectors_equal_svd(spark):
    rng = random.Random(2)
    docs = [(i, " ".join(rng.choice("abcdefgh") for _ in range(6))) for i in range(30)] + [(99, None), (98, "")]
    df = spark.createDataFrame(docs, "k int, x string")
    weights = rec.tf_idf(df, "k", F.filter(F.split("x", " "), lambda w: w != ""), 6)
    rows = weights.collect()
    terms = sorted({r.term for r in rows})
    assert len(terms) == 6
    for r in rows:
        df_term = sum(x is not None and r.term in x.split() for _, x in docs)
        assert r.weight == pytest.approx(r.n * math.log(33 / (df_term + 1)))
    keys = sorted({r.k for r in rows})
    m = np.zeros((len(keys), 6))
    for r in rows:
        m[keys.index(r.k), terms.index(r.term)] = r.weight
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    want = m @ np.linalg.svd(m)[2][:3].T
    got = {r.k: r.vector for r in rec.latent_vectors(weights, "k", 3).collect()}
    assert sorted(got) == keys
    have = np.array([got[k] for k in keys])
    assert np.allclose(have @ have.T, want @ want.T, atol=1e-8)  # signs are free


def test_latent_vectors_are_fitted_on_all_documents(spark):
    """The last 3,000 of 53,000 documents have terms of their own, which are the strongest factors."""
    weights = spark.range(53_000).select(F.col("id").alias("k"), F.when(F.col("id") < 50_000, F.concat(F.lit("a"), (F.col("id") % 50).cast("string"))).otherwise("z").alias("term"), F.lit(1.0).alias("weight"))
    got = {r.k: r.vector for r in rec.latent_vectors(weights, "k", 1).where("k % 1000 = 0").collect()}
    assert len(got) == 53 and all(abs(abs(v[0]) - (k >= 50_000)) < 1e-9 for k, v in got.items())


def test_neighbours_over_many_blocks(spark):
    """Equal similarities are parted by key, whatever block they come in; each query has k rows before any shuffle."""
    rng = np.random.default_rng(5)
    data = [(i, [float(x) for x in rng.integers(0, 4, 3)]) for i in range(1500)]
    df = spark.createDataFrame([*data, (7777, None)], "id int, v array<float>").repartition(3)
    unit = {i: np.array(v) / np.linalg.norm(v) for i, v in data if any(v)}
    want = set()
    for q in (i for i in unit if i % 30 == 0):
        near = sorted((-round(float(unit[q] @ u), 4), i) for i, u in unit.items() if i != q)[:40]
        want |= {(q, i, n) for n, (s, i) in enumerate(near, 1) if s <= -0.9}
    found = sim.cosine_neighbours(df, df.where("id % 30 = 0"), "id", "v", 40, 0.9)
    assert {(r.query_id, r.id, r["rank"]) for r in found.collect()} == want
    assert "Window" not in found._jdf.queryExecution().optimizedPlan().toString()
    ids, u = (np.array(x) for x in zip(*((i, unit[i]) for i in unit if i % 30 == 0), strict=True))
    from marketlens.session import written

    files = written(df.select(F.col("id").cast("bigint"), F.col("v").cast("array<double>")).where("v IS NOT NULL"), "test").inputFiles()
    rows = [r for part in sim._nearest(ids, u, files, 40, 0.9, rows=100, step=7) for r in zip(*(c.tolist() for c in part), strict=True)]
    assert {(q, i, n) for q, i, _, n in rows} == want and len(rows) == len(want)


def test_capped_neighbours_in_one_task(spark):
    """As the 60 nearest, ranked under a cap of two a company by windows."""
    rng = np.random.default_rng(6)
    df = spark.createDataFrame([(i, [float(x) for x in rng.integers(0, 4, 3)], i % 7 or None) for i in range(600)], "id int, v array<double>, c int")
    found = sim.cosine_neighbours(df, df.where("id % 30 = 0"), "id", "v", 60, 0.9, "c", 2, 5)
    near = sim.cosine_neighbours(df, df.where("id % 30 = 0"), "id", "v", 60, 0.9).drop("rank")
    want = rel.capped_top_k(near.join(df.select("id", "c"), "id"), "query_id", "c", [F.desc("similarity"), F.asc("id")], 2, 5).select(*found.columns)
    got = {tuple(r) for r in found.collect()}
    assert got == {tuple(r) for r in want.collect()} and len(got) == want.count() > 0
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "Join" not in plan  # 300 rows a query would go through a shuffle


def test_nested_labels_read_what_is_written(spark, monkeypatch):
    """The rows' plan runs once, not anew for each area's forest."""
    runs = spark.sparkContext.accumulator(0)

    def words(i):  # noqa: ANN001, ANN202
        runs.add(1)
        return [f"w{i % 2}", f"v{i % 4}"]

    made = F.udf(words, "array<string>").asNondeterministic()
    rows = spark.range(400).select(F.col("id").alias("k"), made("id").alias("words"))
    train = spark.range(400).select(F.array(F.concat(F.lit("w"), (F.col("id") % 2).cast("string")), F.concat(F.lit("v"), (F.col("id") % 4).cast("string"))).alias("words"), F.concat(F.lit("a"), (F.col("id") % 2).cast("string")).alias("area"), F.concat(F.lit("l"), (F.col("id") % 4).cast("string")).alias("label"))
    got = models.nested_labels(train, rows, "k", "area", "label").collect()
    assert {(r.k, r.area, r.first, r.second) for r in got} == {(i, f"a{i % 2}", f"l{i % 4}", f"l{(i + 2) % 4}") for i in range(400)} and len(got) == 400
    assert runs.value <= 400


def test_hash_is_that_of_other_engines(spark):
    import hashlib

    assert spark.range(3).select(portable_hash(F.col("id"), 5).alias("h")).collect()[2].h == int(hashlib.md5(b"2:5").hexdigest()[:15], 16)


def test_dated_paths():
    assert files.dated_paths(["2015-01-01", "2015-01-03", "2015-01-04", "2015-01-04"], "p/{}") == ["p/2015-01-04", "p/2015-01-03"] and files.dated_paths([], "{}") == []


def test_three_hundred_event_types(spark):
    rows = spark.range(3000).select((F.col("id") % 7).cast("string").alias("user_id"), F.concat(F.lit("t"), (F.col("id") % 301).cast("string")).alias("kind"), F.lit(None).cast("date").alias("ts"))
    types = [f"t{i}" for i in range(300)]
    got = entity_features(rows, types).collect()
    assert len(got) == 7 and all(sum(r[f"n_{t}"] for t in types) == r.n_total for r in got)
    assert sum(r.n_total for r in got) == sum(i % 301 < 300 for i in range(3000))
