import itertools
import random

import pytest
from pyspark.sql import functions as F

from marketlens.llm.cooccurrence import associations, skill_list
from marketlens.llm.top_bands import scored, top_items


@pytest.mark.parametrize("chunk", [3, 256])
def test_pairs_equal_brute_force(spark, chunk):
    rng = random.Random(3)
    rows = [(j, ";".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.choice((0, 1, 3, 25)))), "x", 1) for j in range(60) for _ in range(2)]
    rows += [(None, "a;b", "x", 1), (7, None, "x", 1), (8, " ; NA | null", "x", 1), (9, "B,b-C ,  b \tc", "x", 1)]
    df = spark.createDataFrame(rows, "jobid int, keyskills string, item string, n int")
    baskets = {}
    for j, text, *_ in rows:
        if j is not None and text:
            for part in text.replace(",", ";").replace("|", ";").split(";"):
                s = " ".join(part.lower().replace("-", " ").split())
                if s not in ("", "na", "null", "none"):
                    baskets.setdefault(j, set()).add(s)
    pairs = [p for b in baskets.values() for p in itertools.combinations(sorted(b), 2)]
    n = lambda s: sum(s in b for b in baskets.values())
    got = {(r.item_a, r.item_b): (r.n_ab, r.n_a, r.n_b, r.n_baskets) for r in associations(df, "jobid", skill_list(F.col("keyskills")), chunk).collect()}
    assert got == {p: (pairs.count(p), n(p[0]), n(p[1]), len(baskets)) for p in set(pairs)}


def test_no_baskets(spark):
    df = spark.createDataFrame([], "jobid int, keyskills string")
    assert associations(df, "jobid", skill_list(F.col("keyskills"))).count() == 0


@pytest.mark.parametrize("quantiles", [(0.95, 0.8, 0.5), (0.99, 0.98), ()])
def test_bands_equal_full_ranking(spark, quantiles):
    rng = random.Random(5)
    rows = [(g, rng.randrange(200), rng.choice((None, -5, 1001, 1000, 1000, 500, rng.randrange(1001))), "x") for g in range(6) for _ in range((1, 4, 30, 300, 2000, 12)[g])]
    rows += [(None, 1, 5, "x"), (1, None, 5, "x"), (3, 3, 1000, "x"), (50, 50, 900, "x")]
    df = scored(spark.createDataFrame(rows, "u1 int, u2 int, s int, rank string"), F.col("u1"), F.col("u2"), F.col("s"), "t")
    best = {}
    for g, i, s, _ in rows:
        if None not in (g, i, s) and 0 <= s <= 1000 and g != i:
            best.setdefault(g, {})[i] = max(s, best.get(g, {}).get(i, -1))
    want = {(g, i, s, k) for g, items in best.items() for k, (i, s) in enumerate(sorted(items.items(), key=lambda x: (-x[1], x[0]))[:10], 1)}
    assert {(r.group_id, r.item_id, r.score, r["rank"]) for r in top_items(df, 10, quantiles).collect()} == want


def test_no_scores(spark):
    df = spark.createDataFrame([], "u1 int, u2 int, s int")
    assert top_items(scored(df, F.col("u1"), F.col("u2"), F.col("s"))).count() == 0
