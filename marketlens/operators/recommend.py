"""Recommendation pipeline: latent text vectors, match scores, product scores, digests."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlens.operators.relational import top_k
from marketlens.operators.similarity import linked_sums
from marketlens.session import broadcastable, written

GRAM_PARTS = 8


def tf_idf(docs: DataFrame, key: str, words: Column, most_terms: int) -> DataFrame:
    """``key, term, n, weight``: counts of the ``most_terms`` terms of most documents (ties by term), weighed by ln((N + 1) / (df + 1))."""
    counts = docs.select(key, F.explode(words).alias("term")).groupBy(key, "term").agg(F.count(F.lit(1)).alias("n"))
    df = counts.groupBy("term").agg(F.count(F.lit(1)).alias("df")).orderBy(F.desc("df"), "term").limit(most_terms)
    total = docs.agg(F.count(F.lit(1)).alias("t")).scalar()
    idf = df.select("term", F.log((total + 1) / (F.col("df") + 1)).alias("idf"))
    return counts.join(F.broadcast(idf), "term").select(key, "term", "n", (F.col("n") * F.col("idf")).alias("weight"))  # at most most_terms rows


def latent_vectors(weights: DataFrame, key: str, factors: int = 32) -> DataFrame:
    """``key, vector``: documents in the space of the strongest ``factors`` singular vectors of their weights, of length 1 each before.

    The singular vectors are fitted on all documents. A document's terms are brought together once; fit and projection
    are array operations over them. Documents without terms have no vector.
    """
    lists = written(weights.groupBy(key).agg(F.collect_list("term").alias("t"), F.collect_list("weight").alias("w")), "weights")
    terms = pa.array([r["term"] for r in lists.select(F.explode("t").alias("term")).distinct().orderBy("term").collect()], pa.string())  # bounded by tf_idf
    size = len(terms)

    def units(batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
        """Of the documents of a length over 0: which they are, their numbers of terms, and the terms' numbers and weights."""
        n = batch.column("t").value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        code = pc.index_in(batch.column("t").flatten().cast(pa.string()), value_set=terms).to_numpy(zero_copy_only=False).astype(np.int64)
        w, doc = batch.column("w").flatten().to_numpy(zero_copy_only=False), np.repeat(np.arange(len(n)), n)
        length = np.sqrt(np.bincount(doc, weights=w * w, minlength=len(n)))
        some = length[doc] > 0
        return np.flatnonzero(length > 0), n[length > 0], code[some], w[some] / length[doc[some]]

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram = np.zeros(size * size)
        for batch in batches:
            _, n, code, w = units(batch)
            # each term of a document with each
            times = np.repeat(n, n)
            a = np.repeat(np.arange(len(code)), times)
            b = np.repeat(np.repeat(np.cumsum(n) - n, n) - np.cumsum(times) + times, times) + np.arange(times.sum())
            gram += np.bincount(code[a] * size + code[b], weights=w[a] * w[b], minlength=size * size)
        yield pa.RecordBatch.from_arrays([pa.array([gram.tobytes()], pa.binary())], ["gram"])

    # GRAM_PARTS squares of the bounded number of terms
    parts = lists.select("t", "w").coalesce(GRAM_PARTS).mapInArrow(products, "gram binary").collect()
    gram = sum((np.frombuffer(r["gram"]).reshape(size, size) for r in parts), np.zeros((size, size)))
    v = np.linalg.eigh(gram)[1][:, ::-1][:, :factors]  # the right singular vectors, strongest first

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs, n, code, w = units(batch)
            if len(docs):
                sums = np.add.reduceat(w[:, None] * v[code], np.cumsum(n) - n)
                offsets = np.arange(len(docs) + 1, dtype=np.int32) * v.shape[1]
                yield pa.RecordBatch.from_arrays([batch.column(key).take(pa.array(docs)), pa.ListArray.from_arrays(pa.array(offsets), pa.array(sums.ravel()))], [key, "vector"])

    return lists.mapInArrow(project, f"{key} {dict(weights.dtypes)[key]}, vector array<double>")


def city_score(pairs: DataFrame, key: Sequence[str], left: str, right: str, matrix: DataFrame, capitals: DataFrame) -> DataFrame:
    """``key, city_score``: the best score over the cross product of two arrays of cities; 0 where no pair has one.

    ``matrix``: ``a, b, score``; ``capitals``: ``state, capital``. A pair that isn't in the matrix is looked up with the capital of
    the first place if that is a state, else with the capital of the second. Scores are looked up once for each distinct pair of places.
    """
    every = pairs.select(*key, F.explode_outer(left).alias("a"), right).select(*key, "a", F.explode_outer(right).alias("b"))
    distinct = every.select("a", "b").distinct()
    cap = lambda side: broadcastable(capitals.select(F.col("state").alias(side), F.col("capital").alias(f"cap_{side}")))
    score = lambda a, b, name: matrix.select(F.col("a").alias(a), F.col("b").alias(b), F.col("score").alias(name))
    looked = (
        distinct.join(score("a", "b", "s0"), ["a", "b"], "left").join(cap("a"), "a", "left").join(cap("b"), "b", "left")
        .join(score("cap_a", "b", "s1"), ["cap_a", "b"], "left").join(score("a", "cap_b", "s2"), ["a", "cap_b"], "left")
    )
    best = looked.select("a", "b", F.coalesce("s0", F.when(F.col("cap_a").isNotNull(), F.col("s1")).otherwise(F.col("s2"))).alias("s"))
    return every.join(best, ["a", "b"], "left").groupBy(*key).agg(F.coalesce(F.max("s"), F.lit(0.0)).alias("city_score"))


def best_common(scores: Column, keys: Column) -> Column:
    """The greatest value of a map over those of its keys that an array holds; null if there are none in common."""
    return F.array_max(F.transform(F.array_intersect(F.map_keys(scores), keys), lambda k: F.try_element_at(scores, k)))


def match_score(cosine: Column, city: Column, paid: Column, area: Column) -> Column:
    """A weighted sum of text, place and boost, and the text again by the score of the area."""
    return 0.7 * cosine + 0.2 * city + 0.1 * paid + cosine * area


def product_scores(similar: DataFrame, apps: DataFrame, linked: DataFrame, cut: int, **kw: object) -> DataFrame:
    """``user, item, score``: similar users x their applications x linked items, summed; sums below ``cut`` are dropped.

    ``similar``: ``user, other, sim``, and what ``linked_sums`` needs for ``kw``; ``apps``: ``user, item``; ``linked``: ``item, other, cosine``.
    Only the first product, of applications to items with links, is shuffled, by user.
    """
    live = apps.select(F.col("user").alias("other"), "item").distinct().join(broadcastable(linked.select("item").distinct()), "item", "left_semi")
    chosen = similar.join(live, "other").drop("other").withColumnRenamed("sim", "weight")
    return linked_sums(chosen, linked, least=cut, **kw)


def double_cut(rows: DataFrame, key: str, item: str, score: str, factor: Column, first: int, then: int) -> DataFrame:
    """The ``first`` rows of each key by ``score``, and of these the ``then`` best by score x ``factor`` (six places), as ``adjusted`` and ``rank``."""
    kept = top_k(rows, [key], [F.desc(score), F.asc(item)], first, "_r").drop("_r")
    return top_k(kept.withColumn("adjusted", F.round(F.col(score) * factor, 6)), [key], [F.desc("adjusted"), F.asc(item)], then)


def routed(a: DataFrame, b: DataFrame, key: str, n: int) -> DataFrame:
    """``key, route, main_a, main_b, second, outstanding``: two lists ``items`` of a key, cut in slices of ``n`` for their mailings.

    With both lists the first gives up what the second holds, and what is beyond its first slice is outstanding, or
    what is beyond the second's. With one list its first, second and third slices are main, second and outstanding.
    Empty slices are null.
    """
    both = a.select(key, F.col("items").alias("a")).join(b.select(key, F.col("items").alias("b")), key, "full")
    none = F.array().cast(dict(a.dtypes)["items"])
    x, y = F.coalesce("a", none), F.coalesce("b", none)
    both = both.select(key, F.when(F.size(y) == 0, "a").when(F.size(x) == 0, "b").otherwise("both").alias("route"), F.array_except(x, y).alias("x"), y.alias("y")).where((F.size("x") > 0) | (F.size("y") > 0))
    cut = lambda c, i: F.slice(c, i * n + 1, n)
    one = F.when(F.col("route") == "a", F.col("x")).otherwise(F.col("y"))
    late = F.when(F.size("x") > n, cut("x", 1)).when((F.size("x") > 0) & (F.size("y") > n), cut("y", 1))
    filled = lambda c: F.when(F.size(c) > 0, c)
    return both.select(
        key, "route", filled(cut("x", 0)).alias("main_a"), filled(cut("y", 0)).alias("main_b"),
        filled(F.when(F.col("route") != "both", cut(one, 1))).alias("second"), filled(F.when(F.col("route") == "both", late).otherwise(cut(one, 2))).alias("outstanding"),
    )


def accepted_edges(base: DataFrame, new: DataFrame, k: int) -> DataFrame:
    """The ``new`` edges (``u1, u2, sim``) that reach the k-th best similarity of their first end in ``base``; an end with fewer edges takes all."""
    last = top_k(base, ["u1"], [F.desc("sim"), F.asc("u2")], k).groupBy("u1").agg(F.count(F.lit(1)).alias("n"), F.min("sim").alias("bar"))
    return new.join(last, "u1", "left").where((F.coalesce("n", F.lit(0)) < k) | (F.col("sim") >= F.col("bar"))).select("u1", "u2", "sim")


def linked_updates(base: DataFrame, new: DataFrame) -> DataFrame:
    """``base`` with the similarities of the pairs it holds already taken from ``new``; other pairs of ``new`` are left out."""
    fresh = new.groupBy("u1", "u2").agg(F.max("sim").alias("fresh"))
    return base.join(fresh, ["u1", "u2"], "left").select("u1", "u2", F.coalesce("fresh", "sim").alias("sim"))


def appended_ids(known: DataFrame, keys: DataFrame, key: str, number: str) -> DataFrame:
    """``key, number``: the ids of ``known``, and for keys it lacks, in their order, those that follow its highest."""
    from marketlens.operators.relational import dense_text_index

    unseen = keys.select(key).where(F.col(key).isNotNull()).distinct().join(known.select(key), key, "left_anti")
    high = known.agg(F.coalesce(F.max(number), F.lit(0)).alias("h")).scalar()
    return known.select(key, F.col(number).cast("bigint").alias(number)).unionByName(dense_text_index(unseen, key).select(key, (high + F.col("index")).cast("bigint").alias(number)))


def transition_shares(rows: DataFrame, a: str, b: str) -> DataFrame:
    """``a, b, n, share``: counts of pairs, and their share of all with the same ``a``."""
    n = rows.where(F.col(a).isNotNull() & F.col(b).isNotNull()).groupBy(a, b).agg(F.count(F.lit(1)).alias("n"))
    return n.join(n.groupBy(a).agg(F.sum("n").alias("_t")), a).select(a, b, "n", F.round(F.col("n") / F.col("_t"), 6).alias("share"))
