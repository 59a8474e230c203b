import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from marketlens.llm.mixture import _first_beyond, token_counts, weighted_mix
from marketlens.llm.subjects import Chunk, document_subjects, labelled_documents, thresholds

TARGETS = [("A", 0.5, 1), ("b_b", 0.3, 3), ("c", 0.2, 10), ("none", 0.1, 2), ("never", 0.1, 0), ("zero", 0.0, 2), (None, 0.4, 1), ("nan", None, 1)]


def sizes(spark, rows):
    return spark.createDataFrame([(*r, 9.0) for r in rows], "doc_id bigint, source string, tokens bigint, target_share double")


def test_mix_keeps_repeats_order_and_budget(spark):
    rng = random.Random(4)
    rows = [(i, rng.choice(("a", "a", "a", "b_b", "c", "never", None, "unknown")), rng.randrange(0, 400)) for i in range(800)]
    targets = spark.createDataFrame(TARGETS, "source string, target_share double, max_repeats int")
    mix, report = weighted_mix(sizes(spark, rows), targets)
    got, total = mix.collect(), sum(r[2] for r in rows)
    size = Counter()
    for _, s, n in rows:
        size[s] += n
    weight, most = {"a": 0.5, "b_b": 0.3, "c": 0.2, "none": 0.1, "never": 0.1}, {"a": 1, "b_b": 3, "c": 10, "none": 2, "never": 0}
    assert sum(r.tokens for r in got) <= total and len({(r.doc_id, r["pass"]) for r in got}) == len(got)
    # brute force: the copies in order of finish time, cut at the budget
    upto, copies = Counter(), []
    base = {r.doc_id: r.finish * weight[r.source] for r in got if r["pass"] == 0}
    assert all(r["pass"] < most[r.source] for r in got)
    for r in got:
        assert r.finish == pytest.approx((r["pass"] * size[r.source] + base[r.doc_id]) / weight[r.source])
    for r in sorted((r for r in got if r["pass"] == 0), key=lambda r: (r.source, r.finish, r.doc_id)):
        upto[r.source] += r.tokens
        copies.append(upto[r.source] <= size[r.source])
    assert all(copies)
    line = {r.source: r for r in report.collect()}
    assert set(line) == set(weight)
    for s, r in line.items():
        assert r.size_tokens == size[s] and r.reachable == (size[s] * most[s] / weight[s] >= total)
        assert r.mixed_tokens == sum(x.tokens for x in got if x.source == s) <= size[s] * most[s]
        assert r.actual_share == pytest.approx(r.mixed_tokens / sum(x.tokens for x in got))
    cut = max(r.finish for r in got)
    for s in (s for s, r in line.items() if r.reachable and r.last_finish > cut):  # what a source gives is its weight times the time of the cut, to a document
        assert abs(line[s].mixed_tokens - weight[s] * cut) <= 400


def test_mix_of_skewed_shares(spark, monkeypatch):
    """A tiny share, many repeats and short stretches: the same cut as by sorting all copies."""
    monkeypatch.setattr("marketlens.llm.mixture.ROWS_PER_BUCKET", 20)
    rng = random.Random(8)
    rows = [(i, rng.choice(("a",) * 30 + ("b_b", "c")), rng.choice((0, 0, rng.randrange(300)))) for i in range(600)]
    targets = spark.createDataFrame([("a", 0.9, 1), ("b_b", 1e-6, 2), ("c", 0.099999, 1000)], "source string, target_share double, max_repeats int")
    mix, report = weighted_mix(sizes(spark, rows), targets)
    total = sum(r[2] for r in rows)
    got = sorted(mix.collect(), key=lambda r: (r.finish, r.source, r.doc_id, r["pass"]))
    upto, copies = Counter(), []
    size = Counter()
    for _, s, n in rows:
        size[s] += n
    for i, s, n in sorted(rows, key=lambda r: (int(hashlib.md5(f"{r[0]}:0".encode()).hexdigest()[:15], 16), r[0])):
        upto[s] += n
        w, k = {"a": (0.9, 1), "b_b": (1e-6, 2), "c": (0.099999, 1000)}[s]
        copies += [((p * size[s] + upto[s]) / w, s, i, p, n) for p in range(k)]
    want, spent = [], 0
    for c in sorted(copies):
        spent += c[4]
        if spent > total:
            break
        want.append(c)
    assert [(r.finish, r.source, r.doc_id, r["pass"], r.tokens) for r in got] == want
    assert {r.source: r.reachable for r in report.collect()} == {"a": size["a"] >= 0.9 * total, "b_b": 2 * size["b_b"] >= 1e-6 * total, "c": 1000 * size["c"] >= 0.099999 * total}
    assert _first_beyond(mix, total - 1, 1) == _first_beyond(mix, total - 1, 10**6)


def test_mix_of_nothing(spark):
    targets = spark.createDataFrame(TARGETS, "source string, target_share double, max_repeats int")
    mix, report = weighted_mix(sizes(spark, []), targets)
    assert mix.count() == 0 and {r.mixed_tokens for r in report.collect()} == {0}
    mix, report = weighted_mix(sizes(spark, [(1, "a", 5)]), targets.limit(0))
    assert mix.count() == 0 and report.count() == 0


def test_token_counts(spark):
    docs = spark.createDataFrame([(1, " Job-Desc", "hello world"), (2, "job_desc", None), (3, None, ""), (4, " ", "<|endoftext|>"), (5, "x", "word " * 200_000)], "doc_id bigint, source string, text string").selectExpr("*", "1 AS tokens")
    got = {r.doc_id: (r.source, r.tokens) for r in token_counts(docs).collect()}
    assert got[1] == ("job_desc", 2) and got[2] == ("job_desc", 0) and got[3] == (None, 0) and got[4][0] is None and got[4][1] > 1 and got[5][1] >= 200_000


VOCAB = {"law": ["pleading motions", "court hearing", "lease agreement", "cross examining witnesses"], "sport": ["relay squad", "timing laps", "match day", "refereeing matches"], "software": ["debugging crashes", "code base", "message queue", "unit test"]}
DESCRIBED = [("law", "Courts and contracts"), ("sport", "Games and athletes"), ("software", "Computer programs")]


def corpus(seed=6, n=240):
    rng, docs, truth = random.Random(seed), [], []
    general = ["We reply to every applicant within days", "There is a canteen and a quiet room", "The notice period is long"]
    for i in range(n):
        kinds = rng.sample(sorted(VOCAB), rng.choice((1, 1, 2)))
        lines = [f"Work on {rng.choice(VOCAB[k])} and look after the {rng.choice(VOCAB[k])} daily" for k in kinds for _ in range(5)] + rng.sample(general, 2)
        if len(kinds) == 1 and rng.random() < 0.3:
            other = rng.choice([k for k in VOCAB if k not in kinds])
            lines.append(f"Once saw a {rng.choice(VOCAB[other])} nearby")
        rng.shuffle(lines)
        docs.append((i, ". ".join(lines)))
        truth += [(i, k) for k in kinds]
    return docs, truth


def test_subjects_found(spark):
    docs, truth = corpus()
    labels = [(i, k.upper() + " ", 1) for i, k in truth if i % 5 == 0] + [(1, None, 1), (None, "law", 1), (2, "unheard", 1)]
    docs += [(1000, None), (1001, ""), (1002, "We reply to every applicant within days. " * 50), (None, "court hearing"), (1003, "The court hearing and the lease agreement. " * 3000)]
    d = spark.createDataFrame(docs, "doc_id bigint, text string").withColumn("subject", F.lit("clash"))
    table = document_subjects(d, spark.createDataFrame(labels, "doc_id bigint, subject string, labeller int"), spark.createDataFrame(DESCRIBED, "subject string, description string"))
    got = {(r.doc_id, r.subject) for r in table.collect()}
    want = set(truth) | {(1003, "law")}
    hit = len(got & want)
    assert hit / len(want) > 0.97 and hit / len(got) > 0.97


def test_three_subjects_and_calibrated_thresholds(spark):
    docs, truth = corpus(9)
    three = [(2000 + i, ". ".join(f"Work on {VOCAB[k][j]} and look after the {VOCAB[k][j + 1]} daily" for k in VOCAB for j in range(3))) for i in range(3)]
    d = spark.createDataFrame(docs + three, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, k, 1) for i, k in truth], "doc_id bigint, subject string, labeller int")
    subjects = spark.createDataFrame(DESCRIBED, "subject string, description string")
    got = {(r.doc_id, r.subject) for r in document_subjects(d, labels, subjects).collect()}
    assert {(2000, k) for k in VOCAB} <= got
    assert max(Counter(i for i, _ in {(r.doc_id, r.subject) for r in document_subjects(d, labels, subjects, most=2).collect()}).values()) == 2
    shares = spark.createDataFrame([(i, "law", 3, 0.24 if i < 10 else 0.21 if i < 20 else 0.9) for i in range(40)] + [(100, "sport", 3, 0.5), (101, "sport", 3, 0.29)], "doc_id bigint, subject string, sentences bigint, share double")
    named = spark.createDataFrame([(i, " Law") for i in range(40) if not 10 <= i < 20] + [(100, "sport")], "doc_id bigint, subject string")
    assert {tuple(r) for r in thresholds(shares, shares, named).collect()} == {("law", 0.24), ("sport", 0.24)}  # of two labels of its own, those of all subjects decide


def test_phrases_equal_brute_force():
    texts = ["A b a b. C a b; a b c", "", "b b b\nd a b c d"]
    chunk = Chunk(texts)
    want = Counter()
    for doc, lines in enumerate([["a b a b", "c a b", "a b c"], [], ["b b b", "d a b c d"]]):
        for line in lines:
            w = line.split()
            want.update({(" ".join(w[i : i + n]), doc) for n in (1, 2, 3) for i in range(len(w) - n + 1)})
    found = chunk.phrases(chunk.sentence, chunk.doc)
    assert dict(zip(zip(found[0].to_pylist(), found[1].tolist(), strict=True), found[2].tolist(), strict=True)) == want


def test_every_term_of_a_large_lexicon_counts(spark, monkeypatch):
    name = lambda i: "x" + "".join("abcdefghij"[int(c)] for c in f"{i:05d}")
    lines = [[name(100 * k + i) for i in range(100)] for k in range(200)]  # about 60,000 phrases
    docs = [(3 * k + j, f"Court lawyer {' '.join(x)}.") for k, x in enumerate(lines) for j in range(3)]
    docs.append((5000, f"{' '.join(lines[-1][-9:-5])}. {' '.join(lines[-1][-4:])}."))
    d = spark.createDataFrame(docs, "doc_id bigint, text string")
    labels, subjects = spark.createDataFrame([], "doc_id bigint, subject string"), spark.createDataFrame(DESCRIBED, "subject string, description string")
    got = {tuple(r) for r in document_subjects(d, labels, subjects).collect()}
    assert (5000, "law", 2, 1.0) in got
    monkeypatch.setattr("marketlens.llm.subjects.BLOCK_TERMS", 1 << 20)
    assert {tuple(r) for r in document_subjects(d, labels, subjects).collect()} == got


def test_subjects_of_nothing(spark):
    labels, subjects = spark.createDataFrame([], "doc_id bigint, subject string"), spark.createDataFrame(DESCRIBED, "subject string, description string")
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert document_subjects(docs, labels, subjects).count() == 0
    assert document_subjects(docs, labels, subjects.limit(0)).count() == 0


def test_all_labelled_documents_are_fitted_or_held_out(spark):
    """More labels than the 20,000 that were taken before."""
    labels = spark.range(25_000).select(F.col("id").alias("doc_id"), F.lit("law").alias("subject"))
    rows = labelled_documents(labels, ["law"])
    assert rows.count() == 25_000 and 4_000 < rows.where("held_out").count() < 6_000
