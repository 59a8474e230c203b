import random

import numpy as np
import pytest

from marketlens.llm.leakage import TestItems as Items
from marketlens.llm.leakage import leaks, verbatim_copies, without_leaks, words

RNG = random.Random(2)
WORDS = ["".join(RNG.choice("bcdfglmnprst") + RNG.choice("aeiou") for _ in range(3)) for _ in range(900)]
LINE = "Read the passage below and pick the answer that fits best."


def sentence(n=14):
    return " ".join(RNG.choice(WORDS) for _ in range(n)).capitalize() + "."


ITEMS = [(i, f"{LINE} " + " ".join(sentence() for _ in range(5))) for i in range(12)]
FILL = [sentence() for _ in range(40)]


def filler(n=6):
    return " ".join(RNG.sample(FILL, n))


def changed(text, every=11):
    w = text.split()
    return " ".join("other" if i % every == 5 else x for i, x in enumerate(w))


def test_kinds_of_leaks(spark):
    text = dict(ITEMS)
    parts = lambda i: text[i].split(". ")
    docs = {
        0: filler() + " " + text[0] + " " + filler(),
        1: filler() + " " + " ".join(text[1].split()[20:45]),  # part of an item
        2: filler() + " " + changed(text[2]),  # words changed
        3: filler() + f" {parts(3)[4]}. {filler(2)} {parts(3)[2]}.",  # two sentences, not in order
        4: filler().join(("<p>", "</p>")) + text[4].upper().replace(" ", "&nbsp;"),
        5: text[5].replace("a", "а").replace("e", "е"),  # look-alike letters
        6: filler() + " " + LINE,  # a line that all items share
        7: filler() + " " + " ".join(text[7].split()[20:28]),  # too short
        8: "", 9: None, 10: filler(30) * 40 + text[10] + filler(30) * 40,
        11: changed(text[8], 7),
    }
    df = spark.createDataFrame([*docs.items(), (0, docs[0])], "doc_id bigint, text string").selectExpr("*", "1 AS item_id", "'x' AS words")
    bench = spark.createDataFrame([*ITEMS, (99, None), (98, ""), ITEMS[0]], "item_id bigint, text string")
    found = leaks(df, bench)
    assert {(r.doc_id, r.item_id) for r in found.collect()} == {(i, i) for i in (0, 1, 2, 3, 4, 5, 10)} | {(11, 8)}
    assert {r.doc_id for r in without_leaks(df, found).collect()} == {6, 7, 8, 9}
    longest = {r.doc_id: (r.longest, r.place) for r in found.collect()}
    assert longest[0][0] == len(words(text[0])) and longest[0][1] == len(words(docs[0][: docs[0].index(LINE)]))
    by = {r.doc_id: r.found_by for r in found.collect()}
    assert by[0] == by[1] == by[2] == "suffix array" and by[11] == "alignment"
    # which lines are shared and which words common doesn't depend on the blocks
    assert sorted(map(tuple, leaks(df, bench, block_chars=2500).collect())) == sorted(map(tuple, found.collect()))


def test_neighbouring_passages_in_any_order(spark):
    lines = [[sentence(n) for n in (15, 14, 13, 12)] for _ in range(6)]
    bench = spark.createDataFrame([(i, f"{LINE} " + " ".join(x)) for i, x in enumerate(lines)], "item_id bigint, text string")
    orders = {0: (1, 0), 1: (2, 1, 0), 2: (3, 2, 1, 0), 3: (1, 3, 0, 2), 4: (0, 1), 5: (0,)}
    docs = {i: f"{filler(3)} {' '.join(lines[i][k] for k in order)} {filler(3)}" for i, order in orders.items()}
    docs[6] = f"{filler(3)} {lines[5][0]} {filler(3)} {lines[5][0]}"  # one sentence twice
    found = leaks(spark.createDataFrame([*docs.items()], "doc_id bigint, text string"), bench)
    assert {(r.doc_id, r.item_id, r.words) for r in found.collect()} == {(0, 0, 29), (1, 1, 42), (2, 2, 54), (3, 3, 54), (4, 4, 29)}


def test_empty_tables(spark):
    docs, bench = spark.createDataFrame([(1, ITEMS[0][1])], "doc_id bigint, text string"), spark.createDataFrame(ITEMS, "item_id bigint, text string")
    assert leaks(docs.limit(0), bench).count() == 0 and leaks(docs, bench.limit(0)).count() == 0


@pytest.mark.parametrize("least", [1, 2, 4])
def test_suffix_arrays_equal_brute_force(least):
    rng = random.Random(least)
    for _ in range(150):
        items = Items([(i, 0, [rng.choice("abc") for _ in range(rng.randrange(1, 15))], False) for i in range(3)], set(), least)
        text = np.array([rng.randrange(0, 4) for _ in range(rng.randrange(1, 80))])
        want = set()
        for a in range(len(text)):
            for b in range(len(items.ids)):
                n = 0
                while a + n < len(text) and items.ids[b + n] > 0 and text[a + n] == items.ids[b + n]:
                    n += 1
                if n >= least and not (a and b and items.ids[b - 1] > 0 and text[a - 1] == items.ids[b - 1]):
                    want.add((a, b, n))
        assert set(zip(*(x.tolist() for x in items.search(text)), strict=True)) == want


def test_verbatim_copies(spark):
    text = dict(ITEMS)
    docs = [(1, "x " + text[1].upper()), (2, changed(text[2])), (3, None), (4, "")]
    df, bench = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame([*ITEMS, (99, None)], "item_id bigint, text string")
    for chars in (1 << 20, 2500):
        n = len(words(text[1]))
        assert [tuple(r) for r in verbatim_copies(df, bench, block_chars=chars).collect()] == [(1, 1, n - 19, n)]
