import random

from marketlens.llm.canonical import candidates, canonical

REFERENCE = [("city", 1, "Upper Livovane"), ("city", 2, "Upper Livovano"), ("city", 3, "Krevifell"), ("skill", 1, "curriculum maintenance"), ("skill", 2, "curriculum documentation"), ("skill", 3, "tolmistboard"), ("skill", 4, "field tender audit"), ("skill", 5, "night shift route planning"), ("city", 5, None)]


NOISE = ("good at {}", "knowledge of {}", "near {}", "{} (metro area)", "{} - 40021", "{} (2 yrs)", "{} expert", "{} team")
LEARNED = [(name, phrase.format(value)) for phrase in NOISE for name, _, value in REFERENCE if value and name == "city"]
"""Values from which the noise is learned."""


def table(spark, typed, cut_at=None):
    rows = [("t", i, name, value, cut_at, 0) for i, (name, value) in enumerate([*typed, *LEARNED])]
    return spark.createDataFrame(rows, "src string, rec_id bigint, list string, value string, cut_at int, ref_id int"), spark.createDataFrame(REFERENCE, "list string, ref_id bigint, value string")


def found(typed, reference, n):
    return [r for r in canonical(typed, reference).orderBy("rec_id").collect() if r.rec_id < n]


def test_forms_of_a_name(spark):
    cases = {
        ("city", " UPPER  livovane."): 1, ("city", "upper livovano"): 2, ("city", "Krévifell<br/>"): 3, ("city", "near Ｋｒｅｖｉｆｅｌｌ"): 3, ("city", "Krevifell (metro area)"): 3, ("city", "kre​vi­fell - 40021"): 3,
        ("skill", "maintenance, curriculum"): 1, ("skill", "curriculummaintenance"): 1, ("skill", "good at tolmsitboard (2 yrs)"): 3, ("skill", "tlomisbtoard"): 3, ("skill", "audit tender field"): 4, ("skill", "fidld etnder audit"): 4, ("skill", "route planning, night shift"): 5, ("skill", "planning rouet shift night"): 5,
        ("skill", "curriculum document."): 2, ("skill", "Krevifell"): 0, ("skill", "n/a"): 0, ("city", "??"): 0, ("skill", "x" * 50_000): 0, ("other", "Krevifell"): 0,
    }
    typed, reference = table(spark, list(cases) * 2, 20)
    got = found(typed, reference, 2 * len(cases))
    assert len(got) == 2 * len(cases)
    assert {(r.list, r.value): r.ref_id for r in got} == cases


def test_cut_values(spark):
    cut = [("skill", "curriculum maintenan"), ("skill", "knowledge of curricul"), ("skill", "tolmistboard - exper"), ("skill", "night shift route pl")]
    typed, reference = table(spark, cut, 20)
    assert [r.ref_id for r in found(typed, reference, 4)] == [1, 0, 3, 5]
    typed, reference = table(spark, cut)
    assert found(typed, reference, 4)[3].ref_id == 0


def test_nulls_blanks_and_empty_tables(spark):
    typed, reference = table(spark, [("city", None), ("city", "  \t"), (None, "x"), ("city", "Krevifell"), ("city", "word " * 3000)])
    assert [(r.rec_id, r.ref_id) for r in found(typed, reference, 5) if r.list] == [(3, 3), (4, 0)]
    assert canonical(typed.limit(0), reference).count() == 0
    assert {r.ref_id for r in canonical(typed, reference.limit(0)).collect()} == {0}


def test_pigeonhole_loses_no_near_pair(spark):
    """All pairs within the allowed edits by brute force."""
    rng = random.Random(11)
    names = ["".join(rng.choice("abcd") for _ in range(rng.randrange(5, 18))) for _ in range(30)]

    def edit(w):
        for _ in range(rng.randrange(4)):
            i = rng.randrange(len(w))
            w = rng.choice((w[:i] + w[i + 1 :], w[:i] + "z" + w[i:], w[:i] + "y" + w[i + 1 :])) or "q"
        return w

    typed = sorted({edit(w) for w in names})
    keys = spark.createDataFrame([("l", w, False, False) for w in typed], "list string, key string, cut boolean, sorted boolean")
    variants = spark.createDataFrame([("l", i, w, False, 0, 0) for i, w in enumerate(names)], "list string, ref_id bigint, key string, sorted boolean, order_cost int, is_prefix int")
    limit = lambda n: 0 if n <= 4 else 1 if n <= 6 else 2 if n <= 8 else 3 if n <= 14 else 4

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            prev, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                prev, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, prev + (x != y))
        return row[-1]

    want = {(t, i) for t in typed for i, w in enumerate(names) if distance(t, w) <= limit(len(w)) or (distance(t, w) <= 4 and sorted(t) == sorted(w) and len(w) > 7)}
    assert {(r.key, r.ref_id) for r in candidates(keys, variants).collect()} == want
