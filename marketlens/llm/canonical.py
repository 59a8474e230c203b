"""Problem 6: freely typed values mapped to the entries of a reference list.

Partition-based pigeonhole join, in SQL only. A reference string that may differ from a typed one by k edits is cut into
k+1 segments, one of which the typed string must hold unchanged, at a position shifted by no more than k edits
allow; an equality join on those positional substrings finds all candidates, the built-in levenshtein verifies them,
and an anti-join reports the values that nothing matched. Words that people write around names are learned from the
values themselves: from those that are an entry and something else.
"""

from __future__ import annotations

import unicodedata
from itertools import permutations

from pyspark.sql import DataFrame

from marketlens.session import written

SHORTENED = {
    "mgmt": "management", "engg": "engineering", "maint": "maintenance", "docs": "documentation", "devt": "development",
    "prodn": "production", "admin": "administration", "ops": "operations", "mktg": "marketing",
}
COMPASS = {"n": "north", "s": "south", "e": "east", "w": "west"}
_FOLD = [(chr(c), b) for c in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00), *range(0xFF01, 0xFF5F)] if len(b := unicodedata.normalize("NFKD", chr(c))[0]) == 1 and b.isascii() and b.isalnum()]
"""Letters with marks, and full-width forms, with their plain form."""

#: Edits allowed in a string of the length; SWAPS more are taken, from SWAPS_FROM letters on, if they do nothing but swap letters (two swaps of neighbours are four edits).
ALLOWED = "CASE WHEN {n} <= 4 THEN 0 WHEN {n} <= 6 THEN 1 WHEN {n} <= 8 THEN 2 WHEN {n} <= 14 THEN 3 ELSE 4 END"
MOST_EDITS, SWAPS, SWAPS_FROM = 4, 4, 8
LEAST_PREFIX = 8
"""Letters of the shortest beginning that a cut value may stand for."""
LEAST_ENTRIES = 3
"""Words around a name are noise if they stand around so many different entries."""
MOST_ORDERED = 3
"""Entries of up to so many words are compared in every order; longer ones as they are and with their words sorted."""


def _steps(*queries: tuple[str, str], **frames: DataFrame) -> DataFrame:
    """The last of several named SQL queries, each of which may read those before it, and ``frames``, as ``{name}``."""
    spark = next(iter(frames.values())).sparkSession
    for name, query in queries:
        frames[name] = spark.sql(query, **{k: v for k, v in frames.items() if f"{{{k}}}" in query})
    return frames[name]


def _plain(column: str) -> str:
    """SQL: a value in plain lower-case letters and digits with single blanks; marks, tags, entities and formatting characters are dropped."""
    folded = f"translate({column}, '{''.join(a for a, _ in _FOLD)}', '{''.join(b for _, b in _FOLD)}')"
    bare = f"regexp_replace(regexp_replace(lower({folded}), '[\\\\pM\\\\u00AD\\\\u200B-\\\\u200F\\\\u2060\\\\uFEFF]', ''), '<[^>]*>|&#?[a-z0-9]+;', ' ')"
    return f"trim(regexp_replace({bare}, '[^a-z0-9]+', ' '))"


def _expanded(column: str) -> str:
    """SQL: with shortened words, and a leading letter for a point of the compass, written out."""
    for short, full in SHORTENED.items():
        column = f"regexp_replace({column}, '(?<![a-z0-9]){short}(?![a-z0-9])', '{full}')"
    for short, full in COMPASS.items():
        column = f"regexp_replace({column}, '^{short} ', '{full} ')"
    return column


def reference_variants(reference: DataFrame, least_prefix: int = LEAST_PREFIX) -> DataFrame:
    """``list, ref_id, key, sorted, order_cost, is_prefix``: each entry without blanks, in every order of up to MOST_ORDERED words, with longer ones' words sorted, and the beginnings of these."""
    orders = "CASE size(w) " + " ".join(
        f"WHEN {n} THEN array({', '.join('concat(' + ', '.join(f'w[{i}]' for i in p) + ')' for p in permutations(range(n)))})" for n in range(2, MOST_ORDERED + 1)
    ) + " ELSE array(array_join(w, '')) END"
    return _steps(
        ("plain", f"SELECT list, ref_id, {_plain('value')} AS words FROM {{r}}"),
        ("split", "SELECT list, ref_id, split(words, ' ') AS w FROM {plain} WHERE words <> ''"),
        ("ordered", f"SELECT list, ref_id, posexplode({orders}) AS (place, key) FROM {{split}}"),
        (
            "whole",
            f"""SELECT list, ref_id, key, false AS sorted, if(place = 0, 0, 1) AS order_cost, 0 AS is_prefix FROM {{ordered}}
            UNION ALL SELECT list, ref_id, array_join(array_sort(w), ''), true, 1, 0 FROM {{split}} WHERE size(w) > {MOST_ORDERED}""",
        ),
        ("ends", f"SELECT *, explode(sequence({least_prefix}, length(key) - 1)) AS n FROM {{whole}} WHERE length(key) > {least_prefix} AND NOT sorted"),
        ("all", "SELECT * FROM {whole} UNION ALL SELECT list, ref_id, left(key, n) AS key, sorted, order_cost, 1 AS is_prefix FROM {ends}"),
        r=reference,
    )


def noise(plain: DataFrame, reference: DataFrame, least_entries: int = LEAST_ENTRIES) -> DataFrame:
    """``side, phrase, n``: words that people write before ('b') or after ('a') names, digits as #, and their number; and for each side the empty phrase.

    ``plain``: ``list, p``, distinct typed values in plain words. A phrase is noise if it stands around ``least_entries``
    different entries and is no entry itself. Only names as long as the longest entry are cut off, from either end.
    """
    return _steps(
        ("known", f"SELECT DISTINCT list, {_plain('value')} AS words FROM {{r}}"),
        ("other", "SELECT t.list, split(t.p, ' ') AS w FROM {t} t LEFT ANTI JOIN {known} k ON t.list = k.list AND t.p = k.words"),
        ("long", "SELECT *, size(w) AS n, (SELECT coalesce(max(size(split(words, ' '))), 0) FROM {known}) AS most FROM {other}"),
        ("cuts", "SELECT *, explode(sequence(1, least(n - 1, most))) AS i FROM {long} WHERE n > 1 AND most > 0"),
        (
            "sides",
            """SELECT list, 'b' AS side, array_join(slice(w, 1, n - i), ' ') AS phrase, array_join(slice(w, n - i + 1, i), ' ') AS name FROM {cuts}
            UNION ALL SELECT list, 'a', array_join(slice(w, i + 1, n - i), ' '), array_join(slice(w, 1, i), ' ') FROM {cuts}""",
        ),
        ("met", "SELECT s.side, s.phrase, s.list, s.name FROM {sides} s JOIN {known} k ON s.list = k.list AND s.name = k.words"),
        ("unnamed", "SELECT m.* FROM {met} m LEFT ANTI JOIN {known} k ON m.phrase = k.words"),
        (
            "all",
            f"""SELECT side, regexp_replace(phrase, '[0-9]', '#') AS phrase, size(split(first(phrase), ' ')) AS n FROM {{unnamed}}
            GROUP BY side, regexp_replace(phrase, '[0-9]', '#') HAVING count(DISTINCT list, name) >= {least_entries}
            UNION ALL SELECT * FROM VALUES ('b', '', 0), ('a', '', 0)""",
        ),
        r=reference,
        t=plain,
    )


def typed_keys(typed: DataFrame, reference: DataFrame, least_entries: int = LEAST_ENTRIES) -> DataFrame:
    """``list, value, cut, key, sorted, strip_cost`` of the distinct typed values: plain, with noise taken off, and with over MOST_ORDERED words sorted.

    Noise before a name is taken off once, after it twice; of a value that the feed cut, also noise that is cut itself.
    The cost is the number of words taken off, and one more for noise that is cut.
    """
    plain = written(_steps(("plain", f"SELECT list, value, cut, {_expanded(_plain('value'))} AS p FROM (SELECT DISTINCT list, value, cut FROM {{t}})"), t=typed), "plain")
    words = written(noise(_steps(("p", "SELECT DISTINCT list, p FROM {t}"), t=plain), reference, least_entries), "noise")

    def stripped(source: str, side: str, phrases: str = "n", extra: str = "0") -> str:
        """SQL: what is left of each form of ``source`` without each phrase of a side that it begins or ends with, the empty one included."""
        taken, kept = ("slice(w, 1, i)", "slice(w, i + 1, size(w) - i)") if side == "b" else ("slice(w, size(w) - i + 1, i)", "slice(w, 1, size(w) - i)")
        return f"""SELECT f.list, f.value, f.cut, f.kept AS w, f.cost + f.i + {extra} AS cost FROM (
              SELECT *, {kept} AS kept, regexp_replace(array_join({taken}, ' '), '[0-9]', '#') AS taken
              FROM (SELECT *, explode(sequence(0, least(size(w) - 1, (SELECT max(n) FROM {{{phrases}}})))) AS i FROM {{{source}}})
            ) f JOIN {{{phrases}}} n ON f.taken = n.phrase AND n.side = '{side}'"""

    return _steps(
        # noise that is cut off itself: its beginnings
        (
            "beginnings",
            """SELECT 'a' AS side, phrase, max(n) AS n, 1 AS extra FROM (SELECT trim(left(phrase, i)) AS phrase, n FROM (SELECT *, explode(sequence(1, length(phrase) - 1)) AS i FROM {n} WHERE side = 'a' AND length(phrase) > 1))
            WHERE phrase <> '' GROUP BY phrase UNION ALL SELECT 'a', '', 0, 0""",
        ),
        ("given", "SELECT list, value, cut, split(p, ' ') AS w, 0 AS cost FROM {p} WHERE p <> ''"),
        ("before", stripped("given", "b")),
        ("after", stripped("before", "a")),
        ("twice", stripped("after", "a")),
        ("whole", "SELECT list, value, cut, w, min(cost) AS cost FROM {twice} GROUP BY list, value, cut, w"),
        ("ended", stripped("whole", "a", "beginnings", "n.extra") + " WHERE f.cut OR n.phrase = ''"),
        (
            "named",
            f"""SELECT list, value, cut, array_join(w, '') AS key, false AS sorted, cost FROM {{ended}}
            UNION ALL SELECT list, value, cut, array_join(array_sort(w), ''), true, cost FROM {{ended}} WHERE size(w) > {MOST_ORDERED}""",
        ),
        ("keys", "SELECT list, value, cut, key, sorted, min(cost) AS strip_cost FROM {named} WHERE key <> '' GROUP BY list, value, cut, key, sorted"),
        p=plain,
        n=words,
    )


def candidates(keys: DataFrame, variants: DataFrame) -> DataFrame:
    """``list, key, cut, sorted, ref_id, distance, order_cost, is_prefix``: all pairs within the edits that the reference string's length allows.

    Pairs that differ by swapped letters only meet by their sorted letters. Beginnings of entries are compared only with
    values that the feed cut off, strings of sorted words only with such.
    """
    tasks = keys.sparkSession.sparkContext.defaultParallelism
    near = _steps(
        ("allowed", f"SELECT *, length(key) AS size, {ALLOWED.format(n='length(key)')} AS k FROM {{v}}"),
        ("cuts", "SELECT *, explode(sequence(0, k)) AS i FROM {allowed}"),
        ("segments", "SELECT *, substring(key, i * size div (k + 1) + 1, (i + 1) * size div (k + 1) - i * size div (k + 1)) AS part FROM {cuts}"),
        # few bytes become many comparisons: they are spread before they grow
        ("typed", f"SELECT /*+ REPARTITION({tasks}, key) */ * FROM (SELECT DISTINCT list, key, cut, sorted FROM {{t}})"),
        ("sized", f"SELECT *, explode(sequence(greatest(1, length(key) - {MOST_EDITS}), length(key) + {MOST_EDITS})) AS size FROM {{typed}}"),
        ("budget", f"SELECT *, length(key) - size AS d, {ALLOWED.format(n='size')} AS k FROM {{sized}}"),
        ("pieces", "SELECT *, explode(sequence(0, k)) AS i FROM {budget} WHERE abs(d) <= k"),
        ("spans", "SELECT *, i * size div (k + 1) AS at, (i + 1) * size div (k + 1) - i * size div (k + 1) AS n FROM {pieces}"),
        # of k edits, those before the segment shift it, those after make up the rest of the difference in length
        ("placed", "SELECT *, explode(sequence(cast(ceil((d - k) / 2) AS int), cast(floor((d + k) / 2) AS int))) AS shift FROM {spans}"),
        (
            "probes",
            """SELECT list, key, cut, sorted, size, i, substring(key, cast(at + shift + 1 AS int), cast(n AS int)) AS part FROM {placed}
            WHERE at + shift >= 0 AND at + shift + n <= length(key)""",
        ),
        (
            "met",
            """SELECT p.list, p.key, p.cut, p.sorted, s.ref_id, levenshtein(p.key, s.key, s.k) AS distance, s.order_cost, s.is_prefix
            FROM {probes} p JOIN {segments} s ON p.list = s.list AND p.size = s.size AND p.i = s.i AND p.part = s.part AND p.sorted = s.sorted
            WHERE (s.is_prefix = 0 OR p.cut) AND levenshtein(p.key, s.key, s.k) BETWEEN 0 AND s.k""",
        ),
        v=variants,
        t=keys,
    )
    letters = "array_join(array_sort(split(key, '')), '')"
    return _steps(
        ("typed", f"SELECT DISTINCT list, key, cut, sorted, {letters} AS letters FROM {{t}} WHERE length(key) >= {SWAPS_FROM}"),
        ("known", f"SELECT *, {letters} AS letters FROM {{v}} WHERE length(key) >= {SWAPS_FROM}"),
        (
            "swapped",
            f"""SELECT t.list, t.key, t.cut, t.sorted, v.ref_id, levenshtein(t.key, v.key, {SWAPS}) AS distance, v.order_cost, v.is_prefix
            FROM {{typed}} t JOIN {{known}} v ON t.list = v.list AND t.letters = v.letters AND t.sorted = v.sorted
            WHERE (v.is_prefix = 0 OR t.cut) AND levenshtein(t.key, v.key, {SWAPS}) BETWEEN 0 AND {SWAPS}""",
        ),
        ("all", "SELECT * FROM {near} UNION SELECT * FROM {swapped}"),
        v=variants,
        t=keys,
        near=near,
    )


def canonical(typed: DataFrame, reference: DataFrame, least_prefix: int = LEAST_PREFIX, least_entries: int = LEAST_ENTRIES) -> DataFrame:
    """``src, rec_id, list, value, ref_id, distance``: the entry each typed value means; ref_id 0 and a null distance when none is near.

    ``typed``: ``src, rec_id, list, value, cut_at``; ``reference``: ``list, ref_id, value`` (``list`` names the reference list).
    Case, marks, width, tags, punctuation, blanks and their absence, word order and surrounding words (see ``noise``)
    make no difference; of several near entries the one with least edits wins, then the one that needs least stripping
    and reordering, then the lowest id. A value of ``cut_at`` characters (null: the source cuts nothing) may be the
    beginning of an entry, of ``least_prefix`` letters or more; a beginning that belongs to several entries alike means
    none. Null and blank values are no typed values and give no row; an empty reference leaves all unmatched.
    """
    typed = _steps(
        ("given", "SELECT src, rec_id, list, value, coalesce(length(value) >= cut_at, false) AS cut FROM {t} WHERE trim(regexp_replace(value, '[\\\\s\\\\pZ]+', ' ')) <> ''"), t=typed
    )
    keys = written(typed_keys(typed, reference, least_entries), "keys")
    best = _steps(
        (
            "ranked",
            """SELECT k.list, k.value, k.cut, n.ref_id, min(struct(n.distance, n.is_prefix, k.strip_cost + n.order_cost AS cost)) AS rank
            FROM {keys} k JOIN {near} n ON k.list = n.list AND k.key = n.key AND k.cut = n.cut AND k.sorted = n.sorted GROUP BY k.list, k.value, k.cut, n.ref_id""",
        ),
        ("by_rank", "SELECT list, value, cut, rank, min(ref_id) AS ref_id, count(*) AS alike FROM {ranked} GROUP BY list, value, cut, rank"),
        ("firsts", "SELECT list, value, cut, min(struct(rank, ref_id, alike)) AS f FROM {by_rank} GROUP BY list, value, cut"),
        ("best", "SELECT list, value, cut, f.ref_id AS ref_id, f.rank.distance AS distance FROM {firsts} WHERE f.alike = 1 OR f.rank.is_prefix = 0"),
        keys=keys,
        near=candidates(keys, reference_variants(reference, least_prefix)),
    )
    return _steps(
        (
            "result",
            """SELECT t.src, t.rec_id, t.list, t.value, b.ref_id, b.distance FROM {typed} t JOIN {best} b ON t.list = b.list AND t.value = b.value AND t.cut = b.cut
            UNION ALL
            SELECT t.src, t.rec_id, t.list, t.value, cast(0 AS bigint) AS ref_id, cast(null AS int) AS distance
            FROM {typed} t LEFT ANTI JOIN {best} b ON t.list = b.list AND t.value = b.value AND t.cut = b.cut""",
        ),
        typed=typed,
        best=written(best, "best"),
    )


RECRUITER_LISTS, PREFERENCE_LISTS = {3: "skill", 12: "subfa", 13: "city"}, {3: "skill", 10: "subfa", 8: "city"}  # fixed values
PREFERENCE_CUT = 20  # fixed value: characters the preference feed keeps


def typed_values(df: DataFrame, source: str, key: str, kind: str, code: str, value: str, lists: dict[int, str], cut_at: int | None = None) -> DataFrame:
    """``src, rec_id, list, value, cut_at`` of the rows whose code is null or 0, of the kinds in ``lists``."""
    named = " ".join(f"WHEN {n} THEN '{name}'" for n, name in lists.items())
    return _steps(
        (
            "typed",
            f"""SELECT '{source}' AS src, cast({key} AS bigint) AS rec_id, CASE {kind} {named} END AS list, {value} AS value, cast({cut_at or 'null'} AS int) AS cut_at
            FROM {{t}} WHERE {kind} IN ({", ".join(map(str, lists))}) AND coalesce({code}, 0) = 0""",
        ),
        t=df,
    )
