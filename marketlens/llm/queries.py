"""Queries of the operators in this subpackage, and their equivalents in SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.llm import canonical as c
from marketlens.llm import cooccurrence, leakage, mixture, subjects, top_bands
from marketlens.session import table, written


def p2_associations(spark: SparkSession, d: str) -> DataFrame:
    """Every pair of skills named together."""
    return cooccurrence.associations(table(spark, d, "jobs"), "jobid", cooccurrence.skill_list(F.col("keyskills")))


def p2_chunked_associations(spark: SparkSession, d: str) -> DataFrame:
    """The same with chunks of eight skills: many jobs name more, and take the way of huge baskets."""
    return cooccurrence.associations(table(spark, d, "jobs"), "jobid", cooccurrence.skill_list(F.col("keyskills")), 8)


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    """Pairs in 1 % of the jobs or more, at three times chance or more."""
    frequent = p2_associations(spark, d).where("100 * n_ab >= n_baskets AND n_ab * n_baskets >= 3 * n_a * n_b")
    return frequent.select(F.col("item_a").alias("skill_a"), F.col("item_b").alias("skill_b"))


def p5_top_suggestions(spark: SparkSession, d: str) -> DataFrame:
    jobs = table(spark, d, "jobsuggestions").select("_id", F.explode("sj").alias("s"))
    pairs = table(spark, d, "similarprofiles")
    rows = top_bands.scored(jobs, F.col("_id"), F.col("s.job"), F.col("s.cossim"), "jobsuggestions").unionByName(
        top_bands.scored(pairs, F.col("u1"), F.col("u2"), F.col("overall_sim"), "similarprofiles")
    )
    return top_bands.top_items(rows).withColumn("rank", F.col("rank").cast("bigint"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return p5_top_suggestions(spark, d).select("src", "group_id", "item_id")


def _reference(spark: SparkSession, d: str) -> DataFrame:
    return spark.sql(
        """SELECT 'city' AS list, cast(city_id AS bigint) AS ref_id, city_desc AS value FROM {city}
        UNION ALL SELECT 'skill', cast(skill_id AS bigint), skill_desc FROM {skill}
        UNION ALL SELECT 'subfa', cast(sub_field_id AS bigint), sub_field_enu FROM {area}""",
        city=table(spark, d, "lookup_city"), skill=table(spark, d, "lookup_skill"), area=table(spark, d, "lookup_subfunctionalarea"),
    )


def p6_mapped(spark: SparkSession, d: str) -> DataFrame:
    attributes = c.typed_values(table(spark, d, "recruiter_jobattribute"), "recruiter_jobattribute", "attid", "atttype", "attvalue", "attvaluecustom", c.RECRUITER_LISTS)
    preferences = c.typed_values(table(spark, d, "candidatepreferences"), "candidatepreferences", "candidatepreferencesid", "t", "v", "valuecustom", c.PREFERENCE_LISTS, c.PREFERENCE_CUT)
    return c.canonical(spark.sql("SELECT * FROM {a} UNION ALL SELECT * FROM {p}", a=attributes, p=preferences), _reference(spark, d))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return p6_mapped(spark, d).select("src", "rec_id", "ref_id")


def p6_unmatched(spark: SparkSession, d: str) -> DataFrame:
    """The typed values that mean no entry, with the number of rows of each."""
    return spark.sql("SELECT src, list, value, count(*) AS n_rows FROM {m} WHERE ref_id = 0 GROUP BY src, list, value", m=p6_mapped(spark, d))


def p7_leaks(spark: SparkSession, d: str) -> DataFrame:
    return leakage.leaks(table(spark, d, "documents"), table(spark, d, "benchmark"))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return p7_leaks(spark, d).select("doc_id", "item_id")


def p7_verbatim(spark: SparkSession, d: str) -> DataFrame:
    """Documents that hold twenty words or more of an item in a row, by the suffix arrays alone."""
    return leakage.verbatim_copies(table(spark, d, "documents"), table(spark, d, "benchmark"))


def p7_clean_documents(spark: SparkSession, d: str) -> DataFrame:
    """The documents that hold no test item."""
    return leakage.without_leaks(table(spark, d, "documents"), p7_leaks(spark, d)).select("doc_id", "source", "n_chars")


def _mix(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    sizes = written(mixture.token_counts(table(spark, d, "documents")), "tokens")
    return mixture.weighted_mix(sizes, table(spark, d, "mix_targets"))


def p8_mixture(spark: SparkSession, d: str) -> DataFrame:
    """The mixture in its order."""
    return _mix(spark, d)[0].orderBy("finish", "source", "doc_id", "pass")


def p8_report(spark: SparkSession, d: str) -> DataFrame:
    return _mix(spark, d)[1]


def _char_mix(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    docs = table(spark, d, "documents")
    sizes = docs.select("doc_id", mixture.source_key(F.col("source")).alias("source"), F.coalesce(F.length("text"), F.lit(0)).cast("bigint").alias("tokens"))
    return mixture.weighted_mix(written(sizes, "sizes"), table(spark, d, "mix_targets"))


def p8_char_mixture(spark: SparkSession, d: str) -> DataFrame:
    """The mixture with sizes in characters, which SQL can count."""
    return _char_mix(spark, d)[0]


def p8_char_report(spark: SparkSession, d: str) -> DataFrame:
    return _char_mix(spark, d)[1].drop("last_finish")


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    """Sources with no copy left in the queue at the moment of the fair cut: they can't reach their share."""
    return p8_report(spark, d).where("NOT reachable").select("source")


def p9_subjects(spark: SparkSession, d: str) -> DataFrame:
    return subjects.document_subjects(table(spark, d, "documents"), table(spark, d, "labels"), table(spark, d, "subjects"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    """A document's subjects, two at most, as the cases are defined."""
    return subjects.document_subjects(table(spark, d, "documents"), table(spark, d, "labels"), table(spark, d, "subjects"), most=2).select("doc_id", "subject")


def p9_agreement(spark: SparkSession, d: str) -> DataFrame:
    """Held-out labels by subject, and those that name an assigned subject."""
    return subjects.held_out_agreement(table(spark, d, "documents"), table(spark, d, "labels"), table(spark, d, "subjects"))


def p9_composition(spark: SparkSession, d: str) -> DataFrame:
    """The corpus by subject: documents, and documents weighed by the subject's share of them."""
    return p9_subjects(spark, d).groupBy("subject").agg(F.count(F.lit(1)).alias("n_docs"), F.round(F.sum("share"), 4).alias("weight"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        p2_associations, p2_chunked_associations, p2_found, p5_top_suggestions, p5_found, p6_mapped, p6_found, p6_unmatched, p7_leaks, p7_found, p7_verbatim, p7_clean_documents,
        p8_mixture, p8_report, p8_found, p8_char_mixture, p8_char_report, p9_subjects, p9_found, p9_agreement, p9_composition,
    )
}

_SKILLS = """
WITH parts AS (SELECT jobid, unnest(regexp_split_to_array(lower(keyskills), '[,;|]')) AS x FROM jobs WHERE jobid IS NOT NULL),
s AS (SELECT DISTINCT jobid, trim(regexp_replace(x, '[\\s\\x{A0}\\x{85}\\x{200B}\\pZ-]+', ' ', 'g')) AS skill FROM parts),
k AS (SELECT * FROM s WHERE skill NOT IN ('', 'na', 'null', 'none')),
n AS (SELECT skill, count(*) AS n FROM k GROUP BY 1),
p AS (SELECT a.skill AS item_a, b.skill AS item_b, count(*) AS n_ab FROM k a JOIN k b ON a.jobid = b.jobid AND a.skill < b.skill GROUP BY 1, 2),
r AS (SELECT item_a, item_b, x.n AS n_a, y.n AS n_b, n_ab, (SELECT count(DISTINCT jobid) FROM k) AS n_baskets
  FROM p JOIN n x ON x.skill = item_a JOIN n y ON y.skill = item_b)
"""
_TOP = """
WITH u AS (
  SELECT 'jobsuggestions' AS src, _id::BIGINT AS group_id, s.job::BIGINT AS item_id, s.cossim::INTEGER AS score FROM (SELECT _id, unnest(sj) AS s FROM jobsuggestions)
  UNION ALL SELECT 'similarprofiles', u1::BIGINT, u2::BIGINT, overall_sim::INTEGER FROM similarprofiles),
o AS (SELECT src, group_id, item_id, max(score) AS score FROM u WHERE score BETWEEN 0 AND 1000 AND group_id <> item_id GROUP BY 1, 2, 3),
r AS (SELECT *, row_number() OVER (PARTITION BY src, group_id ORDER BY score DESC, item_id) AS rank FROM o)
"""
_COPIES = """
WITH i AS (SELECT item_id, regexp_extract_all(lower(text), '[a-z0-9]+') AS w FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL),
d AS (SELECT doc_id, regexp_extract_all(lower(text), '[a-z0-9]+') AS w FROM documents WHERE doc_id IS NOT NULL AND text IS NOT NULL),
ig AS (SELECT item_id, p, array_to_string(w[p:p+19], ' ') AS g FROM (SELECT *, unnest(range(1, len(w) - 18)) AS p FROM i)),
dg AS (SELECT doc_id, p, array_to_string(w[p:p+19], ' ') AS g FROM (SELECT *, unnest(range(1, len(w) - 18)) AS p FROM d)),
m AS (SELECT DISTINCT doc_id, item_id, ig.p AS p, dg.p - ig.p AS diagonal FROM ig JOIN dg USING (g)),
s AS (SELECT *, p - row_number() OVER (PARTITION BY doc_id, item_id, diagonal ORDER BY p) AS run FROM m),
r AS (SELECT doc_id, item_id, count(*) + 19 AS n FROM s GROUP BY doc_id, item_id, diagonal, run)
SELECT doc_id, item_id, starts, longest FROM (SELECT doc_id, item_id, count(DISTINCT p) AS starts FROM m GROUP BY 1, 2) JOIN (SELECT doc_id, item_id, max(n) AS longest FROM r GROUP BY 1, 2) USING (doc_id, item_id)
"""
_MIX = r"""
WITH k AS (SELECT doc_id, nullif(replace(trim(regexp_replace(lower(source), '[\s\pZ_-]+', ' ', 'g')), ' ', '_'), '') AS source, coalesce(length(text), 0)::BIGINT AS tokens FROM documents),
t AS (SELECT nullif(replace(trim(regexp_replace(lower(source), '[\s\pZ_-]+', ' ', 'g')), ' ', '_'), '') AS source, sum(target_share) AS target_share, max(greatest(coalesce(max_repeats, 1), 0)) AS max_repeats
  FROM mix_targets WHERE target_share > 0 GROUP BY 1 HAVING source IS NOT NULL),
z AS (SELECT sum(tokens)::BIGINT AS budget FROM k), s AS (SELECT source, sum(tokens)::BIGINT AS size_tokens FROM k GROUP BY 1),
o AS (SELECT doc_id, source, tokens, sum(tokens) OVER (PARTITION BY source ORDER BY ('0x' || substr(md5(doc_id || ':0'), 1, 15))::BIGINT, doc_id, tokens ROWS UNBOUNDED PRECEDING)::BIGINT AS upto FROM k WHERE source IS NOT NULL),
c AS (SELECT doc_id, source, unnest(range(max_repeats))::INTEGER AS pass, tokens, size_tokens, target_share, upto FROM o JOIN s USING (source) JOIN t USING (source)),
q AS (SELECT doc_id, source, pass, tokens, (pass * size_tokens + upto) / target_share AS finish FROM c),
e AS (SELECT *, sum(tokens) OVER (ORDER BY finish, source, doc_id, pass ROWS UNBOUNDED PRECEDING) AS upto FROM q),
m AS (SELECT doc_id, source, pass, tokens, finish FROM e, z WHERE upto <= budget)
"""
_PLAIN_SQL = (
    "trim(regexp_replace(regexp_replace(regexp_replace(lower(translate({}, '" + "".join(a for a, _ in c._FOLD) + "', '" + "".join(b for _, b in c._FOLD) + "')), "
    r"'[\pM\x{{AD}}\x{{200B}}-\x{{200F}}\x{{2060}}\x{{FEFF}}]', '', 'g'), '<[^>]*>|&#?[a-z0-9]+;', ' ', 'g'), '[^a-z0-9]+', ' ', 'g'))"
)
_WORD_SQL = "CASE x " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in c.SHORTENED.items()) + " ELSE x END"
_FIRST_SQL = "CASE WHEN len(w) > 1 THEN list_prepend(CASE w[1] " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in c.COMPASS.items()) + " ELSE w[1] END, w[2:]) ELSE w END"


def _stripped_sql(source: str, side: str, phrases: str, extra: str) -> str:
    taken, kept = ("w[1:i]", "w[i + 1:]") if side == "b" else ("w[len(w) - i + 1:]", "w[1:len(w) - i]")
    return f"""SELECT f.list, f.value, f.cut, f.kept AS w, f.cost + f.i + {extra} AS cost FROM (SELECT *, {kept} AS kept, regexp_replace(array_to_string({taken}, ' '), '[0-9]', '#', 'g') AS taken
    FROM (SELECT *, unnest(range(0, len(w))) AS i FROM {source})) f JOIN {phrases} n ON f.taken = n.phrase AND n.side = '{side}'"""


#: All values against all forms of all entries, by levenshtein.
_MAPPED = f"""
WITH given AS (
  SELECT 'recruiter_jobattribute' AS src, attid::BIGINT AS rec_id, CASE atttype WHEN 3 THEN 'skill' WHEN 12 THEN 'subfa' ELSE 'city' END AS list, attvaluecustom AS value, false AS cut
  FROM recruiter_jobattribute WHERE atttype IN (3, 12, 13) AND coalesce(attvalue, 0) = 0
  UNION ALL SELECT 'candidatepreferences', candidatepreferencesid::BIGINT, CASE t WHEN 3 THEN 'skill' WHEN 10 THEN 'subfa' ELSE 'city' END, valuecustom, coalesce(length(valuecustom) >= {c.PREFERENCE_CUT}, false)
  FROM candidatepreferences WHERE t IN (3, 10, 8) AND coalesce(v, 0) = 0),
typed AS (SELECT * FROM given WHERE trim(regexp_replace(value, '[\\s\\pZ]+', ' ', 'g')) <> ''),
ref AS (SELECT 'city' AS list, city_id::BIGINT AS ref_id, {_PLAIN_SQL.format('city_desc')} AS words FROM lookup_city UNION ALL SELECT 'skill', skill_id, {_PLAIN_SQL.format('skill_desc')} FROM lookup_skill
  UNION ALL SELECT 'subfa', sub_field_id, {_PLAIN_SQL.format('sub_field_enu')} FROM lookup_subfunctionalarea),
known AS (SELECT DISTINCT list, words FROM ref WHERE words <> ''),
p0 AS (SELECT list, value, cut, list_transform(string_split({_PLAIN_SQL.format('value')}, ' '), lambda x: {_WORD_SQL}) AS w FROM (SELECT DISTINCT list, value, cut FROM typed)),
p AS (SELECT list, value, cut, string_split(array_to_string({_FIRST_SQL}, ' '), ' ') AS w FROM p0),
o AS (SELECT DISTINCT list, w FROM p WHERE NOT EXISTS (SELECT 1 FROM known k WHERE k.list = p.list AND k.words = array_to_string(p.w, ' '))),
cuts AS (SELECT list, w, unnest(range(1, len(w))) AS i FROM o),
sides AS (SELECT list, 'b' AS side, array_to_string(w[1:i], ' ') AS phrase, array_to_string(w[i + 1:], ' ') AS name FROM cuts UNION ALL SELECT list, 'a', array_to_string(w[i + 1:], ' '), array_to_string(w[1:i], ' ') FROM cuts),
n AS (SELECT side, regexp_replace(phrase, '[0-9]', '#', 'g') AS phrase, 0 AS extra FROM sides s JOIN known k ON s.list = k.list AND s.name = k.words WHERE phrase NOT IN (SELECT words FROM known)
  GROUP BY 1, 2 HAVING count(DISTINCT s.list || ':' || name) >= {c.LEAST_ENTRIES} UNION ALL VALUES ('b', '', 0), ('a', '', 0)),
e AS (SELECT DISTINCT 'a' AS side, trim(left(phrase, i)) AS phrase, 1 AS extra FROM (SELECT phrase, unnest(range(1, length(phrase))) AS i FROM n WHERE side = 'a') WHERE trim(left(phrase, i)) <> '' UNION ALL SELECT 'a', '', 0),
f0 AS (SELECT list, value, cut, w, 0 AS cost FROM p WHERE array_to_string(w, '') <> ''),
f1 AS ({_stripped_sql('f0', 'b', 'n', '0')}), f2 AS ({_stripped_sql('f1', 'a', 'n', '0')}), f3 AS ({_stripped_sql('f2', 'a', 'n', '0')}),
f4 AS (SELECT list, value, cut, w, min(cost) AS cost FROM f3 GROUP BY ALL),
f5 AS ({_stripped_sql('f4', 'a', 'e', 'n.extra')} WHERE f.cut OR n.phrase = ''),
keys AS (SELECT list, value, cut, key, sorted, min(cost) AS cost FROM (SELECT list, value, cut, array_to_string(w, '') AS key, false AS sorted, cost FROM f5
  UNION ALL SELECT list, value, cut, array_to_string(list_sort(w), ''), true, cost FROM f5 WHERE len(w) > 3) WHERE key <> '' GROUP BY ALL),
rw AS (SELECT list, ref_id, string_split(words, ' ') AS w FROM ref WHERE words <> ''),
v0 AS (SELECT list, ref_id, array_to_string(w, '') AS key, false AS sorted, 0 AS cost FROM rw
  UNION ALL SELECT list, ref_id, unnest([w[2] || w[1]]), false, 1 FROM rw WHERE len(w) = 2
  UNION ALL SELECT list, ref_id, unnest([w[1] || w[3] || w[2], w[2] || w[1] || w[3], w[2] || w[3] || w[1], w[3] || w[1] || w[2], w[3] || w[2] || w[1]]), false, 1 FROM rw WHERE len(w) = 3
  UNION ALL SELECT list, ref_id, array_to_string(list_sort(w), ''), true, 1 FROM rw WHERE len(w) > 3),
v AS (SELECT *, 0 AS is_prefix FROM v0 UNION ALL SELECT list, ref_id, left(key, i), sorted, cost, 1 FROM (SELECT *, unnest(range({c.LEAST_PREFIX}, length(key))) AS i FROM v0 WHERE NOT sorted)),
near AS (SELECT k.list, k.value, k.cut, v.ref_id, levenshtein(k.key, v.key) AS distance, v.is_prefix, k.cost + v.cost AS cost, length(v.key) AS size, list_sort(string_split(k.key, '')) = list_sort(string_split(v.key, '')) AS swapped
  FROM keys k JOIN v ON k.list = v.list AND k.sorted = v.sorted AND (v.is_prefix = 0 OR k.cut) AND length(v.key) BETWEEN length(k.key) - 4 AND length(k.key) + 4),
good AS (SELECT list, value, cut, ref_id, distance, is_prefix, cost FROM near WHERE distance <= {c.ALLOWED.format(n='size')} OR (swapped AND size >= {c.SWAPS_FROM} AND distance <= {c.SWAPS})),
one AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY list, value, cut, ref_id ORDER BY distance, is_prefix, cost) AS r FROM good) WHERE r = 1),
first AS (SELECT *, row_number() OVER (PARTITION BY list, value, cut ORDER BY distance, is_prefix, cost, ref_id) AS place, count(*) OVER (PARTITION BY list, value, cut, distance, is_prefix, cost) AS alike FROM one),
m AS (SELECT t.src, t.rec_id, t.list, t.value, coalesce(b.ref_id, 0)::BIGINT AS ref_id, b.distance::INTEGER AS distance FROM typed t
  LEFT JOIN (SELECT * FROM first WHERE place = 1 AND (alike = 1 OR is_prefix = 0)) b ON t.list = b.list AND t.value = b.value AND t.cut = b.cut)
"""
SQL: dict[str, str] = {
    "p6_mapped": _MAPPED + "SELECT * FROM m",
    "p6_found": _MAPPED + "SELECT src, rec_id, ref_id FROM m",
    "p6_unmatched": _MAPPED + "SELECT src, list, value, count(*) AS n_rows FROM m WHERE ref_id = 0 GROUP BY 1, 2, 3",
    "p8_char_mixture": _MIX + "SELECT * FROM m",
    "p8_char_report": _MIX + """SELECT t.source, t.target_share, t.max_repeats, coalesce(size_tokens, 0) AS size_tokens, NOT (max_repeats * coalesce(size_tokens, 0) < target_share * budget) AS reachable,
        coalesce(x.n, 0)::BIGINT AS mixed_tokens, coalesce(x.n, 0) / (SELECT sum(tokens) FROM m) AS actual_share
        FROM t LEFT JOIN s USING (source) LEFT JOIN (SELECT source, sum(tokens) AS n FROM m GROUP BY 1) x USING (source), z""",
    "p7_verbatim": _COPIES,
    "p2_associations": _SKILLS + "SELECT *, (n_ab * n_baskets) / (n_a * n_b) AS ratio FROM r",
    "p2_chunked_associations": _SKILLS + "SELECT *, (n_ab * n_baskets) / (n_a * n_b) AS ratio FROM r",
    "p2_found": _SKILLS + "SELECT item_a AS skill_a, item_b AS skill_b FROM r WHERE 100 * n_ab >= n_baskets AND n_ab * n_baskets >= 3 * n_a * n_b",
    "p5_top_suggestions": _TOP + "SELECT * FROM r WHERE rank <= 10",
    "p5_found": _TOP + "SELECT src, group_id, item_id FROM r WHERE rank <= 10",
}
