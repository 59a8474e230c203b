"""Queries of the general training-data operators (problems 1, 3 and 4)."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.functions.keys import whole_key
from marketlens.operators.entity_features import ACTIVITY_TYPES, candidate_features, plausible
from marketlens.operators.heavy_keys import hot_keys, key_totals
from marketlens.session import table
from marketlens.sources.rejecting_csv import CANDIDATE_COLUMNS, accepted, load_candidates, rejected


def p1_candidate_features(spark: SparkSession, d: str) -> DataFrame:
    return candidate_features(table(spark, d, "candidatematchinc"), table(spark, d, "activityinc"))


def p1_absurd_dates(spark: SparkSession, d: str) -> DataFrame:
    """How many dates of each column ``p1_candidate_features`` takes for absurd, and drops."""
    parts = []
    for name, columns in (("candidatematchinc", ("matchdate", "applicationdate")), ("activityinc", ("activitydate",))):
        df = table(spark, d, name)
        taken = [F.count_if(F.col(c).isNotNull() & plausible(F.col(c), F.col("feed_day"), 730, 31).isNull()).alias(c) for c in columns]
        parts += [df.agg(*taken).select(F.lit(c).alias("column"), F.col(c).alias("n_absurd")) for c in columns]
    return reduce(DataFrame.unionByName, parts)


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return rejected(load_candidates(table(spark, d, "candidatestatic_raw")))


def p3_loaded(spark: SparkSession, d: str) -> DataFrame:
    return accepted(load_candidates(table(spark, d, "candidatestatic_raw")))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    parts = [
        hot_keys(table(spark, d, name), whole_key(F.col(key))).select(F.lit(name).alias("src"), F.col("key").cast("string").alias("hot_key"))
        for name, key in (("candidatematchinc", "jobid"), ("activityinc", "companyid"))
    ]
    return parts[0].unionByName(parts[1])


def p4_job_totals(spark: SparkSession, d: str) -> DataFrame:
    df = table(spark, d, "candidatematchinc")
    return key_totals(df, whole_key(F.col("jobid")), F.col("isapply") == 1, F.col("matchdate")).withColumnsRenamed(
        {"key": "jobid", "n_flagged": "n_applied", "last_ts": "last_match"}
    )


def p4_company_totals(spark: SparkSession, d: str) -> DataFrame:
    df = table(spark, d, "activityinc")
    return key_totals(df, whole_key(F.col("companyid")), F.col("type") == 2, F.col("activitydate")).withColumnsRenamed(
        {"key": "companyid", "n_flagged": "n_type_2", "last_ts": "last_activity"}
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (p1_candidate_features, p1_absurd_dates, p3_found, p3_loaded, p4_found, p4_job_totals, p4_company_totals)
}

_BLANKS = "concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13), chr(160), chr(8203))"
_USER = f"nullif(nullif(nullif(nullif(lower(trim(userid, {_BLANKS})), ''), '0'), 'none'), 'null')"


def _plausible(ts: str) -> str:
    return f"CASE WHEN coalesce(date_diff('day', {ts}::DATE, feed_day) > 730 OR date_diff('day', feed_day, {ts}::DATE) > 31, false) THEN NULL ELSE {ts} END"


_KINDS = ["match", "application", *(f"type_{t}" for t in ACTIVITY_TYPES)]
_P1 = f"""
WITH m AS (
  SELECT {_USER} AS user_id, isapply, {_plausible('matchdate')} AS md, {_plausible('applicationdate')} AS ad
  FROM (SELECT *, row_number() OVER (PARTITION BY candidatematchid ORDER BY feed_day DESC NULLS LAST, isapply DESC NULLS LAST,
    matchdate DESC NULLS LAST, applicationdate DESC NULLS LAST, {_USER} DESC NULLS LAST) AS rn FROM candidatematchinc) WHERE rn = 1 OR candidatematchid IS NULL
), a AS (
  SELECT {_USER} AS user_id, type, {_plausible('activitydate')} AS ts
  FROM (SELECT *, row_number() OVER (PARTITION BY activityid ORDER BY feed_day DESC NULLS LAST, type DESC NULLS LAST,
    activitydate DESC NULLS LAST, {_USER} DESC NULLS LAST) AS rn FROM activityinc) WHERE rn = 1 OR activityid IS NULL
), e AS (
  SELECT user_id, 'match' AS kind, md AS ts FROM m
  UNION ALL SELECT user_id, 'application', ad FROM m WHERE isapply = 1
  UNION ALL SELECT user_id, 'type_' || type, ts FROM a WHERE type BETWEEN 2 AND 99
)
SELECT user_id, count(*) AS n_total, max(ts) AS last_total,
  {", ".join(f"count(*) FILTER (kind = '{k}') AS n_{k}, max(ts) FILTER (kind = '{k}') AS last_{k}" for k in _KINDS)}
FROM e WHERE user_id IS NOT NULL GROUP BY user_id
"""


def _whole(c: str) -> str:
    text = f"trim({c}::VARCHAR, {_BLANKS})"
    return f"nullif(nullif(CASE WHEN regexp_full_match({text}, '[+-]?[0-9]+(\\.0*)?') THEN TRY_CAST(regexp_replace({text}, '\\.0*$', '') AS BIGINT) END, 0), -1)"


_P4_FOUND = " UNION ALL ".join(
    f"SELECT '{t}' AS src, k::VARCHAR AS hot_key FROM (SELECT {_whole(c)} AS k, count(*) AS n FROM {t} GROUP BY 1) WHERE k IS NOT NULL AND n * 100 >= 2 * (SELECT count(*) FROM {t})"
    for t, c in (("candidatematchinc", "jobid"), ("activityinc", "companyid"))
)
_FIELD = r'(?:[^",]*|"(?:[^"]|"")*")'
_MISSING = "('', 'NULL', 'NONE', 'NA')"
_TIDY = "concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13), chr(160))"
_CONTROL = r"[\x00-\x09\x0B-\x1F\x7F-\x{9F}\x{FFFD}]"
_P3_STEPS = f"""
WITH r AS (
  SELECT rec_id, coalesce(raw_line, '') AS raw, TRY_CAST(strptime(regexp_extract(file_name, '([0-9]{{8}})\\.', 1), '%Y%m%d') AS DATE) AS feed_day FROM candidatestatic_raw
), s AS (
  SELECT *, regexp_full_match(raw, '(?s){_FIELD}(?:,{_FIELD})*') AS ok, regexp_extract_all(',' || raw, '(?s),("(?:[^"]|"")*"|[^",]*)', 1) AS f FROM r
), c AS (
  SELECT *, list_transform(f, lambda x: CASE WHEN x[1] = '"' THEN replace(x[2:-2], '""', '"') ELSE x END) AS v FROM s
), t AS (
  SELECT *, CASE WHEN upper(trim(v[9], {_TIDY})) IN {_MISSING} THEN '' ELSE trim(v[9], {_TIDY}) END AS login FROM c
), u AS (
  SELECT *, CASE
    WHEN regexp_full_match(login, '\\d{{4}}-\\d\\d-\\d\\d \\d\\d:\\d\\d:\\d\\d') THEN try_strptime(login, '%Y-%m-%d %H:%M:%S')
    WHEN regexp_full_match(login, '\\d{{4}}-\\d\\d-\\d\\dT\\d\\d:\\d\\d:\\d\\dZ') THEN try_strptime(login, '%Y-%m-%dT%H:%M:%SZ')
    WHEN regexp_full_match(login, '\\d\\d[A-Za-z]{{3}}\\d{{4}}:\\d\\d:\\d\\d:\\d\\d') THEN try_strptime(login, '%d%b%Y:%H:%M:%S') END AS seen FROM t
), x AS (
SELECT *, CASE WHEN NOT ok THEN 'quoting' WHEN len(f) <> 12 THEN 'column_count' ELSE 'invalid_value' END AS why,
  NOT ok OR len(f) <> 12
  OR upper(trim(v[2], {_TIDY})) IN {_MISSING} OR length(v[2]) > 250 OR NOT regexp_full_match(v[2], '[\\p{{L}}\\p{{M}} ''’.-]*')
  OR length(v[11]) > 100 OR regexp_matches(v[11], '{_CONTROL}') OR length(v[12]) > 250 OR regexp_matches(v[12], '{_CONTROL}')
  OR (login <> '' AND (seen IS NULL OR coalesce(seen::DATE > feed_day, false))) AS bad FROM u
)
"""
_P3 = _P3_STEPS + "SELECT rec_id, why AS reason FROM x WHERE bad"


def _loaded(i: int, name: str) -> str:
    if name == "LastLogin":
        return f"seen AS {name}"
    text = f"trim(v[{i + 1}], ' ')"
    value = f"TRY_CAST({text} AS INTEGER)" if name in ("CandidateLocation", "Experience", "Salary") else f"TRY_CAST({text} AS DATE)" if name == "RegistrationStartDate" else text
    return f"CASE WHEN upper({text}) NOT IN {_MISSING} THEN {value} END AS {name}"


_P3_LOADED = _P3_STEPS + f"SELECT rec_id, {', '.join(_loaded(i, c) for i, c in enumerate(CANDIDATE_COLUMNS))} FROM x WHERE NOT bad"

SQL: dict[str, str] = {
    "p1_candidate_features": _P1,
    "p1_absurd_dates": " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) FILTER ({c} IS NOT NULL AND ({_plausible(c)}) IS NULL) AS n_absurd FROM {t}"
        for t, c in (("candidatematchinc", "matchdate"), ("candidatematchinc", "applicationdate"), ("activityinc", "activitydate"))
    ),
    "p3_found": _P3,
    "p3_loaded": _P3_LOADED,
    "p4_found": _P4_FOUND,
    "p4_job_totals": f"SELECT {_whole('jobid')} AS jobid, count(*) AS n_rows, count(*) FILTER (isapply = 1) AS n_applied, max(matchdate) AS last_match FROM candidatematchinc GROUP BY 1 HAVING jobid IS NOT NULL",
    "p4_company_totals": f"SELECT {_whole('companyid')} AS companyid, count(*) AS n_rows, count(*) FILTER (type = 2) AS n_type_2, max(activitydate) AS last_activity FROM activityinc GROUP BY {_whole('companyid')} HAVING {_whole('companyid')} IS NOT NULL",
}
SQL["p4_job_totals"] = SQL["p4_job_totals"].replace("GROUP BY 1 HAVING jobid IS NOT NULL", f"GROUP BY {_whole('jobid')} HAVING {_whole('jobid')} IS NOT NULL")
