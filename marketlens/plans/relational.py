"""Scans, filters, joins, aggregations, rankings, set and incremental operations on the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlens.functions.dates import segment, younger_than
from marketlens.functions.keys import entity_id, portable_hash
from marketlens.operators import incremental as inc
from marketlens.operators import relational as rel
from marketlens.plans.registry import Registry
from marketlens.sources import files

R = Registry()
ASOF = "2015-10-01"

# --- sources and filters


@R.query("S1 S2 F2", "SELECT userid, emailalertstatus, bouncestatus FROM candidatestaticinc WHERE emailalertstatus IN (1, 3) AND bouncestatus = 0 AND spamstatus <> 1")
def scan_projection(t):  # noqa: ANN001, ANN202
    return rel.scan(t("candidatestaticinc"), "emailalertstatus IN (1, 3) AND bouncestatus = 0 AND spamstatus <> 1", ["userid", "emailalertstatus", "bouncestatus"])


@R.query("S3", "SELECT c_custkey, c_mktsegment FROM customer WHERE c_custkey % 4 = 0")
def sampling_scan(t):  # noqa: ANN001, ANN202
    return rel.scan(t("customer"), F.col("c_custkey") % 4 == 0, ["c_custkey", "c_mktsegment"])


@R.query("S4 L2", "SELECT o_orderkey, o_custkey, o_orderdate FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 1")
def last_record(t):  # noqa: ANN001, ANN202
    return t("orders").select("o_orderkey", "o_custkey", "o_orderdate").orderBy(F.desc("o_orderdate"), F.desc("o_orderkey")).limit(1)


@R.query("S5", "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey > 1000 ORDER BY o_orderkey LIMIT 100")
def keyset_page(t):  # noqa: ANN001, ANN202
    return rel.keyset_page(t("orders").select("o_orderkey", "o_custkey"), "o_orderkey", 1000, 100)


@R.query("S6", "SELECT p_partkey, p_name FROM part ORDER BY p_partkey LIMIT 50 OFFSET 100")
def offset_page(t):  # noqa: ANN001, ANN202
    return t("part").select("p_partkey", "p_name").orderBy("p_partkey").offset(100).limit(50)


@R.query("S8", "SELECT count(*) AS n, count(DISTINCT o_orderkey) AS n_keys FROM orders")
def unique_key(t):  # noqa: ANN001, ANN202
    return t("orders").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("o_orderkey").alias("n_keys"))


@R.query("S17", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def csv_round_trip(t):  # noqa: ANN001, ANN202
    return files.csv_round_trip(t("customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"))


@R.query("S18", "SELECT p_partkey, p_brand, p_size FROM part")
def bulk_parts(t):  # noqa: ANN001, ANN202
    return files.written_in_parts(t("part").select("p_partkey", "p_brand", "p_size"), 4)


@R.query(
    "W11",
    """SELECT feed_day, date_diff('day', lag(feed_day) OVER (ORDER BY feed_day), feed_day)::INTEGER AS gap
    FROM (SELECT DISTINCT feed_day FROM activityinc WHERE feed_day IS NOT NULL)""",
)
def feed_gaps(t):  # noqa: ANN001, ANN202
    days = t("activityinc").select("feed_day").where("feed_day IS NOT NULL").distinct()  # one row a day
    return days.select("feed_day", F.datediff("feed_day", F.lag("feed_day").over(Window.orderBy("feed_day"))).alias("gap"))


@R.query("S12", "SELECT max(file_name) AS file_name, max(regexp_extract(file_name, '[0-9]{8}')) AS day FROM candidatestatic_raw")
def latest_file(t):  # noqa: ANN001, ANN202
    day = F.regexp_extract("file_name", "[0-9]{8}", 0)
    return t("candidatestatic_raw").agg(F.max_by("file_name", day).alias("file_name"), F.max(day).alias("day"))


@R.query("U1", "SELECT doc_id, 'a' AS part FROM documents WHERE contains(text, 'guest') UNION ALL SELECT doc_id, 'b' FROM documents WHERE contains(text, 'patient')")
def assembled_lines(t):  # noqa: ANN001, ANN202
    docs = t("documents")
    return docs.where(F.contains("text", F.lit("guest"))).select("doc_id", F.lit("a").alias("part")).unionByName(docs.where(F.contains("text", F.lit("patient"))).select("doc_id", F.lit("b").alias("part")))


@R.query("S14", "SELECT jobid, publisheddate, regexp_replace(jobtitle, '[,|;\\r\\n\\t]+', ' ', 'g') AS title, regexp_replace(keyskills, '[,|;\\r\\n\\t]+', ' ', 'g') AS skills FROM jobs")
def scrubbed_export(t):  # noqa: ANN001, ANN202
    scrub = lambda c: F.regexp_replace(c, "[,|;\\r\\n\\t]+", " ")
    return t("jobs").select("jobid", "publisheddate", scrub("jobtitle").alias("title"), scrub("keyskills").alias("skills"))


@R.query("S19", "SELECT rec_id, len(regexp_split_to_array(raw_line, '[,|]'))::INTEGER AS n_fields FROM candidatestatic_raw")
def split_lines(t):  # noqa: ANN001, ANN202
    return t("candidatestatic_raw").select("rec_id", F.when(F.col("raw_line").isNotNull(), F.size(F.split("raw_line", "[,|]"))).alias("n_fields"))


@R.query("S22 A1 I13", "SELECT count(*) AS n, count(*) FILTER (isapply = 1) AS n_applied, count(*) FILTER (userid IS NULL) AS n_no_user, max(feed_day) AS last_day FROM candidatematchinc")
def run_log(t):  # noqa: ANN001, ANN202
    return t("candidatematchinc").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("isapply") == 1).alias("n_applied"), F.count_if(F.col("userid").isNull()).alias("n_no_user"), F.max("feed_day").alias("last_day")
    )


@R.query("F1 C3", "SELECT jobid AS job_id, coalesce(jobtitle, '') AS job_title, coalesce(nullif(trim(displayname), ''), 'unknown') AS job_company_name, coalesce(minexperience, 0) AS job_minexp FROM jobs")
def shaped_projection(t):  # noqa: ANN001, ANN202
    return t("jobs").select(
        F.col("jobid").alias("job_id"), F.coalesce("jobtitle", F.lit("")).alias("job_title"), F.coalesce(F.nullif(F.trim("displayname"), F.lit("")), F.lit("unknown")).alias("job_company_name"), F.coalesce("minexperience", F.lit(0)).alias("job_minexp")
    )


@R.query("F3 F4 I3", "SELECT userid, lastlogin, lastmodified FROM candidatestaticinc WHERE (lastlogin >= DATE '2015-09-30' AND lastlogin < DATE '2015-10-01') OR (lastmodified >= DATE '2015-09-30' AND lastmodified < DATE '2015-10-01')")
def changed_in_day(t):  # noqa: ANN001, ANN202
    return inc.changed_between(t("candidatestaticinc").select("userid", "lastlogin", "lastmodified"), ["lastlogin", "lastmodified"], F.lit("2015-09-30").cast("date"), F.lit("2015-10-01").cast("date"))


@R.query("F5", f"SELECT jobid, publisheddate, republisheddate FROM jobs WHERE coalesce(date_diff('day', publisheddate::DATE, DATE '{ASOF}') < 30, false) OR coalesce(date_diff('day', republisheddate::DATE, DATE '{ASOF}') < 30, false)")
def recently_published(t):  # noqa: ANN001, ANN202
    return t("jobs").where(younger_than(ASOF, 30, "publisheddate", "republisheddate")).select("jobid", "publisheddate", "republisheddate")


@R.query("F6", "SELECT userid, emailalertstatus FROM candidatestaticinc WHERE emailalertstatus NOT IN (1, 3) OR emailalertstatus IS NULL")
def negation_keeps_missing(t):  # noqa: ANN001, ANN202
    return t("candidatestaticinc").where(~F.coalesce(F.col("emailalertstatus").isin(1, 3), F.lit(False))).select("userid", "emailalertstatus")


@R.query("F13 F14", "SELECT userid FROM candidatematchinc WHERE regexp_full_match(trim(userid), '[0-9]+') OR length(trim(userid)) = 24")
def valid_ids(t):  # noqa: ANN001, ANN202
    return t("candidatematchinc").dropna(subset=["userid"]).where(F.trim("userid").rlike("^[0-9]+$") | (F.length(F.trim("userid")) == 24)).select("userid")


@R.query("F14", "SELECT a.jobid AS jobid, count(*) AS n_fit FROM jobs a JOIN candidatematchinc m ON a.jobid = m.jobid WHERE a.maxexperience - a.minexperience <= 2 AND a.publisheddate IS NOT NULL GROUP BY 1")
def gated_matches(t):  # noqa: ANN001, ANN202
    # matches are counted before the join, so that a job holding a tenth of them is one row
    per_job = t("candidatematchinc").groupBy("jobid").agg(F.count(F.lit(1)).alias("n"))
    jobs = t("jobs").where("maxexperience - minexperience <= 2 AND publisheddate IS NOT NULL").groupBy("jobid").agg(F.count(F.lit(1)).alias("k"))
    return jobs.join(per_job, "jobid").select("jobid", (F.col("n") * F.col("k")).alias("n_fit"))


@R.query("F16 F18 F19 C1", f"SELECT userid, CASE WHEN date_diff('day', lastlogin::DATE, DATE '{ASOF}') <= 92 THEN 'active' WHEN date_diff('day', lastlogin::DATE, DATE '{ASOF}') <= 183 THEN 'inactive' WHEN lastlogin IS NOT NULL THEN 'revival' END AS segment, CASE WHEN ismidout = 1 AND isresumemidout = 1 THEN 'ResumeMidOut' WHEN ismidout = 1 THEN 'MidOut' ELSE 'Activated' END AS state, CASE gender WHEN 1 THEN 'M' WHEN 2 THEN 'F' ELSE 'Not Set' END AS gender FROM candidatestaticinc")
def recency_segments(t):  # noqa: ANN001, ANN202
    state = F.when((F.col("ismidout") == 1) & (F.col("isresumemidout") == 1), "ResumeMidOut").when(F.col("ismidout") == 1, "MidOut").otherwise("Activated")
    gender = F.when(F.col("gender") == 1, "M").when(F.col("gender") == 2, "F").otherwise("Not Set")
    return t("candidatestaticinc").select("userid", segment(ASOF, F.col("lastlogin")).alias("segment"), state.alias("state"), gender.alias("gender"))


# --- joins


@R.query("J1 J3 J6", """SELECT jobid, jobtitle, sub_field_enu, city_desc FROM jobs j
    LEFT JOIN (SELECT jobid_id, min(attvalue) FILTER (atttype = 12) AS sub, min(attvalue) FILTER (atttype = 13) AS city FROM recruiter_jobattribute WHERE atttype IN (3, 12, 13) GROUP BY 1) a ON a.jobid_id = j.jobid
    LEFT JOIN lookup_subfunctionalarea s ON s.sub_field_id = a.sub LEFT JOIN lookup_city c ON c.city_id = a.city""")  # fmt: skip
def star_left_join(t):  # noqa: ANN001, ANN202
    attributes = t("recruiter_jobattribute").where(F.col("atttype").isin(3, 12, 13))
    one = attributes.groupBy("jobid_id").agg(F.min(F.when(F.col("atttype") == 12, F.col("attvalue"))).alias("sub"), F.min(F.when(F.col("atttype") == 13, F.col("attvalue"))).alias("city"))
    jobs, sub, city = t("jobs"), t("lookup_subfunctionalarea"), t("lookup_city")
    joined = jobs.join(one, jobs.jobid == one.jobid_id, "left").join(sub, F.col("sub") == sub.sub_field_id, "left").join(city, F.col("city") == city.city_id, "left")
    return joined.select("jobid", "jobtitle", "sub_field_enu", "city_desc")


@R.query("J4 A5", "SELECT o_custkey, sum(n)::BIGINT AS n, max(o_totalprice) AS most, min(st) AS least_status FROM (SELECT o_custkey, 1 AS n, o_totalprice, o_orderstatus, min(o_orderstatus) OVER (PARTITION BY o_custkey) AS st FROM orders) WHERE o_orderstatus = st GROUP BY 1")
def least_status_only(t):  # noqa: ANN001, ANN202
    o = t("orders").groupBy("o_custkey", "o_orderstatus").agg(F.count(F.lit(1)).alias("n"), F.max("o_totalprice").alias("most"))
    best = o.groupBy("o_custkey").agg(F.min(F.struct("o_orderstatus", "n", "most")).alias("m"))
    return best.select("o_custkey", "m.n", "m.most", F.col("m.o_orderstatus").alias("least_status"))


@R.query("J5 J21", "SELECT o_orderkey, c_name, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderdate >= DATE '1998-01-01' AND c_mktsegment IN ('BUILDING', 'MACHINERY')")
def filtered_join(t):  # noqa: ANN001, ANN202
    o = t("orders").where("o_orderdate >= DATE '1998-01-01'")
    c = t("customer").where(F.col("c_mktsegment").isin("BUILDING", "MACHINERY"))
    return o.join(c, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_name", "c_mktsegment")


@R.query("J7 A14 A16", """SELECT c_nationkey AS nation, count(*) FILTER (s = 'BUILDING') AS n_building, count(*) FILTER (s = 'MACHINERY') AS n_machinery, count(*) FILTER (s = 'o') AS n_orders,
    round(count(*) FILTER (s = 'o') * 100.0 / nullif(count(*) FILTER (s <> 'o'), 0), 4)::DOUBLE AS orders_per_100 FROM (SELECT c_nationkey, c_mktsegment AS s FROM customer UNION ALL SELECT c_nationkey, 'o' FROM orders JOIN customer ON o_custkey = c_custkey) GROUP BY 1""")  # fmt: skip
def vendor_funnel(t):  # noqa: ANN001, ANN202
    """Several pivots side by side, as one conditional aggregation for each input."""
    c, o = t("customer"), t("orders")
    left = rel.conditional_counts(c, ["c_nationkey"], "c_mktsegment", ["BUILDING", "MACHINERY"], "n_").join(c.groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("_all")), "c_nationkey", "full")
    per_customer = o.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("k"))
    right = per_customer.join(c, "c_custkey").groupBy("c_nationkey").agg(F.sum("k").alias("n_orders"))
    both = left.join(right, "c_nationkey", "full").na.fill(0)
    return both.select(
        F.col("c_nationkey").alias("nation"), F.col("n_BUILDING").alias("n_building"), F.col("n_MACHINERY").alias("n_machinery"), "n_orders", F.round(F.try_divide(F.col("n_orders") * 100, F.col("_all")), 4).alias("orders_per_100")
    )


@R.query("J8", "SELECT c_custkey FROM customer SEMI JOIN orders ON c_custkey = o_custkey")
def semi_join(t):  # noqa: ANN001, ANN202
    return t("customer").join(t("orders"), F.col("c_custkey") == F.col("o_custkey"), "left_semi").select("c_custkey")


@R.query("J9 U4", "SELECT DISTINCT userid, jobid FROM candidatematchinc m WHERE isapply = 0 AND userid IS NOT NULL AND jobid IS NOT NULL AND NOT EXISTS (SELECT 1 FROM candidatematchinc a WHERE a.isapply = 1 AND a.userid = m.userid AND a.jobid = m.jobid)")
def not_applied(t):  # noqa: ANN001, ANN202
    m = t("candidatematchinc").select("userid", "jobid", "isapply").dropna(subset=["userid", "jobid"])
    return m.where("isapply = 0").select("userid", "jobid").distinct().join(m.where("isapply = 1").select("userid", "jobid").distinct(), ["userid", "jobid"], "left_anti")


@R.query("J10 I7", "SELECT o_custkey, o_orderkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0) UNION ALL SELECT c_custkey, -1 FROM customer WHERE c_acctbal < 0")
def replaced_by_key(t):  # noqa: ANN001, ANN202
    new = t("customer").where("c_acctbal < 0").select(F.col("c_custkey").alias("o_custkey"), F.lit(-1).cast("bigint").alias("o_orderkey"))
    return inc.replace_by_key(t("orders").select("o_custkey", "o_orderkey"), new, ["o_custkey"])


@R.query("J11 A10", "SELECT a.attid, a.attvalue, s.skill_desc FROM recruiter_jobattribute a LEFT JOIN (SELECT skill_id, min(skill_desc) AS skill_desc FROM lookup_skill GROUP BY 1) s ON a.attvalue = s.skill_id WHERE a.atttype = 3")
def decoded_dimension(t):  # noqa: ANN001, ANN202
    rows = t("recruiter_jobattribute").where("atttype = 3").select("attid", "attvalue")
    return rel.decode(rows, t("lookup_skill").withColumnRenamed("skill_id", "attvalue"), "attvalue", "skill_desc", "skill_desc")


@R.query("J12", "SELECT userid, startvendorid, CASE WHEN startvendorid BETWEEN 50 AND 120 THEN 'late' WHEN startvendorid BETWEEN 0 AND 99 THEN 'early' WHEN startvendorid BETWEEN 500 AND 900 THEN 'far' END AS label FROM candidatestaticinc")
def vendor_ranges(t):  # noqa: ANN001, ANN202
    rows = t("candidatestaticinc").select("userid", "startvendorid")
    ranges = rows.sparkSession.createDataFrame([(0, 99, "early", 1), (50, 120, "late", 2), (500, 900, "far", 3)], "lo bigint, hi bigint, label string, ordinal int")
    return rel.range_label(rows, "startvendorid", ranges).select("userid", "startvendorid", "label")


_MASTER = "SELECT s_suppkey AS k, s_name AS seg, CASE WHEN s_acctbal >= 0 THEN s_acctbal END AS bal FROM supplier"
_CHANGE = "SELECT o_custkey AS k, CASE WHEN count(*) > 5 THEN max(o_orderpriority) END AS seg, max(o_totalprice) AS bal FROM orders GROUP BY o_custkey"


def _master(t) -> tuple[DataFrame, DataFrame]:  # noqa: ANN001
    """Two whole tables that share some of their keys."""
    changes = t("orders").groupBy(F.col("o_custkey").alias("k")).agg(F.when(F.count(F.lit(1)) > 5, F.max("o_orderpriority")).alias("seg"), F.max("o_totalprice").alias("bal"))
    return t("supplier").selectExpr("s_suppkey AS k", "s_name AS seg", "CASE WHEN s_acctbal >= 0 THEN s_acctbal END AS bal"), changes


@R.query("J14 I6", f"SELECT coalesce(c.k, m.k) AS k, CASE WHEN c.k IS NOT NULL THEN c.seg ELSE m.seg END AS seg, CASE WHEN c.k IS NOT NULL THEN c.bal ELSE m.bal END AS bal FROM ({_MASTER}) m FULL JOIN ({_CHANGE}) c ON m.k = c.k")
def merge_overwrites(t):  # noqa: ANN001, ANN202
    return inc.update_all(*_master(t), "k")


@R.query("I5 J17", f"SELECT coalesce(c.k, m.k) AS k, coalesce(c.seg, m.seg) AS seg, coalesce(c.bal, m.bal) AS bal FROM ({_MASTER}) m FULL JOIN ({_CHANGE}) c ON m.k = c.k")
def update_keeps_present(t):  # noqa: ANN001, ANN202
    return inc.update_present(*_master(t), "k")


@R.query("J14", f"SELECT m.k, c.seg, c.bal, 'inner' AS how FROM ({_MASTER}) m JOIN ({_CHANGE}) c ON m.k = c.k UNION ALL SELECT m.k, m.seg, m.bal, 'anti' FROM ({_MASTER}) m ANTI JOIN ({_CHANGE}) c ON m.k = c.k UNION ALL SELECT m.k, CASE WHEN c.k IS NOT NULL THEN c.seg ELSE m.seg END, CASE WHEN c.k IS NOT NULL THEN c.bal ELSE m.bal END, 'left' FROM ({_MASTER}) m LEFT JOIN ({_CHANGE}) c ON m.k = c.k UNION ALL SELECT c.k, c.seg, c.bal, 'right' FROM ({_CHANGE}) c")
def merge_variants(t):  # noqa: ANN001, ANN202
    m, c = _master(t)
    out = None
    for how in ("inner", "anti", "left", "right"):
        part = rel.merge_by(m, c, ["k"], how).select("k", "seg", "bal", F.lit(how).alias("how"))
        out = part if out is None else out.unionByName(part)
    return out


@R.query("A20", f"SELECT k, sum(bal) AS bal FROM (SELECT k, bal FROM ({_MASTER}) UNION ALL SELECT k, bal FROM ({_CHANGE})) GROUP BY 1")
def added_measures(t):  # noqa: ANN001, ANN202
    m, c = _master(t)
    return inc.add_up(m, c, "k", ["bal"])


@R.query("I13", f"SELECT count(*) FILTER (m.k IS NOT NULL AND c.k IS NOT NULL) AS kept, count(*) FILTER (m.k IS NULL) AS added, count(*) FILTER (c.k IS NULL) AS removed FROM ({_MASTER}) m FULL JOIN ({_CHANGE}) c ON m.k = c.k")
def reconciled(t):  # noqa: ANN001, ANN202
    return inc.reconcile(*_master(t), "k")


_EDGES = "(SELECT u1, u2, max(overall_sim) AS sim FROM similarprofiles WHERE u1 IS NOT NULL AND u2 IS NOT NULL GROUP BY 1, 2)"
_CHANGED = "(SELECT DISTINCT lookup_id AS u FROM candidatestaticinc WHERE lastmodified >= DATE '2015-09-01')"


def _edges(t) -> tuple[DataFrame, DataFrame]:  # noqa: ANN001
    edges = t("similarprofiles").dropna(subset=["u1", "u2"]).groupBy("u1", "u2").agg(F.max("overall_sim").alias("sim"))
    return edges, t("candidatestaticinc").where("lastmodified >= DATE '2015-09-01'").select(F.col("lookup_id").alias("u")).dropna()


@R.query("J15", f"SELECT u1, u2, sim FROM {_EDGES} WHERE u1 IN (SELECT u FROM {_CHANGED} WHERE u IS NOT NULL) AND u2 NOT IN (SELECT u FROM {_CHANGED} WHERE u IS NOT NULL)")
def half_changed_edges(t):  # noqa: ANN001, ANN202
    edges, changed = _edges(t)
    return inc.half_changed_edges(edges, changed, "u1", "u2", "u")


@R.query("I9", f"SELECT u1, u2, sim FROM {_EDGES} WHERE u1 NOT IN (SELECT u FROM {_CHANGED} WHERE u IS NOT NULL) AND u2 NOT IN (SELECT u FROM {_CHANGED} WHERE u IS NOT NULL) UNION ALL SELECT u, u, 1000::SMALLINT FROM {_CHANGED} WHERE u IS NOT NULL")
def refreshed_edges(t):  # noqa: ANN001, ANN202
    edges, changed = _edges(t)
    new = changed.distinct().select(F.col("u").alias("u1"), F.col("u").alias("u2"), F.lit(1000).cast("smallint").alias("sim"))
    return inc.refresh_edges(edges, changed, new, "u1", "u2", "u")


@R.query("J16 A17", "SELECT userid, list_sort(list(DISTINCT jobid)) AS jobs, count(DISTINCT jobid)::INTEGER AS n FROM candidatematchinc WHERE isapply = 1 AND userid IS NOT NULL AND jobid IS NOT NULL GROUP BY 1")
def application_lists(t):  # noqa: ANN001, ANN202
    a = t("candidatematchinc").where("isapply = 1").dropna(subset=["userid", "jobid"])
    return a.groupBy("userid").agg(F.array_sort(F.collect_set("jobid")).alias("jobs")).withColumn("n", F.size("jobs"))


@R.query("J18", "SELECT a.attid, coalesce(s.field_enu, a.attvalue::VARCHAR, 'none') AS area FROM recruiter_jobattribute a LEFT JOIN lookup_subfunctionalarea s ON a.attvalue = s.sub_field_id WHERE a.atttype = 12")
def dimension_chain(t):  # noqa: ANN001, ANN202
    a, s = t("recruiter_jobattribute").where("atttype = 12"), t("lookup_subfunctionalarea")
    return a.join(s, F.col("attvalue") == s.sub_field_id, "left").select("attid", F.coalesce("field_enu", F.col("attvalue").cast("string"), F.lit("none")).alias("area"))


# --- aggregations


@R.query("A2", f"SELECT d::DATE AS day, count(c.userid) AS n FROM generate_series(DATE '2015-04-01', DATE '{ASOF}', INTERVAL 1 DAY) g(d) LEFT JOIN candidatestaticinc c ON c.lastlogin::DATE = d::DATE AND c.userid IS NOT NULL GROUP BY 1")
def daily_exit_histogram(t):  # noqa: ANN001, ANN202
    return rel.daily_counts(t("candidatestaticinc").where("userid IS NOT NULL"), "lastlogin", "2015-04-01", ASOF)


@R.query("A3 A4", "SELECT jobid_id, string_agg(DISTINCT attvaluecustom, '|' ORDER BY attvaluecustom) AS names FROM recruiter_jobattribute WHERE jobid_id IS NOT NULL GROUP BY 1")
def attribute_lists(t):  # noqa: ANN001, ANN202
    names = F.array_sort(F.collect_set("attvaluecustom"))
    return t("recruiter_jobattribute").where("jobid_id IS NOT NULL").groupBy("jobid_id").agg(F.when(F.size(names) > 0, F.array_join(names, "|")).alias("names"))


@R.query("A6", "SELECT u1, fa, min(overall_sim) AS least, max(overall_sim) AS most FROM similarprofiles WHERE overall_sim BETWEEN 0 AND 1000 GROUP BY 1, 2")
def similarity_bounds(t):  # noqa: ANN001, ANN202
    return t("similarprofiles").where("overall_sim BETWEEN 0 AND 1000").groupBy("u1", "fa").agg(F.min("overall_sim").alias("least"), F.max("overall_sim").alias("most"))


@R.query("A7 A13", "SELECT userid, count(*) AS freq, max(activitydate) AS last FROM activityinc GROUP BY 1")
def key_frequency(t):  # noqa: ANN001, ANN202
    return t("activityinc").groupBy("userid").agg(F.count(F.lit(1)).alias("freq"), F.max("activitydate").alias("last"))


_TYPES = list(range(2, 12))


@R.query("A8", f"SELECT userid, {', '.join(f'count(*) FILTER (type = {x}) AS n_{x}' for x in _TYPES)} FROM activityinc WHERE userid IS NOT NULL GROUP BY 1")
def activity_rollup(t):  # noqa: ANN001, ANN202
    return rel.conditional_counts(t("activityinc").where("userid IS NOT NULL"), ["userid"], "type", _TYPES, "n_")


@R.query("A9", "SELECT userid, lastlogin, lastmodified, email FROM (SELECT *, row_number() OVER (PARTITION BY userid ORDER BY lastmodified DESC NULLS LAST, lastlogin DESC NULLS LAST, email DESC NULLS LAST) AS rn FROM candidatestaticinc) WHERE rn = 1")
def latest_state(t):  # noqa: ANN001, ANN202
    return rel.latest_per_key(t("candidatestaticinc").select("userid", "lastmodified", "lastlogin", "email"), ["userid"], ["lastmodified", "lastlogin", "email"])


@R.query("A11 A12", "SELECT feed_day, count(DISTINCT userid) AS users, count(DISTINCT jobid) AS jobs FROM candidatematchinc GROUP BY 1")
def distinct_counts(t):  # noqa: ANN001, ANN202
    return t("candidatematchinc").groupBy("feed_day").agg(F.count_distinct("userid").alias("users"), F.count_distinct("jobid").alias("jobs"))


@R.query("A15", "SELECT o_orderstatus, o_orderpriority, count(*) AS n, sum(o_totalprice::DECIMAL(18,2))::DOUBLE AS total FROM orders GROUP BY ROLLUP (o_orderstatus, o_orderpriority)")
def two_key_rollup(t):  # noqa: ANN001, ANN202
    return t("orders").rollup("o_orderstatus", "o_orderpriority").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("total"))


@R.query("A18 A19", "SELECT item, count(*) AS n FROM (SELECT unnest(sj).job AS item FROM jobsuggestions) WHERE item IN (SELECT jobid FROM jobs) GROUP BY 1")
def listed_item_counts(t):  # noqa: ANN001, ANN202
    items = t("jobsuggestions").select(F.explode("sj.job").alias("item")).groupBy(F.col("item").cast("bigint").alias("item")).agg(F.count(F.lit(1)).alias("n"))
    return items.join(t("jobs").select(F.col("jobid").alias("item")).distinct(), "item", "left_semi").select("item", "n")


@R.query("A21", "SELECT l_orderkey, l_linenumber, round(l_quantity / (CASE WHEN sum(l_quantity) OVER (PARTITION BY l_orderkey) = 0 THEN 1 ELSE sum(l_quantity) OVER (PARTITION BY l_orderkey) END), 6) AS share FROM lineitem")
def row_shares(t):  # noqa: ANN001, ANN202
    total = F.sum("l_quantity").over(Window.partitionBy("l_orderkey"))
    return t("lineitem").select("l_orderkey", "l_linenumber", F.round(F.col("l_quantity") / F.when(total == 0, 1).otherwise(total), 6).alias("share"))


# --- rankings, sorts and samples

_SPEND = "SELECT o_custkey AS k, l_partkey AS part, l_suppkey AS supp, sum((l_extendedprice * (1 - l_discount))::DECIMAL(18,4)) AS spend FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1, 2, 3"


def _spend(t) -> DataFrame:  # noqa: ANN001
    rows = t("orders").join(t("lineitem"), F.col("o_orderkey") == F.col("l_orderkey"))
    amount = (F.col("l_extendedprice") * (1 - F.col("l_discount"))).cast("decimal(18,4)")
    return rows.groupBy(F.col("o_custkey").alias("k"), F.col("l_partkey").alias("part"), F.col("l_suppkey").alias("supp")).agg(F.sum(amount).alias("spend"))


@R.query("W1 W2", f"WITH s AS ({_SPEND}), g AS (SELECT *, row_number() OVER (PARTITION BY k, supp ORDER BY spend DESC, part) AS g FROM s), r AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY spend DESC, part, supp) AS rank FROM g WHERE g <= 3) SELECT k, part, supp, rank FROM r WHERE rank <= 15")
def capped_top(t):  # noqa: ANN001, ANN202
    return rel.capped_top_k(_spend(t), "k", "supp", [F.desc("spend"), F.asc("part"), F.asc("supp")], 3, 15).select("k", "part", "supp", "rank")


@R.query("W3", f"WITH s AS (SELECT *, CASE WHEN part % 2 = 0 THEN 0 ELSE 1 END AS tier FROM ({_SPEND})), t AS (SELECT *, row_number() OVER (PARTITION BY k, tier ORDER BY spend DESC, part, supp) AS tr FROM s), g AS (SELECT *, row_number() OVER (PARTITION BY k, supp ORDER BY tier, spend DESC, part, supp) AS g FROM t WHERE tr <= 60), r AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY tier, spend DESC, part, supp) AS rank FROM g WHERE g <= 3) SELECT k, part, supp, tier, rank FROM r WHERE rank <= 15")
def tiered_list(t):  # noqa: ANN001, ANN202
    rows = _spend(t).withColumn("tier", F.when(F.col("part") % 2 == 0, 0).otherwise(1))
    return rel.tiered_fill(rows, "k", "supp", "tier", [F.desc("spend"), F.asc("part"), F.asc("supp")], 60, 3, 15).select("k", "part", "supp", "tier", "rank")


@R.query("W5 M7", "SELECT u1, u2, sim, rank FROM (SELECT u1, u2, sim, row_number() OVER (PARTITION BY u1 ORDER BY sim DESC, u2) AS rank FROM " + _EDGES + " WHERE sim BETWEEN 0 AND 1000) WHERE rank <= 501")
def bounded_groups(t):  # noqa: ANN001, ANN202
    return rel.top_k(_edges(t)[0].where("sim BETWEEN 0 AND 1000"), ["u1"], [F.desc("sim"), F.asc("u2")], 501)


@R.query("W6 K1", "SELECT _id, i.u AS item, (CASE WHEN i.p <= 10 THEN 1 WHEN i.p <= 20 THEN 2 ELSE 3 END) AS slice FROM (SELECT _id, unnest(list_transform(list_slice(sj, 1, 30), lambda x, p: {'u': x.job, 'p': p})) AS i FROM jobsuggestions)")
def list_slices(t):  # noqa: ANN001, ANN202
    items = t("jobsuggestions").select("_id", F.posexplode(F.slice("sj", 1, 30)).alias("p", "s"))
    return items.select("_id", F.col("s.job").alias("item"), (F.floor(F.col("p") / 10) + 1).cast("int").alias("slice"))


@R.query("W7", "SELECT userid, row_number() OVER (ORDER BY userid) AS index FROM (SELECT DISTINCT userid FROM candidatematchinc WHERE userid IS NOT NULL)")
def dense_user_index(t):  # noqa: ANN001, ANN202
    return rel.dense_text_index(t("candidatematchinc"), "userid")


@R.query("W9 W10", "SELECT o_orderkey, part, CASE WHEN (pid // 8) % 2 = 1 AND pid BETWEEN 8 AND 79 THEN pid - 8 ELSE pid END AS pid FROM (SELECT o_orderkey, (row_number() OVER (ORDER BY o_orderkey) - 1) % 6 AS part, (row_number() OVER (ORDER BY o_orderkey) - 1) % 80 AS pid FROM orders)")
def round_robin_chunks(t):  # noqa: ANN001, ANN202
    rows = rel.round_robin(t("orders").select("o_orderkey"), ["o_orderkey"], 6).withColumn("pid", F.col("index") % 80)
    shifted = F.when((F.floor(F.col("pid") / 8) % 2 == 1) & F.col("pid").between(8, 79), F.col("pid") - 8).otherwise(F.col("pid"))
    return rows.select("o_orderkey", "part", shifted.alias("pid"))


@R.query("W11", "SELECT user_id, event_id, date_diff('second', date_trunc('second', lag(ts) OVER w), date_trunc('second', ts)) AS gap_s FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)")
def event_gaps(t):  # noqa: ANN001, ANN202
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    second = lambda c: F.unix_timestamp(c)
    return t("events").select("user_id", "event_id", (second(F.col("ts")) - second(F.lag("ts").over(w))).alias("gap_s"))


@R.query("W12", "WITH e AS (SELECT quantile_cont(b, [0.2, 0.4, 0.6, 0.8]) AS q FROM (SELECT DISTINCT c_acctbal AS b FROM customer)) SELECT c_custkey, (1 + (c_acctbal > q[1])::INTEGER + (c_acctbal > q[2])::INTEGER + (c_acctbal > q[3])::INTEGER + (c_acctbal > q[4])::INTEGER) AS band FROM customer, e")
def quintile_bands(t):  # noqa: ANN001, ANN202
    c = t("customer")
    edges = c.select("c_acctbal").distinct().agg(F.percentile("c_acctbal", F.array(*map(F.lit, (0.2, 0.4, 0.6, 0.8)))).alias("q")).first()["q"]
    band = F.lit(1)
    for e in edges:
        band = band + (F.col("c_acctbal") > e).cast("int")
    return c.select("c_custkey", band.alias("band"))


@R.query("L1", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders ORDER BY o_orderstatus, o_totalprice DESC, o_orderkey")
def multi_key_sort(t):  # noqa: ANN001, ANN202
    return t("orders").select("o_orderkey", "o_orderstatus", "o_totalprice").orderBy(F.asc("o_orderstatus"), F.desc("o_totalprice"), "o_orderkey")


@R.query("L3", "SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber FROM lineitem ORDER BY ALL")
def sorted_unique(t):  # noqa: ANN001, ANN202
    return t("lineitem").select("l_returnflag", "l_linestatus", "l_linenumber").distinct().orderBy("l_returnflag", "l_linestatus", "l_linenumber")


_HASH = "('0x' || substr(md5({} || ':{}'), 1, 15))::BIGINT"


@R.query("L4", f"SELECT c_custkey, row_number() OVER (ORDER BY {_HASH.format('c_custkey', 7)}, c_custkey) <= 750 AS sampled FROM customer")
def sample_and_rest(t):  # noqa: ANN001, ANN202
    """A reproducible sample of 750 without replacement, and its complement."""
    hashed = t("customer").select("c_custkey", portable_hash(F.col("c_custkey"), 7).alias("_h"))
    return rel.round_robin(hashed, ["_h", "c_custkey"], 1).select("c_custkey", (F.col("index") < 750).alias("sampled"))


@R.query("L5", f"SELECT c_custkey, ({_HASH.format('c_custkey', 0)} % 10)::INTEGER AS fold FROM customer")
def fold_split(t):  # noqa: ANN001, ANN202
    from marketlens.operators.models import fold

    return fold(t("customer").select("c_custkey"), "c_custkey")


# --- sets, increments


@R.query("U1", "SELECT c_custkey AS k, 'c' AS src, c_name AS name, NULL::DOUBLE AS total FROM customer UNION ALL SELECT o_custkey, 'o', NULL, o_totalprice FROM orders")
def union_by_name(t):  # noqa: ANN001, ANN202
    c = t("customer").select(F.col("c_custkey").alias("k"), F.lit("c").alias("src"), F.col("c_name").alias("name"))
    return c.unionByName(t("orders").select(F.col("o_custkey").alias("k"), F.lit("o").alias("src"), F.col("o_totalprice").alias("total")), allowMissingColumns=True)


@R.query("U3", "SELECT userid FROM candidatematchinc INTERSECT SELECT userid FROM activityinc")
def id_intersection(t):  # noqa: ANN001, ANN202
    return t("candidatematchinc").select("userid").intersect(t("activityinc").select("userid"))


@R.query("U4", "SELECT userid FROM candidatematchinc EXCEPT SELECT userid FROM candidatestaticinc")
def id_difference(t):  # noqa: ANN001, ANN202
    return t("candidatematchinc").select("userid").subtract(t("candidatestaticinc").select("userid"))


@R.query("I1", "WITH b AS (SELECT event_id, ts FROM events WHERE ts < TIMESTAMP '2024-01-20') SELECT event_id, ts FROM (SELECT * FROM b UNION ALL SELECT event_id, ts FROM events WHERE event_id > (SELECT max(event_id) FROM b)) WHERE ts >= TIMESTAMP '2024-01-05'")
def watermark_append(t):  # noqa: ANN001, ANN202
    e = t("events").select("event_id", "ts")
    return inc.append_after(e.where("ts < TIMESTAMP_NTZ '2024-01-20 00:00:00'"), e, "event_id", "ts", F.expr("TIMESTAMP_NTZ '2024-01-05 00:00:00'"))


@R.query("I4", "SELECT a.attid, a.jobid_id FROM recruiter_jobattribute a WHERE a.jobid_id IN (SELECT jobid FROM jobs WHERE republisheddate >= DATE '2015-09-01')")
def children_of_changed(t):  # noqa: ANN001, ANN202
    changed = t("jobs").where("republisheddate >= DATE '2015-09-01'").select(F.col("jobid").alias("jobid_id"))
    return t("recruiter_jobattribute").join(changed, "jobid_id", "left_semi").select("attid", "jobid_id")


@R.query("I8", "SELECT userid, email FROM candidatestaticinc WHERE userid NOT IN (SELECT userid FROM candidatestaticinc WHERE spamstatus = 1 OR bouncestatus = 1)")
def deleted_by_predicate(t):  # noqa: ANN001, ANN202
    c = t("candidatestaticinc").select("userid", "email", "spamstatus", "bouncestatus")
    return inc.delete_keys(c, c.where("spamstatus = 1 OR bouncestatus = 1"), ["userid"]).select("userid", "email")


@R.query("I10", "SELECT max(registrationenddate) AS last, coalesce(max(registrationenddate) >= TIMESTAMP '2015-11-30 23:45:00', false) AS fresh FROM candidatestaticinc")
def freshness_gate(t):  # noqa: ANN001, ANN202
    last = F.max("registrationenddate")
    return t("candidatestaticinc").agg(last.alias("last"), F.coalesce(last >= F.expr("TIMESTAMP_NTZ '2015-11-30 23:45:00'"), F.lit(False)).alias("fresh"))


@R.query("I11", "SELECT userid, lastlogin FROM candidatestaticinc WHERE lastlogin::DATE > registrationstartdate::DATE")
def pure_events(t):  # noqa: ANN001, ANN202
    return t("candidatestaticinc").where(F.to_date("lastlogin") > F.to_date("registrationstartdate")).select("userid", "lastlogin")


@R.query("I12", "WITH e AS (SELECT lower(email) AS email, min(lookup_id) AS v FROM candidatestaticinc WHERE lookup_id IS NOT NULL AND email IS NOT NULL GROUP BY 1) SELECT c.userid, coalesce(CASE WHEN c.gender = 1 THEN c.lookup_id END, e.v) AS lookup_id FROM candidatestaticinc c LEFT JOIN e ON lower(c.email) = e.email")
def backfilled_ids(t):  # noqa: ANN001, ANN202
    c = t("candidatestaticinc").select("userid", F.lower("email").alias("email"), "lookup_id", "gender")
    missing = c.withColumn("lookup_id", F.when(F.col("gender") == 1, F.col("lookup_id")))
    return inc.fill_from(missing, c.where("email IS NOT NULL").select("email", "lookup_id"), "email", "lookup_id").select("userid", "lookup_id")


@R.query("F15 K6", "SELECT fcu, list_sort(list(v) FILTER (t = 8 AND v IS NOT NULL)) AS cities, list_sort(list(v) FILTER (t = 3 AND v IS NOT NULL)) AS skills, min(v) FILTER (t = 10) AS subfa FROM candidatepreferences WHERE fcu IS NOT NULL GROUP BY 1")
def preference_pivot(t):  # noqa: ANN001, ANN202
    pick = lambda k: F.array_sort(F.collect_list(F.when(F.col("t") == k, F.col("v"))))
    lists = t("candidatepreferences").where("fcu IS NOT NULL").groupBy("fcu").agg(pick(8).alias("c"), pick(3).alias("s"), F.min(F.when(F.col("t") == 10, F.col("v"))).alias("subfa"))
    return lists.select("fcu", F.when(F.size("c") > 0, F.col("c")).alias("cities"), F.when(F.size("s") > 0, F.col("s")).alias("skills"), "subfa")


@R.query("F13 J11", "SELECT nullif(nullif(nullif(nullif(lower(trim(userid)), ''), '0'), 'none'), 'null') AS user_id, count(*) AS n FROM candidatematchinc GROUP BY 1 HAVING user_id IS NOT NULL")
def normal_ids(t):  # noqa: ANN001, ANN202
    return t("candidatematchinc").groupBy(entity_id(F.col("userid")).alias("user_id")).agg(F.count(F.lit(1)).alias("n")).where("user_id IS NOT NULL")


@R.query("F17", "SELECT startvendorid, registrationstartdate::DATE AS day, count(*) AS n FROM candidatestaticinc WHERE startvendorid > 0 AND registrationstartdate >= DATE '2014-01-01' GROUP BY 1, 2")
def vendor_registrations(t):  # noqa: ANN001, ANN202
    rows = t("candidatestaticinc").where("startvendorid > 0 AND registrationstartdate >= DATE '2014-01-01'")
    return rows.groupBy("startvendorid", F.to_date("registrationstartdate").alias("day")).agg(F.count(F.lit(1)).alias("n"))
