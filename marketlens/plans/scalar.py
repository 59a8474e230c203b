"""Text, date, number, array and map functions on the test tables, over whole texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketlens.functions import dates, scoring, text
from marketlens.operators import relational as rel
from marketlens.plans.registry import Registry

R = Registry()
ASOF = "2015-10-01"
_SQUEEZE = "trim(regexp_replace({}, '\\s+', ' ', 'g'), concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13)))"


@R.query("T1 T2", "SELECT doc_id, trim(regexp_replace(text, '[\\t\\n\\x0B\\f\\r ]+', ' ', 'g')) AS squeezed, lower(source) AS source FROM documents")
def squeezed_text(t):  # noqa: ANN001, ANN202
    return t("documents").select("doc_id", text.squeeze(F.col("text")).alias("squeezed"), F.lower("source").alias("source"))


@R.query("T2", "SELECT jobid, array_to_string(list_transform(string_split(lower(jobtitle), ' '), lambda x: upper(x[1]) || x[2:]), ' ') AS title FROM jobs")
def title_case(t):  # noqa: ANN001, ANN202
    return t("jobs").select("jobid", F.initcap("jobtitle").alias("title"))


@R.query("T3", "SELECT jobid, CASE WHEN keyskills IS NOT NULL THEN array_to_string(list_distinct_ordered, ',') END AS skills FROM (SELECT jobid, list_reduce(list_prepend([]::VARCHAR[], list_transform(list_transform(regexp_split_to_array(keyskills, ','), lambda x: trim(x)), lambda x: [x])), lambda a, b: CASE WHEN list_contains(a, b[1]) THEN a ELSE list_concat(a, b) END) AS list_distinct_ordered, keyskills FROM jobs)")
def deduped_lists(t):  # noqa: ANN001, ANN202
    return t("jobs").select("jobid", text.dedupe_list(F.col("keyskills")).alias("skills"))


@R.query("T4", "SELECT userid, email, CASE WHEN contains(email, '@') THEN split_part(email, '@', -1) ELSE email END AS domain, split_part(firstname, ' ', 1) AS first FROM candidatestaticinc")
def text_parts(t):  # noqa: ANN001, ANN202
    return t("candidatestaticinc").select("userid", "email", F.substring_index("email", "@", -1).alias("domain"), F.split_part("firstname", F.lit(" "), F.lit(1)).alias("first"))


@R.query("T5", "SELECT jobid, trim(repeat(' ' || coalesce(jobtitle, ''), 5) || repeat(' ' || coalesce(keyskills, ''), 3)) AS doc FROM jobs")
def weighted_documents(t):  # noqa: ANN001, ANN202
    return t("jobs").select("jobid", text.weighted_document([(F.col("jobtitle"), 5), (F.col("keyskills"), 3)]).alias("doc"))


@R.query("T6", "SELECT doc_id, regexp_replace(text, '[^\\x00-\\x7F]', '', 'g') AS dropped, regexp_replace(text, '[^\\x00-\\x7F]', ' ', 'g') AS blanked FROM documents")
def ascii_filter(t):  # noqa: ANN001, ANN202
    return t("documents").select("doc_id", text.ascii_only(F.col("text")).alias("dropped"), text.ascii_only(F.col("text"), " ").alias("blanked"))


_HTML = "text"
for _e, _c in (("&nbsp;", " "), ("&bull;", " "), ("&#44;", ","), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&")):
    _HTML = f"replace({_HTML}, '{_e}', '{_c}')"


@R.query("T7 T8", f"SELECT doc_id, trim(regexp_replace(regexp_replace({_HTML}, '<[^>]*>', ' ', 'g'), '[\\t\\n\\x0B\\f\\r ]+', ' ', 'g')) AS plain FROM documents")
def html_to_text(t):  # noqa: ANN001, ANN202
    return t("documents").select("doc_id", text.html_text(F.col("text")).alias("plain"))


@R.query("T9", "SELECT doc_id, len(regexp_extract_all(text, '[\\w.]+@[\\w.]+'))::INTEGER AS n_mails, len(regexp_extract_all(text, 'https?://\\S+'))::INTEGER AS n_urls, regexp_matches(text, '\\d{10,}') AS has_phone, regexp_replace(text, '[\\w.]+@[\\w.]+|https?://\\S+', '', 'g') AS bare FROM documents")
def mails_and_urls(t):  # noqa: ANN001, ANN202
    return t("documents").select(
        "doc_id", F.regexp_count("text", F.lit(r"[\w.]+@[\w.]+")).alias("n_mails"), F.regexp_count("text", F.lit(r"https?://\S+")).alias("n_urls"), F.col("text").rlike(r"\d{10,}").alias("has_phone"),
        F.regexp_replace("text", r"[\w.]+@[\w.]+|https?://\S+", "").alias("bare"),
    )


@R.query("T10 T26", "SELECT jobid, regexp_replace(jobtitle, '([0-9])([A-Za-z])', '\\1 \\2', 'g') AS split_units, lpad(coalesce(minexperience, 0)::VARCHAR, 4, '0') AS padded, TRY_CAST(displayname AS DOUBLE) AS num FROM jobs")
def units_and_padding(t):  # noqa: ANN001, ANN202
    return t("jobs").select("jobid", text.split_units(F.col("jobtitle")).alias("split_units"), F.lpad(F.coalesce("minexperience", F.lit(0)).cast("string"), 4, "0").alias("padded"), F.col("displayname").try_cast("double").alias("num"))


_CLEAN = "trim(regexp_replace(regexp_replace({}, '[^A-Za-z0-9 ]', ' ', 'g'), ' +', ' ', 'g'))"
_TOKENS = f"list_filter(string_split(lower({_CLEAN}), ' '), lambda x: x <> '')"
_STOPS = ", ".join(f"'{w}'" for w in text.STOP_WORDS)


@R.query("T11", f"SELECT doc_id, list_filter({_TOKENS.format('text')}, lambda x: x NOT IN ({_STOPS}) AND NOT regexp_full_match(x, '[0-9]+')) AS words FROM documents")
def stop_words_removed(t):  # noqa: ANN001, ANN202
    return t("documents").select("doc_id", text.without_stop_words(text.tokens(F.col("text"))).alias("words"))


@R.query("T12", f"SELECT word, coalesce(m.full, word) AS full, n FROM (SELECT unnest({_TOKENS.format('jobtitle')}) AS word, count(*) AS n FROM jobs GROUP BY 1) LEFT JOIN (VALUES ('sr', 'senior'), ('jr', 'junior'), ('mgr', 'manager'), ('engineer', 'engineering')) m(w, \"full\") ON m.w = word")
def dictionary_replacement(t):  # noqa: ANN001, ANN202
    words = t("jobs").select(F.explode(text.tokens(F.col("jobtitle"))).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    known = words.sparkSession.createDataFrame([("sr", "senior"), ("jr", "junior"), ("mgr", "manager"), ("engineer", "engineering")], "word string, full string")
    return words.join(known, "word", "left").select("word", F.coalesce("full", "word").alias("full"), "n")


@R.query("T13", None)
def stemmed_words(t):  # noqa: ANN001, ANN202
    from marketlens.functions.stemming import stemmed

    words = t("jobs").select(F.explode(text.tokens(F.col("jobtitle"))).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return words.groupBy(stemmed(F.col("word")).alias("stem")).agg(F.sum("n").alias("n"))


@R.query("T14", "WITH w AS (SELECT lower(trim(attvaluecustom, ' ')) AS typed, count(*) AS n FROM recruiter_jobattribute WHERE atttype = 13 AND regexp_full_match(attvaluecustom, '[ -~]*') GROUP BY 1), c AS (SELECT city, coalesce(n, 0) AS freq FROM (SELECT DISTINCT lower(city_desc) AS city FROM lookup_city) LEFT JOIN w ON typed = city), m AS (SELECT typed, n, city, row_number() OVER (PARTITION BY typed ORDER BY freq DESC, city) AS r FROM w JOIN c ON levenshtein(typed, city) <= 1) SELECT typed, n, city FROM m WHERE r = 1")
def spelling_corrected(t):  # noqa: ANN001, ANN202
    """Distinct typed ASCII names against the fixed list of cities: one edit leaves the first or the last half of a word unchanged; of several names the most frequent counts."""
    typed = t("recruiter_jobattribute").where((F.col("atttype") == 13) & F.col("attvaluecustom").rlike("^[ -~]*$")).groupBy(F.lower(F.trim("attvaluecustom")).alias("typed")).agg(F.count(F.lit(1)).alias("n"))
    cities = t("lookup_city").select(F.lower("city_desc").alias("city")).distinct().withColumn("h", F.floor(F.length("city") / 2).cast("int"))
    left = cities.select("city", "h", F.substring("city", F.lit(1), F.col("h")).alias("half"), F.lit("l").alias("side"))
    right = cities.select("city", (F.length("city") - F.col("h")).alias("h"), F.substring("city", F.col("h") + 1, F.length("city") - F.col("h")).alias("half"), F.lit("r").alias("side"))
    sizes = F.filter(F.array(*[(F.floor(F.length("typed") / 2) + i).cast("int") for i in (-1, 0, 1, 2)]), lambda x: (x > 0) & (x <= F.length("typed")))
    probes = typed.withColumn("h", F.explode(sizes))
    probes = probes.select("typed", "n", "h", F.explode(F.array(F.struct(F.lit("l").alias("side"), F.substring("typed", F.lit(1), F.col("h")).alias("half")), F.struct(F.lit("r").alias("side"), F.substring("typed", F.length("typed") - F.col("h") + 1, F.col("h")).alias("half")))).alias("p"))
    met = probes.select("typed", "n", "h", "p.side", "p.half").join(left.unionByName(right), ["h", "side", "half"])
    near = met.where(F.levenshtein("typed", "city") <= 1).select("typed", "n", "city").distinct()
    freq = typed.select(F.col("typed").alias("city"), F.col("n").alias("freq"))
    ranked = near.join(freq, "city", "left").withColumn("freq", F.coalesce("freq", F.lit(0)))
    return rel.top_k(ranked, ["typed"], [F.desc("freq"), F.asc("city")], 1).select("typed", "n", "city")


@R.query("T15", "WITH s AS (SELECT jobid, string_split(lower(trim(regexp_replace(regexp_replace(jobtitle, '[^A-Za-z0-9 ]', ' ', 'g'), ' +', ' ', 'g'))), ' ') AS w FROM jobs), g AS (SELECT jobid, list_filter(list_transform(generate_series(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1]), lambda x: x IS NOT NULL) AS pairs FROM s) SELECT jobid, list_sort(pairs) AS pairs FROM g")
def title_pairs(t):  # noqa: ANN001, ANN202
    pairs = text.ngrams(text.tokens(F.col("jobtitle")), 2)
    return t("jobs").select("jobid", F.when(F.col("jobtitle").isNotNull(), F.array_sort(pairs)).alias("pairs"))


@R.query("T16", "WITH s AS (SELECT row_number() OVER () AS r, jobid, list_filter(list_transform(regexp_split_to_array(lower(keyskills), '[,;|]'), lambda x: trim(x)), lambda x: x <> '') AS x FROM jobs) SELECT jobid, list_sort(list_distinct(list_filter(x, lambda a: len(list_filter(x, lambda b: b <> a AND contains(b, a))) = 0))) AS skills FROM s")
def longest_skills(t):  # noqa: ANN001, ANN202
    """A job's skills without those that another of its skills contains."""
    skills = F.array_distinct(F.transform(F.split(F.lower("keyskills"), "[,;|]"), lambda x: F.trim(x)))
    return t("jobs").select("jobid", F.array_sort(text.longest_only(F.filter(skills, lambda x: x != ""))).alias("skills"))


@R.query("T17", "SELECT doc_id, list_transform(regexp_extract_all(text, '[0-9]+(?:\\.[0-9]+)?'), lambda x: TRY_CAST(x AS DOUBLE)) AS nums FROM documents")
def numbers_in_text(t):  # noqa: ANN001, ANN202
    return t("documents").select("doc_id", text.numbers(F.col("text")).alias("nums"))


@R.query("T18 T20 T21", "SELECT event_id, regexp_extract('http://x.invalid/p?type=' || event_type || '&v=' || user_id, '[?&]v=([^&#]*)', 1) AS v, url_decode(replace(event_type || '%2520x', '+', '%20')) AS once, replace(event_type || ' and b', ' and ', '+AND+') AS q FROM events")
def url_fields(t):  # noqa: ANN001, ANN202
    url = F.concat(F.lit("http://x.invalid/p?type="), "event_type", F.lit("&v="), F.col("user_id").cast("string"))
    return t("events").select("event_id", text.parameter(url, "v").alias("v"), F.try_url_decode(F.concat("event_type", F.lit("%2520x"))).alias("once"), F.replace(F.concat("event_type", F.lit(" and b")), F.lit(" and "), F.lit("+AND+")).alias("q"))


@R.query("T19", "SELECT doc_id, CASE WHEN regexp_matches(lower(text), '\\bguest\\b') THEN 'guest' WHEN regexp_matches(lower(text), '\\bpatient\\b') THEN 'patient' WHEN regexp_matches(lower(text), '\\bfreight\\b') THEN 'freight' ELSE 'none' END AS keyword FROM documents WHERE text IS NOT NULL")
def first_keyword(t):  # noqa: ANN001, ANN202
    table = [(rf"\b{w}\b", w) for w in ("guest", "patient", "freight")]
    return t("documents").where("text IS NOT NULL").select("doc_id", text.agent_family(F.lower("text"), table, "none").alias("keyword"))


@R.query("T23", "SELECT _id, CASE WHEN n <= 1 THEN array_to_string(x, ', ') ELSE array_to_string(x[1:n-1], ', ') || ' and ' || x[n] END AS line FROM (SELECT _id, len(x) AS n, x FROM (SELECT _id, list_transform(sj, lambda s: coalesce(s.job, 0)::VARCHAR) AS x FROM jobsuggestions WHERE sj IS NOT NULL))")
def prose_lists(t):  # noqa: ANN001, ANN202
    items = F.transform("sj", lambda s: F.coalesce(s["job"], F.lit(0)).cast("string"))
    return t("jobsuggestions").where("sj IS NOT NULL").select("_id", text.prose_list(items).alias("line"))


@R.query("T25", "SELECT skill_id, CASE WHEN NOT regexp_full_match(b, '[0-9 .]*') THEN b END AS bare FROM (SELECT skill_id, regexp_replace(trim(skill_desc || ' 2.0'), '\\s+v?[0-9]+(\\.[0-9]+)*$', '') AS b FROM lookup_skill)")
def version_stripped(t):  # noqa: ANN001, ANN202
    return t("lookup_skill").select("skill_id", text.without_version(F.concat("skill_desc", F.lit(" 2.0"))).alias("bare"))


@R.query("F18", "SELECT event_type, CASE WHEN regexp_matches(event_type, '^c') THEN 'clicks' WHEN regexp_matches(event_type, 'view|sign') THEN 'visits' ELSE 'other' END AS family, count(*) AS n FROM events GROUP BY 1")
def agent_families(t):  # noqa: ANN001, ANN202
    return t("events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n")).select("event_type", text.agent_family(F.col("event_type"), [("^c", "clicks"), ("view|sign", "visits")]).alias("family"), "n")


# --- dates


@R.query("D1 D5", f"SELECT userid, lastlogin::DATE AS day, (lastlogin::DATE + 30)::DATE AS later, date_trunc('month', lastlogin)::DATE AS month, (DATE '{ASOF}' - lastlogin::DATE)::INTEGER AS age FROM candidatestaticinc")
def date_arithmetic(t):  # noqa: ANN001, ANN202
    d = F.to_date("lastlogin")
    return t("candidatestaticinc").select("userid", d.alias("day"), F.date_add(d, 30).alias("later"), F.trunc(d, "month").alias("month"), F.datediff(dates.day(ASOF), d).alias("age"))


@R.query("D2", "SELECT o_orderkey, try_strptime(CASE o_orderkey % 3 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') WHEN 1 THEN strftime(o_orderdate, '%d/%m/%Y') ELSE 'n/a' END, ['%Y-%m-%d %H:%M:%S', '%d/%m/%Y']) AS ts FROM orders")
def parsed_dates(t):  # noqa: ANN001, ANN202
    raw = F.when(F.col("o_orderkey") % 3 == 0, F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")).when(F.col("o_orderkey") % 3 == 1, F.date_format("o_orderdate", "dd/MM/yyyy")).otherwise("n/a")
    return t("orders").select("o_orderkey", dates.parse_any(raw, "yyyy-MM-dd HH:mm:ss", "dd/MM/yyyy").alias("ts"))


@R.query("D3 D8", "SELECT o_orderkey, strftime(o_orderdate, '%b-%Y') AS mon, upper(strftime(o_orderdate, '%d%b%Y:%H:%M:%S')) AS stamp, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS iso, strftime(o_orderdate, '%Y%m') AS month_key FROM orders")
def formatted_dates(t):  # noqa: ANN001, ANN202
    f = lambda p: F.date_format("o_orderdate", p)
    return t("orders").select("o_orderkey", f("MMM-yyyy").alias("mon"), F.upper(f("ddMMMyyyy:HH:mm:ss")).alias("stamp"), f("yyyy-MM-dd'T'HH:mm:ss'Z'").alias("iso"), f("yyyyMM").alias("month_key"))


@R.query("D4", f"SELECT candidatematchid, CASE WHEN a <= 10 THEN 1.0 WHEN a <= 20 THEN 0.9 WHEN a <= 30 THEN 0.8 WHEN a IS NOT NULL THEN 0.6 END::DOUBLE AS recency FROM (SELECT candidatematchid, abs(date_diff('day', matchdate::DATE, DATE '{ASOF}')) AS a FROM candidatematchinc)")
def recency_score(t):  # noqa: ANN001, ANN202
    return t("candidatematchinc").select("candidatematchid", dates.recency_step(F.datediff(dates.day(ASOF), F.to_date("matchdate"))).alias("recency"))


@R.query("D6", f"SELECT userid, lastlogin FROM candidatestaticinc WHERE lastlogin::DATE >= DATE '2015-11-01' - (52 * (dayofweek(DATE '2015-11-01') + 1))::INTEGER AND lastlogin::DATE < DATE '2015-11-01' - (52 * dayofweek(DATE '2015-11-01'))::INTEGER")
def cyclic_cohort(t):  # noqa: ANN001, ANN202
    start, end = dates.cyclic_window("2015-11-01", 364, 7)
    return t("candidatestaticinc").where((F.to_date("lastlogin") >= start) & (F.to_date("lastlogin") < end)).select("userid", "lastlogin")


@R.query("D7", "SELECT feed_day, strftime(feed_day, '%A') AS weekday, (weekofyear(feed_day) % 2)::INTEGER AS parity, count(*) AS n FROM activityinc GROUP BY feed_day")
def calendar_rules(t):  # noqa: ANN001, ANN202
    return t("activityinc").groupBy("feed_day").agg(F.count(F.lit(1)).alias("n")).select("feed_day", F.date_format("feed_day", "EEEE").alias("weekday"), F.pmod(F.weekofyear("feed_day"), F.lit(2)).cast("int").alias("parity"), "n")


# --- numbers, arrays, maps


def _sigmoid_weights() -> str:
    raw = [f"({b} + {s} / (1 + exp(-({g}) * ({f} * exp({r} * e) - {o}))))" for b, s, f, r, o, g in scoring.WEIGHTS]
    return ", ".join(f"round({w} / ({' + '.join(raw)}), 6) AS w{i}" for i, w in enumerate(raw, 1))


@R.query("N1", f"SELECT userid, {_sigmoid_weights()} FROM (SELECT userid, CASE WHEN experience >= 0 THEN experience ELSE 0.0 END::DOUBLE AS e FROM (SELECT userid, TRY_CAST(experience AS DOUBLE) AS experience FROM candidatestaticinc))")
def weight_curves(t):  # noqa: ANN001, ANN202
    w = scoring.component_weights(F.col("experience").try_cast("double"))
    return t("candidatestaticinc").select("userid", *[F.round(x, 6).alias(f"w{i}") for i, x in enumerate(w, 1)])


@R.query("N2 N3 N4", "SELECT p_partkey, round(exp(-0.005 * p_size), 3) AS decay, (p_retailprice * 1000)::DECIMAL(20,3)::BIGINT AS x1000, round(10 * (exp(2 * p_size / 250.0) - 1) / (exp(2 * p_size / 250.0) + 1), 4) AS curve, round(p_retailprice, 1) AS tenth FROM part")
def rounded_curves(t):  # noqa: ANN001, ANN202
    return t("part").select(
        "p_partkey", F.round(F.exp(-0.005 * F.col("p_size")), 3).alias("decay"), F.round((F.col("p_retailprice") * 1000).cast("decimal(20,3)")).cast("bigint").alias("x1000"), F.round(10 * F.tanh(F.col("p_size") / 250.0), 4).alias("curve"), F.round("p_retailprice", 1).alias("tenth")
    )


@R.query("N5", "SELECT u1, u2, list_reverse_sort([exp_sim, sal_sim, ind_sim, jt_sim])[2] AS second, list_position([exp_sim, sal_sim, ind_sim, jt_sim], list_max([exp_sim, sal_sim, ind_sim, jt_sim])) AS best FROM similarprofiles WHERE exp_sim IS NOT NULL AND sal_sim IS NOT NULL AND ind_sim IS NOT NULL AND jt_sim IS NOT NULL")
def second_largest(t):  # noqa: ANN001, ANN202
    parts = F.array("exp_sim", "sal_sim", "ind_sim", "jt_sim")
    rows = t("similarprofiles").dropna(subset=["exp_sim", "sal_sim", "ind_sim", "jt_sim"])
    return rows.select("u1", "u2", F.element_at(F.sort_array(parts, asc=False), 2).alias("second"), F.array_position(parts, F.array_max(parts)).cast("int").alias("best"))


@R.query("N6 N7", "SELECT p_partkey, CASE WHEN p_size <= 10 THEN 1 WHEN p_size <= 20 THEN 2 WHEN p_size <= 30 THEN 3 WHEN p_size IS NOT NULL THEN 4 END AS band, CASE WHEN p_size <= 10 THEN [1, 2] WHEN p_size <= 20 THEN [1, 2, 3] WHEN p_size <= 30 THEN [2, 3, 4] ELSE [3, 4] END AS near FROM part")
def size_bands(t):  # noqa: ANN001, ANN202
    band = scoring.banded(F.col("p_size"), [10, 20, 30])
    return t("part").select("p_partkey", band.alias("band"), scoring.neighbour_bands(band, 4).alias("near"))


@R.query("N8 M20", """SELECT o_custkey, r, f, m, r * f * m AS score FROM (SELECT o_custkey, CASE WHEN date_diff('day', max(o_orderdate)::DATE, DATE '2001-08-01') <= 90 THEN 3 WHEN date_diff('day', max(o_orderdate)::DATE, DATE '2001-08-01') <= 365 THEN 2 ELSE 1 END AS r,
    CASE WHEN count(*) <= 5 THEN 1 WHEN count(*) <= 10 THEN 2 ELSE 3 END AS f, CASE WHEN sum(o_totalprice::DECIMAL(18,2)) <= 500000 THEN 1 WHEN sum(o_totalprice::DECIMAL(18,2)) <= 2000000 THEN 2 ELSE 3 END AS m FROM orders GROUP BY 1)""")  # fmt: skip
def rfm_score(t):  # noqa: ANN001, ANN202
    g = t("orders").groupBy("o_custkey").agg(F.max("o_orderdate").alias("d"), F.count(F.lit(1)).alias("n"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("v"))
    age = F.datediff(F.lit("2001-08-01").cast("date"), F.to_date("d"))
    bands = g.select("o_custkey", F.when(age <= 90, 3).when(age <= 365, 2).otherwise(1).alias("r"), scoring.banded(F.col("n"), [5, 10]).alias("f"), scoring.banded(F.col("v"), [500000, 2000000]).alias("m"))
    return bands.withColumn("score", F.col("r") * F.col("f") * F.col("m"))


@R.query("F11", "SELECT jobid, CASE WHEN coalesce(minexperience > 5, false) OR coalesce(2 > maxexperience, false) THEN 0 ELSE 1 END AS fits FROM jobs")
def range_overlap(t):  # noqa: ANN001, ANN202
    return t("jobs").select("jobid", scoring.overlaps(F.col("minexperience"), F.col("maxexperience"), F.lit(2), F.lit(5)).alias("fits"))


@R.query("K1 U5", "SELECT _id, len(sj)::INTEGER AS n, list_sort(list_distinct(list_filter(list_transform(sj, lambda s: s.job), lambda x: x IS NOT NULL))) AS jobs, list_contains(list_transform(sj, lambda s: s.job), _id) AS has_self FROM jobsuggestions WHERE sj IS NOT NULL")
def array_basics(t):  # noqa: ANN001, ANN202
    jobs = F.transform("sj", lambda s: s["job"])
    has = F.exists(jobs, lambda x: F.coalesce(x == F.col("_id"), F.lit(False)))
    return t("jobsuggestions").where("sj IS NOT NULL").select("_id", F.size("sj").alias("n"), F.array_sort(F.array_distinct(F.filter(jobs, lambda x: x.isNotNull()))).alias("jobs"), has.alias("has_self"))


@R.query("A6", "SELECT a.u1, max(b.overall_sim) AS best FROM (SELECT DISTINCT u1, u2 FROM similarprofiles) a JOIN (SELECT u1, max(overall_sim) AS overall_sim FROM similarprofiles WHERE overall_sim BETWEEN 0 AND 1000 GROUP BY 1) b ON a.u2 = b.u1 GROUP BY 1")
def best_linked_score(t):  # noqa: ANN001, ANN202
    s = t("similarprofiles")
    best = s.where("overall_sim BETWEEN 0 AND 1000").groupBy(F.col("u1").alias("u2")).agg(F.max("overall_sim").alias("b"))
    return s.select("u1", "u2").distinct().join(best, "u2").groupBy("u1").agg(F.max("b").alias("best"))


@R.query("K4", "SELECT event_id, json_extract_string(props, '$.k') AS k FROM events")
def json_props(t):  # noqa: ANN001, ANN202
    return t("events").select("event_id", F.get_json_object("props", "$.k").alias("k"))


@R.query("K5", "SELECT o_custkey, string_agg(s || ';' || n, '|' ORDER BY s) AS flat FROM (SELECT o_custkey, o_orderstatus AS s, count(*) AS n FROM orders GROUP BY 1, 2) GROUP BY 1")
def flattened_maps(t):  # noqa: ANN001, ANN202
    counts = t("orders").groupBy("o_custkey", "o_orderstatus").agg(F.count(F.lit(1)).alias("n"))
    m = counts.groupBy("o_custkey").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("o_orderstatus", "n")))).alias("m"))
    return m.select("o_custkey", F.array_join(F.transform(F.map_entries("m"), lambda e: F.concat(e["key"], F.lit(";"), e["value"].cast("string"))), "|").alias("flat"))


_XML = "<response><lst name=\"head\"><int name=\"status\">0</int></lst><result name=\"response\" numFound=\"{}\" start=\"0\"><doc numFound=\"-1\"/></result></response>"


@R.query("K7", "SELECT o_custkey, regexp_extract('" + _XML.replace("{}", "' || count(*) || '") + "', '<result [^>]*numFound=\"([0-9]+)\"', 1)::BIGINT AS found FROM orders GROUP BY 1")
def xml_attribute(t):  # noqa: ANN001, ANN202
    """The number of hits in a search answer: an attribute of one of its elements."""
    before, after = _XML.split("{}")
    xml = F.concat(F.lit(before), F.col("n").cast("string"), F.lit(after))
    return t("orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n")).select("o_custkey", F.xpath_long(xml, F.lit("/response/result/@numFound")).alias("found"))


@R.query("K8", "SELECT jobid, list_extract(p, 1) AS first, coalesce(list_extract(p, 2), 'none') AS second FROM (SELECT jobid, string_split(keyskills, '|') AS p FROM jobs)")
def pipe_columns(t):  # noqa: ANN001, ANN202
    p = F.split("keyskills", r"\|")
    return t("jobs").select("jobid", F.get(p, 0).alias("first"), F.coalesce(F.get(p, 1), F.lit("none")).alias("second"))


_UNITS = "trim(regexp_replace(regexp_replace(text, '\\b[0-9]+[a-z]+\\b', ' ', 'g'), '[\\t\\n\\x0B\\f\\r ]+', ' ', 'g'))"


@R.query("T10", f"SELECT doc_id, {_UNITS} AS bare FROM documents")
def units_removed(t):  # noqa: ANN001, ANN202
    return t("documents").select("doc_id", text.without_units(F.col("text")).alias("bare"))


_PHRASES = (("people team", "staff"), ("talent cell", "staff"), ("quiet room", "room"))


@R.query("T12", "SELECT doc_id, replace(" + "regexp_replace(" * len(_PHRASES) + "lower(text)" + "".join(f", '\\b{a}\\b', '{b}', 'g')" for a, b in _PHRASES) + ", 'works', 'work') AS replaced FROM documents")
def phrases_replaced(t):  # noqa: ANN001, ANN202
    """Whole phrases first, in order, then a string wherever it stands."""
    return t("documents").select("doc_id", text.replaced(F.lower("text"), _PHRASES, [("works", "work")]).alias("replaced"))


_WATCHED = ("engineer", "nurse", "sales", "driver")


@R.query("T19", "SELECT jobid, " + ", ".join(f"coalesce(regexp_matches(lower({c}), '\\b({'|'.join(_WATCHED)})\\b'), false) AS in_{c}" for c in ("jobtitle", "keyskills", "displayname"))
    + ", CASE " + " ".join(f"WHEN regexp_matches(lower(concat_ws(chr(10), jobtitle, keyskills, displayname)), '\\b{w}\\b') THEN '{w}'" for w in _WATCHED) + " END AS first FROM jobs")
def watched_words(t):  # noqa: ANN001, ANN202
    """Which of three fields hold a watched word, and the first word of the list that any of them holds."""
    fields = ("jobtitle", "keyskills", "displayname")
    held = [F.coalesce(F.lower(c).rlike(rf"\b({'|'.join(_WATCHED)})\b"), F.lit(False)).alias(f"in_{c}") for c in fields]
    return t("jobs").select("jobid", *held, text.first_word(F.lower(F.concat_ws("\n", *fields)), _WATCHED).alias("first"))


@R.query("T20", "SELECT o_orderkey, url_decode(url_decode(replace(url_encode(url_encode(o_orderpriority || ' & ' || o_orderkey)), '%2B', '%2B'))) AS twice FROM orders")
def decoded_twice(t):  # noqa: ANN001, ANN202
    """Texts that were encoded twice on their way through two redirects."""
    plain = F.concat("o_orderpriority", F.lit(" & "), F.col("o_orderkey").cast("string"))
    return t("orders").select("o_orderkey", text.decoded_twice(F.url_encode(F.url_encode(plain))).alias("twice"))


@R.query("T23", "SELECT jobid, CASE WHEN displayname IS NULL THEN 'New job: ' || coalesce(jobtitle, 'an opening') ELSE coalesce(jobtitle, 'an opening') || ' at ' || displayname || CASE WHEN maxexperience IS NULL THEN '' ELSE ' (up to ' || maxexperience || ' years)' END END AS subject FROM jobs")
def subject_lines(t):  # noqa: ANN001, ANN202
    """Subject lines from a template, with what is missing left out."""
    title = F.coalesce("jobtitle", F.lit("an opening"))
    years = F.coalesce(F.concat(F.lit(" (up to "), F.col("maxexperience").cast("string"), F.lit(" years)")), F.lit(""))
    return t("jobs").select("jobid", F.coalesce(F.concat(title, F.lit(" at "), "displayname", years), F.concat(F.lit("New job: "), title)).alias("subject"))


@R.query("D1", "SELECT userid, date_trunc('day', lastlogin) AS midnight, date_trunc('day', lastlogin) - INTERVAL 1 DAY + INTERVAL '18:30' HOUR_MINUTE AS evening_before FROM candidatestaticinc".replace("INTERVAL '18:30' HOUR_MINUTE", "INTERVAL 18 HOUR + INTERVAL 30 MINUTE"))
def day_edges(t):  # noqa: ANN001, ANN202
    """Midnight of a day, and half past six of the evening before."""
    midnight = F.to_date("lastlogin").cast("timestamp_ntz")
    return t("candidatestaticinc").select("userid", midnight.alias("midnight"), (midnight - F.expr("INTERVAL 1 DAY") + F.expr("INTERVAL '18:30' HOUR TO MINUTE")).alias("evening_before"))


@R.query("N5", "SELECT u1, u2, list_position(x, list_reverse_sort(x)[2])::BIGINT AS second_at FROM (SELECT u1, u2, list_transform([exp_sim, sal_sim, ind_sim, jt_sim], lambda v, i: v * 10 - i) AS x FROM similarprofiles WHERE exp_sim IS NOT NULL AND sal_sim IS NOT NULL AND ind_sim IS NOT NULL AND jt_sim IS NOT NULL)")
def second_place(t):  # noqa: ANN001, ANN202
    """The index of the second largest of four values; of equal ones the first counts as larger."""
    parts = F.array("exp_sim", "sal_sim", "ind_sim", "jt_sim")
    ranked = F.sort_array(F.transform(parts, lambda v, i: F.struct(v.alias("v"), (-i).alias("i"))), asc=False)
    return t("similarprofiles").dropna(subset=["exp_sim", "sal_sim", "ind_sim", "jt_sim"]).select("u1", "u2", (1 - F.element_at(ranked, 2)["i"]).cast("bigint").alias("second_at"))


_AGENTS = (
    "Mozilla/5.0 (Windows NT 6.1; WOW64) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/45.0.2454.85 Safari/537.36",
    "Mozilla/5.0 (Macintosh; Intel Mac OS X 10_10_5) AppleWebKit/600.8.9 (KHTML, like Gecko) Version/8.0.8 Safari/600.8.9",
    "Mozilla/5.0 (X11; Ubuntu; Linux x86_64; rv:40.0) Gecko/20100101 Firefox/40.0",
    "Mozilla/5.0 (Linux; Android 5.0; SM-G900F) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/44.0.2403.133 Mobile Safari/537.36",
    "Mozilla/5.0 (iPhone; CPU iPhone OS 8_4 like Mac OS X) AppleWebKit/600.1.4 (KHTML, like Gecko) Version/8.0 Mobile/12H143 Safari/600.1.4",
    "Mozilla/4.0 (compatible; MSIE 8.0; Windows NT 5.1; Trident/4.0)",
    "curl/7.43.0",
)
_SYSTEMS = (("iPhone|iPad", "iOS"), ("Android", "Android"), ("Windows", "Windows"), ("Mac OS X", "Mac"), ("Linux", "Linux"))
_BROWSERS = (("MSIE|Trident", "Internet Explorer"), ("Firefox/", "Firefox"), ("Chrome/", "Chrome"), ("Safari/", "Safari"))
_CASE = lambda table: "CASE " + " ".join(f"WHEN regexp_matches(agent, '{a}') THEN '{b}'" for a, b in table) + " ELSE 'other' END"


@R.query("K9", f"WITH a AS (SELECT [{', '.join(chr(39) + a + chr(39) for a in _AGENTS)}][event_id % {len(_AGENTS)} + 1] AS agent FROM events) SELECT {_CASE(_SYSTEMS)} AS os, {_CASE(_BROWSERS)} AS browser, count(*) AS n FROM a GROUP BY 1, 2")
def agent_systems(t):  # noqa: ANN001, ANN202
    """Operating system and browser of user agents, each by the first pattern of its table that fits."""
    agent = F.element_at(F.array(*map(F.lit, _AGENTS)), (F.col("event_id") % len(_AGENTS) + 1).cast("int"))
    rows = t("events").groupBy(agent.alias("agent")).agg(F.count(F.lit(1)).alias("n"))
    return rows.groupBy(text.agent_family(F.col("agent"), list(_SYSTEMS)).alias("os"), text.agent_family(F.col("agent"), list(_BROWSERS)).alias("browser")).agg(F.sum("n").alias("n"))


@R.query("K4", "SELECT _id, list_transform(sj, lambda s: s.job) AS jobs, len(list_filter(sj, lambda s: s.cossim IS NOT NULL))::INTEGER AS n_scored FROM jobsuggestions WHERE sj IS NOT NULL")
def json_nested(t):  # noqa: ANN001, ANN202
    """A field of every element of an array in a JSON document."""
    doc = F.to_json(F.struct(F.struct(F.col("sj").alias("items")).alias("body")))
    items = F.from_json(doc, "body struct<items: array<struct<job: bigint, cossim: int>>>")["body"]["items"]
    return t("jobsuggestions").where("sj IS NOT NULL").select("_id", F.transform(items, lambda s: s["job"]).alias("jobs"), F.size(F.filter(items, lambda s: s["cossim"].isNotNull())).alias("n_scored"))
