"""The recommendation pipeline of the marketplace: match scores, product scores, digests, neighbours, mappings, feeds."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlens.functions import scoring, text
from marketlens.functions.keys import entity_id
from marketlens.operators import incremental as inc
from marketlens.operators import models
from marketlens.operators import recommend as rec
from marketlens.operators import relational as rel
from marketlens.operators import similarity as sim
from marketlens.plans.general import _BLANKS
from marketlens.plans.registry import Registry
from marketlens.plans.scalar import _TOKENS
from marketlens.plans.similar import _APPS, _CO, _applied
from marketlens.session import written
from marketlens.sources import files

R = Registry()
ASOF = "2015-10-01"


def _id(c: str) -> str:
    return f"nullif(nullif(nullif(nullif(lower(trim({c}, {_BLANKS})), ''), '0'), 'none'), 'null')"


# --- match scores

#: One row a candidate: latest state, and areas and cities of the preferences.
_PEOPLE = f"""people AS (SELECT u, max(experience) FILTER (experience >= 0) AS exp, max(salary) FILTER (salary >= 0) AS sal, max(lookup_id) AS lookup_id, max(lastlogin) AS lastlogin, max(profiletitle) AS title
  FROM (SELECT {_id('userid')} AS u, * FROM candidatestaticinc) WHERE u IS NOT NULL GROUP BY 1),
prefs AS (SELECT u, list_sort(list(DISTINCT v) FILTER (t = 8)) AS cities, list_sort(list(DISTINCT v) FILTER (t = 9)) AS inds, min(v) FILTER (t = 9) AS ind, min(v) FILTER (t = 10) AS subfa, list_sort(list(DISTINCT v) FILTER (t = 3)) AS skills
  FROM (SELECT {_id('fcu')} AS u, t, v FROM candidatepreferences WHERE v > 0) WHERE u IS NOT NULL GROUP BY 1),
posts AS (SELECT jobid, max(industry) AS industry, max(minexperience) AS lo, max(maxexperience) AS hi, max(salarymin) AS slo, max(salarymax) AS shi, max(publisheddate) AS pub, max(jobstatus) AS status, max(companyid) AS company,
  max(lower(concat_ws(' ', jobtitle, keyskills))) AS title FROM jobs WHERE jobid IS NOT NULL GROUP BY 1),
places AS (SELECT jobid_id AS jobid, list_sort(list(DISTINCT attvalue)) AS cities FROM recruiter_jobattribute WHERE atttype = 13 AND attvalue > 0 AND jobid_id IS NOT NULL GROUP BY 1)"""


def _people(t) -> DataFrame:  # noqa: ANN001
    known = lambda c: F.max(F.when(F.col(c) >= 0, F.col(c)))
    return t("candidatestaticinc").groupBy(entity_id(F.col("userid")).alias("u")).agg(
        known("experience").alias("exp"), known("salary").alias("sal"), F.max("lookup_id").alias("lookup_id"), F.max("lastlogin").alias("lastlogin"), F.max("profiletitle").alias("title")
    ).where("u IS NOT NULL")


def _prefs(t) -> DataFrame:  # noqa: ANN001
    pick = lambda k: F.when(F.size(F.collect_set(F.when(F.col("t") == k, F.col("v")))) > 0, F.array_sort(F.collect_set(F.when(F.col("t") == k, F.col("v")))))
    least = lambda k: F.min(F.when(F.col("t") == k, F.col("v")))
    rows = t("candidatepreferences").where("v > 0").groupBy(entity_id(F.col("fcu")).alias("u"))
    return rows.agg(pick(8).alias("cities"), pick(9).alias("inds"), least(9).alias("ind"), least(10).alias("subfa"), pick(3).alias("skills")).where("u IS NOT NULL")


def _posts(t) -> DataFrame:  # noqa: ANN001
    names = {"industry": "industry", "minexperience": "lo", "maxexperience": "hi", "salarymin": "slo", "salarymax": "shi", "publisheddate": "pub", "jobstatus": "status", "companyid": "company"}
    return t("jobs").where("jobid IS NOT NULL").groupBy("jobid").agg(*[F.max(c).alias(n) for c, n in names.items()], F.max(F.lower(F.concat_ws(" ", "jobtitle", "keyskills"))).alias("title"))


def _places(t) -> DataFrame:  # noqa: ANN001
    rows = t("recruiter_jobattribute").where("atttype = 13 AND attvalue > 0 AND jobid_id IS NOT NULL")
    return rows.groupBy(F.col("jobid_id").alias("jobid")).agg(F.array_sort(F.collect_set("attvalue")).alias("cities"))


# the lookup has no distances: a place is near those of neighbouring ids, and every tenth is a state whose capital comes next
_MATRIX = """matrix AS (SELECT a.city_id AS a, b.city_id AS b, CASE abs(a.city_id - b.city_id) WHEN 0 THEN 1.0 WHEN 1 THEN 0.6 ELSE 0.3 END::DOUBLE AS score
  FROM lookup_city a JOIN lookup_city b ON abs(a.city_id - b.city_id) <= 2 WHERE a.city_id % 10 <> 0 AND b.city_id % 10 <> 0),
capitals AS (SELECT city_id AS state, city_id + 1 AS capital FROM lookup_city WHERE city_id % 10 = 0)"""


def _matrix(t) -> tuple[DataFrame, DataFrame]:  # noqa: ANN001
    c = t("lookup_city").where("city_id % 10 <> 0")
    near = c.select(F.col("city_id").alias("a"), F.explode(F.sequence(F.col("city_id") - 2, F.col("city_id") + 2)).alias("b")).join(c.select(F.col("city_id").alias("b")), "b")
    gap = F.abs(F.col("a") - F.col("b"))
    matrix = near.select("a", "b", F.when(gap == 0, 1.0).when(gap == 1, 0.6).otherwise(0.3).alias("score"))
    return matrix, t("lookup_city").where("city_id % 10 = 0").select(F.col("city_id").alias("state"), (F.col("city_id") + 1).alias("capital"))


_CITY = """wanted AS (SELECT DISTINCT u, jobid, unnest(x.cities) AS a, y.cities AS c FROM pairs JOIN prefs x USING (u) JOIN places y USING (jobid) WHERE x.cities IS NOT NULL),
every AS (SELECT u, jobid, a, unnest(c) AS b FROM wanted),
looked AS (SELECT u, jobid, coalesce(m.score, CASE WHEN k.capital IS NOT NULL THEN m1.score ELSE m2.score END) AS s FROM every e LEFT JOIN matrix m ON m.a = e.a AND m.b = e.b LEFT JOIN capitals k ON k.state = e.a
  LEFT JOIN capitals l ON l.state = e.b LEFT JOIN matrix m1 ON m1.a = k.capital AND m1.b = e.b LEFT JOIN matrix m2 ON m2.a = e.a AND m2.b = l.capital),
city AS (SELECT u, jobid, coalesce(max(s), 0.0) AS city_score FROM looked GROUP BY 1, 2)"""
_PAIRS = f"pairs AS (SELECT {_id('userid')} AS u, jobid, max(isapply) AS applied FROM candidatematchinc WHERE jobid IS NOT NULL GROUP BY 1, 2 HAVING u IS NOT NULL)"


def _pairs(t) -> DataFrame:  # noqa: ANN001
    return t("candidatematchinc").where("jobid IS NOT NULL").groupBy(entity_id(F.col("userid")).alias("u"), "jobid").agg(F.max("isapply").alias("applied")).where("u IS NOT NULL")


def _city_scores(t) -> DataFrame:  # noqa: ANN001
    both = _pairs(t).join(_prefs(t).select("u", "cities").where("cities IS NOT NULL"), "u").join(_places(t).withColumnRenamed("cities", "offered"), "jobid")
    return rec.city_score(both, ["u", "jobid"], "cities", "offered", *_matrix(t))


@R.query("K3 M4", f"WITH {_PEOPLE}, {_MATRIX}, {_PAIRS}, {_CITY} SELECT u, jobid, city_score FROM city")
def city_scores(t):  # noqa: ANN001, ANN202
    """The best score of a candidate's cities against a job's, states standing for their capitals where need be."""
    return _city_scores(t)


_AREA = "areas AS (SELECT a AS ind, map_from_entries(list((b, share))) AS scores FROM (SELECT a, b, round(n / sum(n) OVER (PARTITION BY a), 6) AS share FROM moves) GROUP BY 1)"
_MOVES = f"moves AS (SELECT p.ind AS a, j.industry AS b, count(*) AS n FROM (SELECT * FROM pairs WHERE applied = 1) x JOIN prefs p USING (u) JOIN posts j USING (jobid) WHERE p.ind IS NOT NULL AND j.industry IS NOT NULL GROUP BY 1, 2)"


def _moves(t) -> DataFrame:  # noqa: ANN001
    rows = _pairs(t).where("applied = 1").join(_prefs(t).select("u", "ind"), "u").join(_posts(t).select("jobid", "industry"), "jobid")
    return rec.transition_shares(rows, "ind", "industry")


@R.query("M28 M27", f"WITH {_PEOPLE}, {_PAIRS}, {_MOVES} SELECT a AS ind, b AS industry, n, round(n / sum(n) OVER (PARTITION BY a), 6) AS share FROM moves")
def area_transitions(t):  # noqa: ANN001, ANN202
    """From the candidate's own industry to those of the jobs applied for."""
    return _moves(t)


@R.query("M27", f"WITH {_PEOPLE}, {_PAIRS}, g AS (SELECT hi AS job_maxexp, exp AS user_experience, count(*) AS n FROM pairs JOIN posts USING (jobid) JOIN people USING (u) WHERE applied = 1 AND hi IS NOT NULL AND exp IS NOT NULL GROUP BY 1, 2) SELECT job_maxexp, user_experience, n, round(n / sum(n) OVER (PARTITION BY job_maxexp), 6) AS share FROM g")
def experience_table(t):  # noqa: ANN001, ANN202
    """The table of a job's upper limit of experience by the experience of its applicants."""
    rows = _pairs(t).where("applied = 1").join(_posts(t).select("jobid", F.col("hi").alias("job_maxexp")), "jobid").join(_people(t).select("u", F.col("exp").alias("user_experience")), "u")
    return rec.transition_shares(rows, "job_maxexp", "user_experience")


_SCORED = f"""{_PEOPLE}, {_MATRIX}, {_PAIRS}, {_CITY}, {_MOVES}, {_AREA},
words AS (SELECT u, jobid, list_distinct({_TOKENS.format('people.title')}) AS x, list_distinct({_TOKENS.format('posts.title')}) AS y FROM pairs JOIN people USING (u) JOIN posts USING (jobid) WHERE people.title IS NOT NULL AND posts.title IS NOT NULL),
cosine AS (SELECT u, jobid, len(list_intersect(x, y)) / sqrt((len(x) * len(y))::DOUBLE) AS cosine FROM words WHERE len(x) > 0 AND len(y) > 0),
scored AS (SELECT u, jobid, company, round(cosine, 6) AS cosine, coalesce(city_score, 0.0) AS city_score, list_max(list_transform(list_intersect(map_keys(scores), [industry]), lambda k: scores[k])) AS area_score,
  CASE WHEN status IN (3, 9) THEN 1.0 ELSE 0.5 END::DOUBLE AS boost
  FROM cosine JOIN pairs USING (u, jobid) JOIN posts USING (jobid) JOIN people USING (u) JOIN prefs USING (u) JOIN areas USING (ind) LEFT JOIN city USING (u, jobid)
  WHERE cosine >= 0.1 AND pub IS NOT NULL AND industry IS NOT NULL AND coalesce(applied, 0) <> 1
  AND NOT coalesce(lo > exp, false) AND NOT coalesce(exp > hi, false) AND NOT coalesce(slo > sal, false) AND NOT coalesce(sal > shi, false) AND list_contains(map_keys(scores), industry)),
matched AS (SELECT u, jobid, company, cosine, city_score, area_score, boost, round(0.7 * cosine + 0.2 * city_score + 0.1 * boost + cosine * area_score, 6) AS score FROM scored)"""


def _scored(t) -> DataFrame:  # noqa: ANN001
    posts, people, prefs = _posts(t), _people(t), _prefs(t)
    areas = _moves(t).groupBy("ind").agg(F.map_from_entries(F.collect_list(F.struct("industry", "share"))).alias("scores"))  # one entry for each of an area's areas
    rows = (
        _pairs(t).where("coalesce(applied, 0) <> 1").join(posts.where("pub IS NOT NULL AND industry IS NOT NULL AND title IS NOT NULL"), "jobid")
        .join(people.withColumnRenamed("title", "own").where("own IS NOT NULL"), "u").join(prefs.select("u", "ind"), "u").join(areas, "ind")
    )
    x, y = F.array_distinct(text.tokens(F.col("own"))), F.array_distinct(text.tokens(F.col("title")))
    rows = rows.withColumn("cosine", F.try_divide(F.size(F.array_intersect(x, y)), F.sqrt((F.size(x) * F.size(y)).cast("double"))))
    fits = (scoring.overlaps(F.col("lo"), F.col("hi"), F.col("exp"), F.col("exp")) == 1) & (scoring.overlaps(F.col("slo"), F.col("shi"), F.col("sal"), F.col("sal")) == 1)
    rows = rows.where((F.col("cosine") >= 0.1) & fits).withColumn("area_score", rec.best_common(F.col("scores"), F.array("industry"))).where("area_score IS NOT NULL")
    rows = rows.join(_city_scores(t), ["u", "jobid"], "left").withColumn("city_score", F.coalesce("city_score", F.lit(0.0))).withColumn("cosine", F.round("cosine", 6))
    rows = rows.withColumn("boost", F.when(F.col("status").isin(3, 9), 1.0).otherwise(0.5))
    score = F.round(rec.match_score(F.col("cosine"), F.col("city_score"), F.col("boost"), F.col("area_score")), 6)
    return rows.select("u", "jobid", "company", "cosine", "city_score", "area_score", "boost", score.alias("score"))


@R.query("M3 M4 K2 F9 F11", f"WITH {_SCORED} SELECT * FROM matched")
def match_scores(t):  # noqa: ANN001, ANN202
    """Matches not applied for, of 0.1 or more in cosine, with pay and experience that fit, scored by text, city, area and boost."""
    return _scored(t)


@R.query("W1 W2 W3 J20", f"WITH {_SCORED}, tiers AS (SELECT *, CASE WHEN boost = 1 THEN 0 ELSE 1 END AS tier FROM matched), a AS (SELECT *, row_number() OVER (PARTITION BY u, tier ORDER BY score DESC, jobid) AS x FROM tiers), b AS (SELECT *, row_number() OVER (PARTITION BY u, company ORDER BY tier, score DESC, jobid) AS y FROM a WHERE x <= 60), c AS (SELECT *, row_number() OVER (PARTITION BY u ORDER BY tier, score DESC, jobid) AS rank FROM b WHERE y <= 3) SELECT u, jobid, tier, rank FROM c WHERE rank <= 15")
def match_lists(t):  # noqa: ANN001, ANN202
    """Up to 15 matches a candidate: the first tier first, no more than three of a company."""
    tiers = _scored(t).withColumn("tier", F.when(F.col("boost") == 1, 0).otherwise(1))
    return rel.tiered_fill(tiers, "u", "company", "tier", [F.desc("score"), F.asc("jobid")], 60, 3, 15).select("u", "jobid", "tier", "rank")


# --- text vectors

_TITLE = _TOKENS.format("jobtitle")


@R.query("M22", f"WITH d AS (SELECT jobid, max(jobtitle) AS jobtitle FROM jobs WHERE jobid IS NOT NULL GROUP BY 1), c AS (SELECT jobid, term, count(*) AS n FROM (SELECT jobid, unnest({_TITLE}) AS term FROM d) GROUP BY 1, 2), v AS (SELECT term, count(*) AS df FROM c GROUP BY 1 ORDER BY df DESC, term LIMIT 500) SELECT jobid, term, n, round(n * ln(((SELECT count(*) FROM d) + 1) / (df + 1)), 6) AS weight FROM c JOIN v USING (term)")
def title_weights(t):  # noqa: ANN001, ANN202
    """Title words of the 500 terms of most titles, by inverse document frequency."""
    docs = t("jobs").where("jobid IS NOT NULL").groupBy("jobid").agg(F.max("jobtitle").alias("title"))
    return rec.tf_idf(docs, "jobid", text.tokens(F.col("title")), 500).withColumn("weight", F.round("weight", 6))


def _latent(t) -> DataFrame:  # noqa: ANN001
    docs = t("jobs").where("jobid IS NOT NULL").groupBy("jobid").agg(F.max(F.concat_ws(" ", "jobtitle", "keyskills")).alias("text"))
    return rec.latent_vectors(rec.tf_idf(docs, "jobid", text.tokens(F.col("text")), 1000), "jobid")


@R.query("M2 J20", None)
def latent_neighbours(t):  # noqa: ANN001, ANN202
    """The 300 nearest jobs, by cosine in the space of 32 factors, 0.18 or more, of every job whose id is divisible by 20."""
    v = _latent(t)
    return sim.cosine_neighbours(v, v.where("jobid % 20 = 0"), "jobid", "vector", 300, 0.18)


@R.query("M5", None)
def job_mapping(t):  # noqa: ANN001, ANN202
    """Jobs of the last month for every job of the last three: ten at most, two of a company."""
    posts, v = _posts(t).select("jobid", "pub", "company"), _latent(t)
    age = F.datediff(F.lit(ASOF).cast("date"), F.to_date("pub"))
    dated = written(v.join(posts.withColumn("age", age).where("age BETWEEN 0 AND 92"), "jobid"), "dated")
    return sim.cosine_neighbours(dated.where("age <= 31"), dated, "jobid", "vector", 300, 0.18, "company", 2, 10)


# --- products and digests

_SIMILAR = "alike AS (SELECT u1 AS u, u2 AS o, max(overall_sim) AS sim FROM similarprofiles WHERE u1 <> u2 AND overall_sim BETWEEN 0 AND 1000 AND (jt_sim > 0 OR skill_sim > 0) GROUP BY 1, 2)"
_PRODUCT = f"""{_PEOPLE}, {_SIMILAR}, co AS ({_CO}), linked AS (SELECT item_a AS i, item_b AS o, cosine FROM co UNION ALL SELECT item_b, item_a, cosine FROM co),
apps AS (SELECT DISTINCT lookup_id AS u, jobid AS i FROM (SELECT {_id('userid')} AS u, jobid FROM candidatematchinc WHERE isapply = 1 AND jobid IS NOT NULL) JOIN people USING (u) WHERE lookup_id IS NOT NULL),
product AS (SELECT s.u, l.o AS item, sum(s.sim::BIGINT * l.cosine)::BIGINT AS score FROM alike s JOIN apps a ON a.u = s.o JOIN linked l ON l.i = a.i GROUP BY 1, 2 HAVING sum(s.sim::BIGINT * l.cosine) >= 50000)"""


def _product(t, bound: DataFrame | None = None, level: DataFrame | None = None, **kw: object) -> DataFrame:  # noqa: ANN001
    """``bound``: ``user, bound``; ``level``: ``other, level``: jobs whose level is below the user's bound are left out, and users and jobs without."""
    s = t("similarprofiles").where("u1 <> u2 AND overall_sim BETWEEN 0 AND 1000 AND (jt_sim > 0 OR skill_sim > 0)").groupBy(F.col("u1").alias("user"), F.col("u2").alias("other")).agg(F.max("overall_sim").cast("bigint").alias("sim"))
    named = t("candidatematchinc").where("isapply = 1 AND jobid IS NOT NULL").select(entity_id(F.col("userid")).alias("u"), F.col("jobid").alias("item"))
    apps = named.join(_people(t).select("u", F.col("lookup_id").alias("user")), "u").where("user IS NOT NULL").select("user", "item").distinct()
    linked = written(sim.both_ways(sim.co_application(_applied(t), "userid", "jobid", 5)), "linked")
    if bound is not None:
        s, linked = s.join(bound, "user"), linked.join(level, "other")
    return rec.product_scores(s, apps, linked, 50_000, **kw)


@R.query("M12", f"WITH {_PRODUCT} SELECT u AS \"user\", item, score FROM product")
def product_scores(t):  # noqa: ANN001, ANN202
    """Similar users x their applications x jobs linked by applicants, cut off below 50,000."""
    return _product(t)


@R.query("W13 M14 F12 N2", f"""WITH {_PRODUCT}, {_PAIRS}, done AS (SELECT DISTINCT lookup_id AS u, jobid AS item FROM pairs JOIN people USING (u) WHERE applied = 1),
    live AS (SELECT p.u, p.item, p.score, round(exp(0.005 * date_diff('day', j.pub::DATE, DATE '{ASOF}')) * CASE j.status WHEN 3 THEN 1.3 WHEN 9 THEN 1.2 ELSE 1.0 END, 6) AS factor FROM product p JOIN posts j ON j.jobid = p.item
      JOIN (SELECT lookup_id, max(exp) AS exp FROM people WHERE lookup_id IS NOT NULL GROUP BY 1) e ON e.lookup_id = p.u WHERE e.exp - j.hi <= 2 AND j.pub IS NOT NULL AND NOT EXISTS (SELECT 1 FROM done d WHERE d.u = p.u AND d.item = p.item)),
    a AS (SELECT *, row_number() OVER (PARTITION BY u ORDER BY score DESC, item) AS r FROM live), b AS (SELECT u, item, score, round(score * factor, 6) AS adjusted FROM a WHERE r <= 100),
    c AS (SELECT *, row_number() OVER (PARTITION BY u ORDER BY adjusted DESC, item) AS rank FROM b) SELECT u AS \"user\", item, score, adjusted, rank FROM c WHERE rank <= 45""")  # fmt: skip
def product_digest(t):  # noqa: ANN001, ANN202
    """Product scores without jobs applied for and jobs far below the candidate's experience: 100 by score, then 45 by score, age and boost."""
    people = _people(t)
    done = _pairs(t).where("applied = 1").join(people.select("u", F.col("lookup_id").alias("user")), "u").select("user", F.col("jobid").alias("item")).distinct()
    exp = people.where("lookup_id IS NOT NULL").groupBy(F.col("lookup_id").alias("user")).agg(F.max("exp").alias("exp"))
    posts = _posts(t).where("pub IS NOT NULL").select(F.col("jobid").alias("item"), "hi", "pub", "status")
    bound = exp.select("user", (F.col("exp").cast("bigint") - 2).alias("bound")).dropna()
    level = posts.select(F.col("item").alias("other"), F.col("hi").alias("level")).dropna()
    rows = _product(t, bound, level, skip=done, first=100).join(posts, "item")
    boost = F.when(F.col("status") == 3, 1.3).when(F.col("status") == 9, 1.2).otherwise(1.0)
    factor = F.round(F.exp(0.005 * F.datediff(F.lit(ASOF).cast("date"), F.to_date("pub"))) * boost, 6)
    return rec.double_cut(rows, "user", "item", "score", factor, 100, 45).select("user", "item", "score", "adjusted", "rank")


@R.query("M16", f"""WITH active AS (SELECT DISTINCT lookup_id AS u2 FROM candidatestaticinc WHERE date_diff('day', lastlogin::DATE, DATE '{ASOF}') <= 92), e AS (SELECT u1, u2, max(overall_sim) AS sim FROM similarprofiles WHERE u1 <> u2 AND overall_sim BETWEEN 600 AND 1000 GROUP BY 1, 2),
    r AS (SELECT *, row_number() OVER (PARTITION BY u1 ORDER BY sim DESC, u2) AS r, count(*) OVER (PARTITION BY u1) AS n FROM e SEMI JOIN active USING (u2)) SELECT u1, list(u2 ORDER BY r) AS others, count(*)::INTEGER AS n FROM r WHERE n >= 10 AND r <= 250 GROUP BY 1""")  # fmt: skip
def similar_candidates(t):  # noqa: ANN001, ANN202
    """Similar candidates of 600 and more who were active in 92 days: 250 at most, lists of under ten are dropped."""
    active = t("candidatestaticinc").where(F.datediff(F.lit(ASOF).cast("date"), F.to_date("lastlogin")) <= 92).select(F.col("lookup_id").alias("u2")).distinct()
    e = t("similarprofiles").where("u1 <> u2 AND overall_sim BETWEEN 600 AND 1000").groupBy("u1", "u2").agg(F.max("overall_sim").alias("sim")).join(active, "u2", "left_semi")
    lists = rel.top_k(e, ["u1"], [F.desc("sim"), F.asc("u2")], 250).groupBy("u1").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "u2"))), lambda x: x["u2"]).alias("others"))
    return lists.withColumn("n", F.size("others")).where("n >= 10")


_LISTS = f"""{_PAIRS}, a AS (SELECT u, list_sort(list(jobid)) AS x FROM pairs WHERE applied = 1 GROUP BY 1), b AS (SELECT u, list_sort(list(jobid)) AS y FROM pairs WHERE applied IS NULL OR jobid % 7 < 3 GROUP BY 1),
l AS (SELECT u, coalesce(x, []) AS x0, coalesce(y, []) AS y FROM a FULL JOIN b USING (u)), m AS (SELECT u, CASE WHEN len(y) = 0 THEN 'a' WHEN len(x0) = 0 THEN 'b' ELSE 'both' END AS route, list_filter(x0, lambda i: NOT list_contains(y, i)) AS x, y FROM l),
o AS (SELECT *, CASE WHEN route = 'a' THEN x ELSE y END AS one FROM m),
s AS (SELECT u, route, x[1:5] AS main_a, y[1:5] AS main_b, CASE WHEN route <> 'both' THEN one[6:10] END AS second, CASE WHEN route <> 'both' THEN one[11:15] WHEN len(x) > 5 THEN x[6:10] WHEN len(x) > 0 AND len(y) > 5 THEN y[6:10] END AS outstanding FROM o)"""


@R.query("M17", f"WITH {_LISTS} SELECT u, route, {', '.join(f'CASE WHEN len({c}) > 0 THEN {c} END AS {c}' for c in ('main_a', 'main_b', 'second', 'outstanding'))} FROM s")
def routed_digests(t):  # noqa: ANN001, ANN202
    """Two lists of jobs a candidate, cut in slices of five for the mailings of those with one list or both."""
    p = _pairs(t)
    lists = lambda w: p.where(w).groupBy("u").agg(F.array_sort(F.collect_list("jobid")).alias("items"))
    return rec.routed(lists("applied = 1"), lists("applied IS NULL OR jobid % 7 < 3"), "u", 5)


# --- neighbours kept up to date

_E = "e AS (SELECT u1, u2, max(overall_sim) AS sim FROM similarprofiles WHERE u1 <> u2 AND overall_sim BETWEEN 0 AND 1000 GROUP BY 1, 2), fresh AS (SELECT DISTINCT lookup_id AS u2 FROM candidatestaticinc WHERE lastmodified >= DATE '2015-09-01' AND lookup_id IS NOT NULL), old AS (SELECT * FROM e ANTI JOIN fresh USING (u2)), new AS (SELECT * FROM e SEMI JOIN fresh USING (u2))"


def _parts(t) -> tuple[DataFrame, DataFrame]:  # noqa: ANN001
    e = t("similarprofiles").where("u1 <> u2 AND overall_sim BETWEEN 0 AND 1000").groupBy("u1", "u2").agg(F.max("overall_sim").alias("sim"))
    fresh = t("candidatestaticinc").where("lastmodified >= DATE '2015-09-01'").select(F.col("lookup_id").alias("u2")).dropna().distinct()
    return e.join(fresh, "u2", "left_anti"), e.join(fresh, "u2", "left_semi")


@R.query("M8", f"WITH {_E}, k AS (SELECT u1, count(*) AS n, min(sim) AS bar FROM (SELECT *, row_number() OVER (PARTITION BY u1 ORDER BY sim DESC, u2) AS r FROM old) WHERE r <= 5 GROUP BY 1) SELECT new.u1, u2, sim FROM new LEFT JOIN k USING (u1) WHERE coalesce(n, 0) < 5 OR sim >= bar")
def accepted_neighbours(t):  # noqa: ANN001, ANN202
    """Edges to changed profiles that reach the fifth best of those a profile has."""
    old, new = _parts(t)
    return rec.accepted_edges(old, new, 5)


@R.query("M8 I9", f"WITH {_E}, n AS (SELECT u2 AS u1, u1 AS u2, sim AS back FROM e) SELECT e.u1, e.u2, coalesce(back, sim) AS sim FROM e LEFT JOIN n USING (u1, u2)")
def updated_links(t):  # noqa: ANN001, ANN202
    """Similarities of linked pairs taken from the opposite direction; no pair is added."""
    old, new = _parts(t)
    e = old.unionByName(new)
    return rec.linked_updates(e, e.select(F.col("u2").alias("u1"), F.col("u1").alias("u2"), "sim"))


@R.query("M9", f"WITH {_PEOPLE}, k AS (SELECT lookup_id, max(u) AS u FROM people WHERE lookup_id IS NOT NULL GROUP BY 1), e AS (SELECT u1, u2, fa, max(overall_sim) AS sim FROM similarprofiles WHERE fa IS NOT NULL GROUP BY 1, 2, 3) SELECT fa::INTEGER AS fa, a.u AS user_a, b.u AS user_b, sim FROM e JOIN k a ON a.lookup_id = u1 JOIN k b ON b.lookup_id = u2")
def edges_by_area(t):  # noqa: ANN001, ANN202
    """Edges with candidate ids for lookup numbers, written in one folder an area and read again."""
    ids = _people(t).where("lookup_id IS NOT NULL").groupBy("lookup_id").agg(F.max("u").alias("u"))
    e = t("similarprofiles").where("fa IS NOT NULL").groupBy("u1", "u2", F.col("fa").cast("int").alias("fa")).agg(F.max("overall_sim").alias("sim"))
    named = e.join(ids.select(F.col("lookup_id").alias("u1"), F.col("u").alias("user_a")), "u1").join(ids.select(F.col("lookup_id").alias("u2"), F.col("u").alias("user_b")), "u2")
    return files.written_by(named.select("fa", "user_a", "user_b", "sim"), "fa")


@R.query("W8", f"WITH {_PEOPLE}, known AS (SELECT u, lookup_id::BIGINT AS id FROM people WHERE lookup_id IS NOT NULL), s AS (SELECT DISTINCT {_id('userid')} AS u FROM candidatematchinc) SELECT u, id FROM known UNION ALL SELECT u, row_number() OVER (ORDER BY u) + (SELECT max(id) FROM known) FROM s WHERE u IS NOT NULL AND u NOT IN (SELECT u FROM known)")
def appended_ids(t):  # noqa: ANN001, ANN202
    """Lookup numbers of the candidates known, and new ones for those who only appear in the matches."""
    known = _people(t).where("lookup_id IS NOT NULL").select("u", F.col("lookup_id").alias("id"))
    return rec.appended_ids(known, t("candidatematchinc").select(entity_id(F.col("userid")).alias("u")), "u", "id")


@R.query("I2", f"SELECT candidatematchid, matchdate, date_diff('day', matchdate::DATE, DATE '{ASOF}') < 183 AS in_short FROM candidatematchinc WHERE date_diff('day', matchdate::DATE, DATE '{ASOF}') BETWEEN 0 AND 364")
def retained_matches(t):  # noqa: ANN001, ANN202
    """Matches of a year, with those of half a year marked: the two windows that are kept."""
    return inc.retained(t("candidatematchinc").select("candidatematchid", "matchdate"), "matchdate", F.lit(ASOF).cast("date"), 183, 365, "in_short")


@R.query("U2", "SELECT k, src, v, row_number() OVER (ORDER BY k, src, v) AS place FROM (SELECT c_custkey AS k, 'c' AS src, c_acctbal AS v FROM customer UNION ALL SELECT o_custkey, 'o', o_totalprice FROM orders)")
def interleaved_by_key(t):  # noqa: ANN001, ANN202
    """Customers and orders in one sequence by customer, with their place in it."""
    rows = rel.interleaved([t("customer").select(F.col("c_custkey").alias("k"), F.lit("c").alias("src"), F.col("c_acctbal").alias("v")), t("orders").select(F.col("o_custkey").alias("k"), F.lit("o").alias("src"), F.col("o_totalprice").alias("v"))], "k")
    return rel.round_robin(rows, ["k", "src", "v"], 1).select("k", "src", "v", (F.col("index") + 1).alias("place"))


@R.query("W4", "SELECT p_brand, p_partkey, s, rank FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY s DESC, p_partkey) AS rank FROM (SELECT p_brand, p_partkey, round(p_size / 7.0 + p_partkey * 1e-12, 6)::DOUBLE AS s FROM part)) WHERE rank <= 5")
def tolerant_top(t):  # noqa: ANN001, ANN202
    """The five best of each group; scores that differ by less than a millionth are equal, and the lower id is kept."""
    rows = t("part").select("p_brand", "p_partkey", F.round(F.col("p_size") / F.lit(7.0) + F.col("p_partkey") * 1e-12, 6).alias("s"))
    return rel.top_k(rows, ["p_brand"], [F.desc("s"), F.asc("p_partkey")], 5)


@R.query("J2", "SELECT jobid, attid, atttype FROM jobs LEFT JOIN recruiter_jobattribute ON jobid_id = jobid WHERE atttype IN (3, 12, 13)")
def left_join_made_inner(t):  # noqa: ANN001, ANN202
    """A condition on the right side after a left join drops the rows without a partner; the optimizer makes an inner join of it."""
    a = t("recruiter_jobattribute")
    return t("jobs").join(a, F.col("jobid") == F.col("jobid_id"), "left").where(F.col("atttype").isin(3, 12, 13)).select("jobid", "attid", "atttype")


@R.query("F12", f"WITH {_PEOPLE}, {_PAIRS} SELECT u, jobid, exp - hi AS over FROM pairs JOIN people USING (u) JOIN posts USING (jobid) WHERE exp - hi <= 2")
def not_over_experienced(t):  # noqa: ANN001, ANN202
    """Matches of candidates with at most two years more than the job asks for."""
    rows = _pairs(t).select("u", "jobid").join(_people(t).select("u", "exp"), "u").join(_posts(t).select("jobid", "hi"), "jobid")
    return rows.select("u", "jobid", (F.col("exp") - F.col("hi")).alias("over")).where("over <= 2")


# --- words and models

_GRAMS = " UNION ALL ".join(f"SELECT jobid, array_to_string(w[i:i + {n - 1}], ' ') AS g FROM (SELECT jobid, w, unnest(range(1, len(w) - {n - 2})) AS i FROM w)" for n in range(1, 7))


@R.query("M26 T15 T16", f"WITH w AS (SELECT jobid, {_TOKENS.format('keyskills')} AS w FROM jobs WHERE jobid IS NOT NULL), g AS ({_GRAMS}), m AS (SELECT jobid, list(DISTINCT s) AS x FROM g JOIN (SELECT DISTINCT lower(skill_desc) AS s FROM lookup_skill) ON s = g GROUP BY 1) SELECT jobid, list_sort(list_filter(x, lambda a: len(list_filter(x, lambda b: b <> a AND contains(b, a))) = 0)) AS groups FROM m")
def canonical_groups(t):  # noqa: ANN001, ANN202
    """The skill names that phrases of one to six words of a job's skills are, without those that another contains."""
    words = t("jobs").where("jobid IS NOT NULL").select("jobid", text.tokens(F.col("keyskills")).alias("w"))
    names = t("lookup_skill").select(F.lower("skill_desc").alias("g")).distinct()
    found = words.select("jobid", F.explode(F.flatten(F.array(*[text.ngrams(F.col("w"), n) for n in range(6, 0, -1)]))).alias("g")).join(names, "g")
    return found.groupBy("jobid").agg(F.collect_set("g").alias("x")).select("jobid", F.array_sort(text.longest_only(F.col("x"))).alias("groups"))


@R.query("T24", "SELECT jobid, list_filter(list_transform(regexp_split_to_array(lower(keyskills), '[,;|]'), lambda x: trim(x)), lambda x: x <> '' AND contains(lower(jobtitle), x)) AS held FROM jobs WHERE jobtitle IS NOT NULL AND keyskills IS NOT NULL")
def skills_in_title(t):  # noqa: ANN001, ANN202
    """Of a job's skills those that its title contains."""
    skills = F.transform(F.split(F.lower("keyskills"), "[,;|]"), lambda x: F.trim(x))
    held = F.filter(skills, lambda x: (x != "") & F.contains(F.lower("jobtitle"), x))
    return t("jobs").where("jobtitle IS NOT NULL AND keyskills IS NOT NULL").select("jobid", held.alias("held"))


@R.query("D9", "SELECT userid, round(CASE WHEN experience >= 0 THEN experience + CASE WHEN experience_month BETWEEN 0 AND 11 THEN experience_month ELSE 0 END / 12 END, 4) AS years FROM candidatestaticinc")
def fractional_experience(t):  # noqa: ANN001, ANN202
    months = F.when(F.col("experience_month").between(0, 11), F.col("experience_month")).otherwise(0)
    return t("candidatestaticinc").select("userid", F.round(F.when(F.col("experience") >= 0, F.col("experience") + months / 12), 4).alias("years"))


@R.query("S21 A13", "SELECT label, (row_number() OVER (ORDER BY n DESC, label) - 1)::DOUBLE AS index, n FROM (SELECT c_mktsegment AS label, count(*) AS n FROM customer GROUP BY 1)")
def saved_model(t):  # noqa: ANN001, ANN202
    """A fitted index of labels, saved, loaded and applied."""
    from pyspark.ml.feature import StringIndexer

    rows = t("customer").select(F.col("c_mktsegment").alias("label"))
    model = files.saved_and_loaded(StringIndexer(inputCol="label", outputCol="index").fit(rows), rows.sparkSession)
    return model.transform(rows).groupBy("label", "index").agg(F.count(F.lit(1)).alias("n"))


@R.query("M23 M22 L5", None)
def cross_confusion(t):  # noqa: ANN001, ANN202
    """Confusion of a logistic regression over all of three folds."""
    from marketlens.plans.similar import _labelled

    return models.cross_confusion(_labelled(t), "doc_id", "label", 3)


@R.query("M24 N5", None)
def nested_labels(t):  # noqa: ANN001, ANN202
    """A job's area by a forest, then its two likeliest sub-areas by the forest of that area; jobs with a coded sub-area are the training rows."""
    words = t("jobs").where("jobid IS NOT NULL").groupBy("jobid").agg(F.max(F.concat_ws(" ", "jobtitle", "keyskills")).alias("x")).select("jobid", text.tokens(F.col("x")).alias("words"))
    coded = t("recruiter_jobattribute").where("atttype = 12 AND attvalue > 0").groupBy(F.col("jobid_id").alias("jobid")).agg(F.min("attvalue").alias("sub_field_id"))
    area = t("lookup_subfunctionalarea").select("sub_field_id", F.col("field_enu").alias("area"), F.col("sub_field_enu").alias("label"))
    return models.nested_labels(words.join(coded, "jobid").join(area, "sub_field_id").select("words", "area", "label"), words, "jobid", "area", "label")


# --- feeds and tables


@R.query("S9 S10", "SELECT c_custkey, nullif(c_mktsegment, 'BUILDING') AS segment, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS balance FROM customer")
def fixed_feed(t):  # noqa: ANN001, ANN202
    """A feed without header, read under fixed names and types: empty fields, and those that short lines lack, are null."""
    c = t("customer")
    segment = F.when(F.col("c_mktsegment") == "BUILDING", "").otherwise(F.coalesce("c_mktsegment", F.lit("")))
    short = F.when(F.col("c_acctbal") >= 0, F.concat(F.lit("|"), F.col("c_acctbal").cast("string"))).otherwise("")
    path = files.fresh_path(c.sparkSession, "feed")
    c.select(F.concat(F.col("c_custkey").cast("string"), F.lit("|"), segment, short).alias("value")).write.text(path)
    return files.fixed_feed(c.sparkSession, path, "c_custkey bigint, segment string, balance double", "|")


@R.query("S11", "WITH d AS (SELECT DISTINCT feed_day FROM activityinc WHERE feed_day IS NOT NULL), g AS (SELECT feed_day, feed_day - (row_number() OVER (ORDER BY feed_day))::INTEGER AS run FROM d) SELECT activityid, feed_day FROM activityinc WHERE feed_day IN (SELECT feed_day FROM g WHERE run = (SELECT max_by(run, feed_day) FROM g))")
def last_unbroken_days(t):  # noqa: ANN001, ANN202
    """The union of the daily files back to the first missing day."""
    a = t("activityinc").select("activityid", "feed_day").where("feed_day IS NOT NULL")
    spark, path = a.sparkSession, files.fresh_path(a.sparkSession, "days")
    a.withColumn("day", F.col("feed_day").cast("string")).repartition("day").write.partitionBy("day").parquet(path)
    days = [r["feed_day"].isoformat() for r in a.select("feed_day").distinct().collect()]  # one row a day
    return spark.read.schema("activityid bigint, feed_day date").parquet(*files.dated_paths(days, path + "/day={}"))


_LINE = "strftime(ts, '%d/%b/%Y:%H:%M:%S') || ' ' || event_type || ' user=' || user_id"


@R.query("S13", f"SELECT {_LINE} AS value FROM events WHERE contains({_LINE}, '15/Jan/2024')")
def one_day_of_logs(t):  # noqa: ANN001, ANN202
    """The lines of one day out of two compressed logs, each of which holds some of it."""
    e = t("events")
    spark, paths = e.sparkSession, [files.fresh_path(e.sparkSession, "log") for _ in range(2)]
    lines = e.select("event_type", F.concat(F.date_format("ts", "dd/MMM/yyyy:HH:mm:ss"), F.lit(" "), "event_type", F.lit(" user="), F.col("user_id").cast("string")).alias("value"))
    views = F.col("event_type") == "view"
    for path, which in zip(paths, (views, ~views), strict=True):
        lines.where(which).select("value").write.text(path, compression="gzip")
    return files.daily_lines(spark, paths, "15/Jan/2024")


@R.query("S15", "SELECT s_suppkey AS k, s_acctbal AS v FROM supplier WHERE s_suppkey NOT IN (SELECT o_custkey FROM orders) UNION ALL SELECT o_custkey, max(o_totalprice) FROM orders GROUP BY 1")
def upserted(t):  # noqa: ANN001, ANN202
    """A table in which new rows replaced those of their keys."""
    s = t("supplier").selectExpr("s_suppkey AS k", "s_acctbal AS v")
    base, target = (files.fresh_path(s.sparkSession, "upsert") for _ in range(2))
    files.append_table(s, base)
    return files.upsert_table(t("orders").groupBy(F.col("o_custkey").alias("k")).agg(F.max("o_totalprice").alias("v")), base, target, "k")


@R.query("S16 I8", "SELECT k, v FROM (SELECT s_suppkey AS k, s_acctbal AS v FROM supplier UNION ALL SELECT c_custkey, c_acctbal FROM customer) WHERE NOT coalesce(v < 0, false)")
def appended_and_removed(t):  # noqa: ANN001, ANN202
    """Two batches appended to a table, and rows removed by a condition."""
    s = t("supplier").selectExpr("s_suppkey AS k", "s_acctbal AS v")
    base, target = (files.fresh_path(s.sparkSession, "rows") for _ in range(2))
    files.append_table(s, base)
    files.append_table(t("customer").selectExpr("c_custkey AS k", "c_acctbal AS v"), base)
    return files.remove_rows(s.sparkSession, base, target, "v < 0")


# --- profile neighbours

_EDGES = (3, 8, 15, 25)
_BAND = lambda c: "CASE " + " ".join(f"WHEN {c} <= {e} THEN {i}" for i, e in enumerate(_EDGES, 1)) + " ELSE 5 END"
_RAW = [f"({b} + {s} / (1 + exp(-({g}) * ({f} * exp({r} * greatest(q.e, 0)) - {o}))))" for b, s, f, r, o, g in scoring.WEIGHTS]
_W = [f"({w} / ({' + '.join(_RAW)}))" for w in _RAW]
_LO, _HI = (lambda c: f"least(q.{c}, p.{c})::DOUBLE"), (lambda c: f"greatest(q.{c}, p.{c})::DOUBLE")
_SIMS = [
    f"CASE WHEN q.e < 0 OR p.e < 0 THEN 0.0 WHEN {_LO('e')} = 0 THEN exp(-2.0 * {_HI('e')}) ELSE exp(-0.4 * pow(({_HI('e')} - {_LO('e')}) / {_LO('e')}, 2) * {_LO('e')}) END",
    f"CASE WHEN q.s < 0 OR p.s < 0 THEN 0.0 WHEN {_LO('s')} = 0 THEN exp(-{_HI('s')}) ELSE exp(-1.3 * (0.2 * pow(({_HI('s')} - {_LO('s')}) / {_LO('s')}, 4) + 0.2 * pow(({_HI('s')} - {_LO('s')}) / {_LO('s')}, 2)) * {_LO('s')}) END",
    *[f"CASE WHEN q.{c} NOT IN ('', '-1') AND q.{c} = p.{c} THEN 1.0 ELSE 0.0 END" for c in ("ind", "subfa", "insti", "title")],
]
_KNOWN = ["q.e <> -1", "q.s <> -1", *[f"q.{c} NOT IN ('', '-1')" for c in ("ind", "subfa", "insti", "title")]]
_NEAR = f"""WITH {_PEOPLE}, f AS (SELECT sub_field_id AS subfa, min(field_id) AS fa FROM lookup_subfunctionalarea GROUP BY 1),
r AS (SELECT lookup_id AS id, fa, coalesce(exp, -1) AS e, coalesce(sal, -1) AS s, coalesce(ind, -1)::VARCHAR AS ind, subfa::VARCHAR AS subfa, '-1' AS insti, array_to_string(coalesce({_TOKENS.format('title')}, []), ' ') AS title, coalesce(skills, []) AS skills
  FROM people JOIN prefs USING (u) JOIN f USING (subfa) WHERE lookup_id IS NOT NULL),
b AS (SELECT *, {_BAND('e')} AS eb, {_BAND('s')} AS sb FROM r),
c AS (SELECT q.id AS query_id, p.id AS id, len(list_intersect(q.skills, p.skills)) AS common, len(q.skills) AS own, len(list_distinct(list_concat(q.skills, p.skills))) AS every, {_W[6]} AS w7,
  {' + '.join(f'{w} * ({x})' for w, x in zip(_W[:6], _SIMS, strict=True))} AS cheap, {' + '.join(f'CASE WHEN {k} THEN {w} ELSE 0.0 END' for w, k in zip(_W[:6], _KNOWN, strict=True))} AS most
  FROM b q JOIN b p ON q.fa = p.fa AND abs(q.eb - p.eb) <= 1 AND abs(q.sb - p.sb) <= 1 AND q.id <> p.id WHERE q.id % 20 = 0),
d AS (SELECT query_id, id, round(cheap + w7 * (0.7 * coalesce(common / nullif(own, 0), 0.0) + 0.3 * coalesce(common / nullif(every, 0), 0.0)), 4) AS similarity FROM c WHERE cheap >= 0.6 * most)
SELECT query_id, id, similarity, rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, id) AS rank FROM d) WHERE rank <= 501"""


def _profiles(t) -> DataFrame:  # noqa: ANN001
    """Candidates as profiles: area, industry and skills from their preferences, bands of experience and salary, the words of the title."""
    area = t("lookup_subfunctionalarea").groupBy(F.col("sub_field_id").alias("subfa")).agg(F.min("field_id").alias("fa"))
    rows = _people(t).where("lookup_id IS NOT NULL").join(_prefs(t), "u").join(area, "subfa")
    known = lambda c: F.coalesce(c, F.lit(-1))
    return rows.select(
        F.col("lookup_id").alias("id"), "fa", known("exp").alias("experience"), known("sal").alias("salary"), scoring.banded(known("exp"), list(_EDGES)).alias("exp_band"), scoring.banded(known("sal"), list(_EDGES)).alias("sal_band"),
        known("ind").alias("ind"), "subfa", F.lit(-1).alias("insti"), F.coalesce(F.array_join(text.tokens(F.col("title")), " "), F.lit("")).alias("title"), F.coalesce("skills", F.array().cast("array<int>")).alias("skills"),
    )


@R.query("M6 J13", _NEAR)
def profile_neighbours(t):  # noqa: ANN001, ANN202
    """The 501 nearest profiles of every profile whose id is divisible by 20."""
    p = _profiles(t)
    return sim.profile_neighbours(p, p.where("id % 20 = 0"), 501)
