"""Similarity, recommendation and model queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.functions import text
from marketlens.operators import models
from marketlens.operators import relational as rel
from marketlens.operators import similarity as sim
from marketlens.plans.registry import Registry
from marketlens.plans.scalar import _TOKENS

R = Registry()
_DICTIONARY = "SELECT skill_desc AS phrase, min(skill_id) AS term_id FROM lookup_skill GROUP BY 1"


def _skills(t) -> DataFrame:  # noqa: ANN001
    return t("lookup_skill").groupBy(F.col("skill_desc").alias("phrase")).agg(F.min("skill_id").alias("term_id"))


@R.query("M1 T15", f"""WITH w AS (SELECT jobid, {_TOKENS.format('keyskills')} AS w FROM jobs), g AS (
    SELECT jobid, unnest(w) AS phrase FROM w UNION ALL SELECT jobid, unnest(list_transform(generate_series(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1])) FROM w
    UNION ALL SELECT jobid, unnest(list_transform(generate_series(1, len(w) - 2), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) FROM w)
    SELECT jobid, term_id, count(*) AS n FROM g JOIN ({_DICTIONARY}) d ON g.phrase = d.phrase GROUP BY 1, 2""")  # fmt: skip
def skill_bag_of_words(t):  # noqa: ANN001, ANN202
    return sim.bag_of_words(t("jobs"), "jobid", text.tokens(F.col("keyskills")), _skills(t))


_COS = "(SELECT q.vec_id AS query_id, v.vec_id AS vec_id, round(list_cosine_similarity(q.embedding::DOUBLE[], v.embedding::DOUBLE[]), 4) AS similarity FROM embeddings q JOIN embeddings v ON q.vec_id <> v.vec_id WHERE q.vec_id % 20 = 0)"


@R.query("F10", f"SELECT query_id, vec_id, similarity, rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, vec_id) AS rank FROM {_COS} WHERE similarity >= 0.18) WHERE rank <= 10")
def nearest_vectors(t):  # noqa: ANN001, ANN202
    """The ten nearest vectors, with cosine 0.18 or more, of every vector whose id is divisible by 20."""
    e = t("embeddings")
    return sim.cosine_neighbours(e, e.where("vec_id % 20 = 0"), "vec_id", "embedding", 10, 0.18)


_APPS = "(SELECT DISTINCT userid AS u, jobid AS i FROM candidatematchinc WHERE isapply = 1 AND userid IS NOT NULL AND jobid IS NOT NULL)"
_PAIRS = f"(SELECT a.i AS item_a, b.i AS item_b, count(*) AS n_ab FROM {_APPS} a JOIN {_APPS} b ON a.u = b.u AND a.i < b.i GROUP BY 1, 2 HAVING count(*) >= 5)"
_CO = f"SELECT item_a, item_b, n_ab, x.n AS n_a, y.n AS n_b, round(1000 * n_ab / sqrt((x.n * y.n)::DOUBLE))::BIGINT AS cosine FROM {_PAIRS} p JOIN (SELECT i, count(*) AS n FROM {_APPS} GROUP BY 1) x ON x.i = item_a JOIN (SELECT i, count(*) AS n FROM {_APPS} GROUP BY 1) y ON y.i = item_b"


def _applied(t) -> DataFrame:  # noqa: ANN001
    return t("candidatematchinc").where("isapply = 1")


@R.query("M10 J19", _CO)
def co_application(t):  # noqa: ANN001, ANN202
    return sim.co_application(_applied(t), "userid", "jobid", 5)


@R.query("M11", f"WITH c AS ({_CO}), s AS (SELECT item_a AS item, item_b AS other, cosine FROM c UNION ALL SELECT item_b, item_a, cosine FROM c) SELECT u AS userid, other, sum(cosine)::BIGINT AS score FROM {_APPS} a JOIN s ON a.i = s.item WHERE NOT EXISTS (SELECT 1 FROM {_APPS} d WHERE d.u = a.u AND d.i = s.other) GROUP BY 1, 2")
def collaborative_scores(t):  # noqa: ANN001, ANN202
    return sim.collaborative_scores(_applied(t), "userid", "jobid", sim.both_ways(sim.co_application(_applied(t), "userid", "jobid", 5)))


@R.query("M13", "SELECT u1, u2, s AS score, rank FROM (SELECT *, row_number() OVER (PARTITION BY u1 ORDER BY s DESC, u2) AS rank FROM (SELECT u1, u2, round(CASE WHEN max(skill_sim) >= 950 THEN max(overall_sim) * 0.33 ELSE max(overall_sim) END, 2)::DOUBLE AS s FROM similarprofiles WHERE u1 <> u2 AND overall_sim BETWEEN 0 AND 1000 GROUP BY 1, 2) WHERE s >= 50) WHERE rank <= 45")
def damped_digest(t):  # noqa: ANN001, ANN202
    g = t("similarprofiles").where("u1 <> u2 AND overall_sim BETWEEN 0 AND 1000").groupBy("u1", "u2").agg(F.max("overall_sim").alias("o"), F.max("skill_sim").alias("k"))
    s = g.select("u1", "u2", F.round(F.when(F.col("k") >= 950, F.col("o") * 0.33).otherwise(F.col("o").cast("double")), 2).alias("score")).where("score >= 50")
    return rel.top_k(s, ["u1"], [F.desc("score"), F.asc("u2")], 45)


@R.query("M15", "WITH n AS (SELECT industry AS fa, trim(lower(x)) AS skill, count(*) AS n FROM (SELECT industry, unnest(regexp_split_to_array(keyskills, '[,;|]')) AS x FROM jobs) WHERE industry IS NOT NULL AND x IS NOT NULL GROUP BY 1, 2), r AS (SELECT *, sum(n) OVER (PARTITION BY fa) AS t, row_number() OVER (PARTITION BY fa ORDER BY n DESC, skill) AS r FROM n) SELECT fa, skill, n, round(n / t * 10 * (exp(2 * n / 250.0) - 1) / (exp(2 * n / 250.0) + 1), 6) AS importance FROM r WHERE r <= 1000")
def area_skill_importance(t):  # noqa: ANN001, ANN202
    rows = t("jobs").select("industry", F.explode(F.split("keyskills", "[,;|]")).alias("x")).select("industry", F.trim(F.lower("x")).alias("skill"))
    return sim.skill_importance(rows, "industry", "skill")


@R.query("M18", "SELECT _id, list_sort(list(DISTINCT item)) AS live FROM (SELECT _id, unnest(sj).job AS item FROM jobsuggestions) WHERE item IN (SELECT jobid FROM jobs WHERE jobid IS NOT NULL) GROUP BY 1")
def live_archive(t):  # noqa: ANN001, ANN202
    """Archived suggestions of each job, over all its runs, pruned to live items; empty archives are dropped."""
    items = t("jobsuggestions").select("_id", F.explode("sj.job").alias("item")).distinct()
    live = items.join(t("jobs").select(F.col("jobid").alias("item")).distinct(), "item", "left_semi")
    return live.groupBy("_id").agg(F.array_sort(F.collect_set("item")).alias("live"))


@R.query("M21", f"SELECT jobid, round(len(list_intersect(a, b)) / nullif(len(list_distinct(a)), 0), 4) AS over_title, round(len(list_intersect(a, b)) / nullif(len(list_distinct(b)), 0), 4) AS over_skills FROM (SELECT jobid, {_TOKENS.format('jobtitle')} AS a, {_TOKENS.format('keyskills')} AS b FROM jobs WHERE jobtitle IS NOT NULL AND keyskills IS NOT NULL)")
def token_overlap(t):  # noqa: ANN001, ANN202
    a, b = text.tokens(F.col("jobtitle")), text.tokens(F.col("keyskills"))
    rows = t("jobs").where("jobtitle IS NOT NULL AND keyskills IS NOT NULL")
    return rows.select("jobid", text.overlap_ratio(a, b, a).alias("over_title"), text.overlap_ratio(a, b, b).alias("over_skills"))


@R.query("A21", "SELECT m.jobid, m.industry, round(count(*) / sum(count(*)) OVER (PARTITION BY m.jobid), 4) AS p FROM (SELECT c.jobid, j.industry FROM candidatematchinc c JOIN (SELECT jobid, min(industry) AS industry FROM jobs GROUP BY 1) j ON c.jobid = j.jobid WHERE j.industry IS NOT NULL) m GROUP BY 1, 2")
def area_shares(t):  # noqa: ANN001, ANN202
    """Transition shares from job to area; records are counted by job before the join."""
    per = t("candidatematchinc").groupBy("jobid").agg(F.count(F.lit(1)).alias("n"))
    area = t("jobs").groupBy("jobid").agg(F.min("industry").alias("industry")).where("industry IS NOT NULL")
    both = per.join(area, "jobid").groupBy("jobid", "industry").agg(F.sum("n").alias("n"))
    total = both.groupBy("jobid").agg(F.sum("n").alias("t"))
    return both.join(total, "jobid").select("jobid", "industry", F.round(F.col("n") / F.col("t"), 4).alias("p"))


def _labelled(t) -> DataFrame:  # noqa: ANN001
    labels = t("labels").where("subject IS NOT NULL").groupBy("doc_id").agg(F.min(F.lower(F.trim("subject"))).alias("label"))
    return t("documents").where("text IS NOT NULL").join(labels, "doc_id").select("doc_id", text.tokens(F.col("text")).alias("words"), "label")


@R.query("M22", None)
def classifier_confusion(t):  # noqa: ANN001, ANN202
    """Confusion of a logistic regression on one fold held out of ten."""
    rows = models.fold(_labelled(t), "doc_id")
    return models.confusion(rows.where("fold <> 0"), rows.where("fold = 0"), "label")


@R.query("M24", None)
def forest_labels(t):  # noqa: ANN001, ANN202
    """The two likeliest labels of every document by a random forest."""
    rows = t("documents").where("text IS NOT NULL").select("doc_id", text.tokens(F.col("text")).alias("words"))
    return models.best_two(_labelled(t), rows, "doc_id", "label")


@R.query("M5", f"WITH s AS (SELECT query_id, vec_id, label, similarity FROM {_COS} JOIN (SELECT vec_id, label FROM embeddings) USING (vec_id)), n AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, vec_id) AS r FROM s), g AS (SELECT *, row_number() OVER (PARTITION BY query_id, label ORDER BY similarity DESC, vec_id) AS g FROM n WHERE r <= 300), t AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, vec_id) AS rank FROM g WHERE g <= 2) SELECT query_id, vec_id, similarity, rank FROM t WHERE rank <= 10")
def capped_neighbours(t):  # noqa: ANN001, ANN202
    """Of the 300 nearest vectors the first ten with no more than two of any label."""
    e = t("embeddings")
    near = sim.cosine_neighbours(e, e.where("vec_id % 20 = 0"), "vec_id", "embedding", 300).drop("rank")
    labelled = near.join(e.select(F.col("vec_id").cast("bigint").alias("vec_id"), "label"), "vec_id")
    return rel.capped_top_k(labelled, "query_id", "label", [F.desc("similarity"), F.asc("vec_id")], 2, 10).select("query_id", "vec_id", "similarity", "rank")


@R.query("M19", "SELECT jobid, (CASE WHEN title IS NULL OR title = '' THEN 0 WHEN length(title) < 10 THEN 1 WHEN length(title) < 25 THEN 2 ELSE 3 END + CASE WHEN k IS NULL OR k <= 1 THEN 1 WHEN k <= 5 THEN 2 ELSE 3 END + CASE WHEN displayname IS NULL THEN 0 ELSE 1 END)::INTEGER AS quality FROM (SELECT jobid, trim(jobtitle, ' ') AS title, len(regexp_split_to_array(keyskills, '[,;|]')) AS k, displayname FROM jobs)")
def completeness_score(t):  # noqa: ANN001, ANN202
    """How complete a posting is: title, skills and name, each in steps."""
    title, k = F.trim("jobtitle"), F.size(F.split("keyskills", "[,;|]"))
    n = F.when(title.isNull() | (title == ""), 0).when(F.length(title) < 10, 1).when(F.length(title) < 25, 2).otherwise(3)
    m = F.when(F.col("keyskills").isNull() | (k <= 1), 1).when(k <= 5, 2).otherwise(3)
    return t("jobs").select("jobid", (n + m + F.when(F.col("displayname").isNull(), 0).otherwise(1)).alias("quality"))
