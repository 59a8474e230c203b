"""Text classifiers of the job-labelling pipeline, on ``pyspark.ml``."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import IDF, CountVectorizer, NGram, SQLTransformer, StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.functions.keys import portable_hash
from marketlens.session import written


def text_features(words: str = "words", size: int = 4096) -> list:
    """Word and word-pair counts, weighed by inverse document frequency, as ``features``."""
    return [
        NGram(n=2, inputCol=words, outputCol="_pairs"),
        SQLTransformer(statement=f"SELECT *, concat({words}, _pairs) AS _terms FROM __THIS__"),
        CountVectorizer(inputCol="_terms", outputCol="_tf", vocabSize=size, minDF=2.0),
        IDF(inputCol="_tf", outputCol="features"),
    ]


def fold(df: DataFrame, key: str, k: int = 10, seed: int = 0) -> DataFrame:
    """``df`` with ``fold``: a partition of its rows into k parts that depends on the key alone."""
    return df.withColumn("fold", F.pmod(portable_hash(F.col(key), seed), F.lit(k)).cast("int"))


def confusion(train: DataFrame, test: DataFrame, label: str, forest: bool = False, size: int = 4096) -> DataFrame:
    """``label, predicted, n`` of a classifier fitted on ``train`` (columns ``words`` and the label) and applied to ``test``."""
    index = StringIndexer(inputCol=label, outputCol="_y", handleInvalid="skip")
    model = RandomForestClassifier(labelCol="_y", numTrees=30, maxDepth=8, seed=0) if forest else LogisticRegression(labelCol="_y", maxIter=30, regParam=0.01)
    fitted = Pipeline(stages=[*text_features(size=size), index, model]).fit(train)
    names = fitted.stages[-2].labels
    predicted = fitted.transform(test).withColumn("predicted", F.element_at(F.array(*map(F.lit, names)), (F.col("prediction") + 1).cast("int")))
    return predicted.groupBy(F.col(label).alias("label"), "predicted").agg(F.count(F.lit(1)).alias("n"))


def best_two(train: DataFrame, rows: DataFrame, key: str, label: str, *more: str) -> DataFrame:
    """``key, first, second, p_first, p_second`` and the columns ``more``: the two likeliest labels of each row by a random forest; ties go to the more frequent label."""
    index = StringIndexer(inputCol=label, outputCol="_y", handleInvalid="skip")
    fitted = Pipeline(stages=[*text_features(size=1024), index, RandomForestClassifier(labelCol="_y", numTrees=30, maxDepth=8, seed=0)]).fit(train)
    names = F.array(*map(F.lit, fitted.stages[-2].labels))
    unlabelled = rows.withColumn(label, F.lit(fitted.stages[-2].labels[0]))  # the indexer wants a label, the forest doesn't read it
    p = fitted.transform(unlabelled).withColumn("_p", vector_to_array("probability"))
    ranked = p.withColumn("_r", F.slice(F.sort_array(F.transform("_p", lambda x, i: F.struct(x.alias("p"), (-i).alias("i"))), asc=False), 1, 2))
    at = lambda k: F.get(names, -F.col("_r")[k]["i"])
    return ranked.select(key, at(0).alias("first"), at(1).alias("second"), F.col("_r")[0]["p"].alias("p_first"), F.col("_r")[1]["p"].alias("p_second"), *more)


def cross_confusion(rows: DataFrame, key: str, label: str, k: int) -> DataFrame:
    """``label, predicted, n`` over all ``k`` folds: each is judged by a model fitted on the others."""
    folds = fold(rows, key, k)
    parts = [confusion(folds.where(F.col("fold") != i), folds.where(F.col("fold") == i), label) for i in range(k)]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.groupBy("label", "predicted").agg(F.sum("n").alias("n"))


def nested_labels(train: DataFrame, rows: DataFrame, key: str, area: str, label: str, least: int = 20) -> DataFrame:
    """``key, area, p_area, first, second``: the likeliest area by a forest, and within it the two likeliest labels by the forest of that area.

    ``train``: ``words``, area and label. An area with under ``least`` rows or a single label has no forest of its own: its
    commonest label is the first and there is no second. Areas are as many as a list of them holds.
    """
    # each forest reads its rows many times: they are written once
    train, rows = written(train.select("words", area, label).where(F.col(area).isNotNull()), "train"), written(rows.select(key, "words"), "rows")
    areas = best_two(train, rows, key, area).select(key, F.col("first").alias(area), F.col("p_first").alias("p_area"))
    counts = train.groupBy(area, label).agg(F.count(F.lit(1)).alias("n")).groupBy(area).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("k"), F.max_by(label, F.struct("n", label)).alias("top"))
    found = counts.collect()  # one row an area
    placed = written(areas.join(rows, key).select(key, "words", "p_area", area), "placed")
    small = [(r[area], r["top"]) for r in found if r["n"] < least or r["k"] < 2]
    spark = train.sparkSession
    out = placed.join(spark.createDataFrame(small, f"{area} string, first string"), area).select(key, area, "p_area", "first", F.lit(None).cast("string").alias("second"))
    for r in found:
        if r["n"] >= least and r["k"] >= 2:
            here = placed.where(F.col(area) == r[area])
            two = best_two(train.where(F.col(area) == r[area]), here, key, label, "p_area").select(key, F.lit(r[area]).alias(area), "p_area", "first", "second")
            out = out.unionByName(two)
    return out
