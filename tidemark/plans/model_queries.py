"""Queries for projections, scores and models."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from ..functions.vectors import doubles
from ..operators import decompose, models, scores, splitting, volumes
from ..sources.tables import table
from .registry import query, six
from .series_queries import SCORED, scored
from .statistics_queries import NUMBERS, VOXELS, voxels


def _embeddings(spark, folder):
    return table(spark, folder, "embeddings").withColumn("embedding", doubles("embedding"))


def _split(spark, folder):
    split = splitting.train_test_split(_embeddings(spark, folder), ["vec_id"], ["label"], seed=1)
    return split.where("split = 'train'").drop("split"), split.where("split = 'test'").drop("split")


@query("eig_sorted")
def eig_sorted(spark, folder):
    """Eigenvalues of the embedding covariance and their vectors."""
    _, _, cov = decompose.vector_moments(_embeddings(spark, folder), "embedding")
    values, vectors = decompose.eig_sorted(cov)
    rows = [(i + 1, float(v), [float(x) for x in vectors[:, i]]) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "component int, eigenvalue double, vector array<double>")


@query("pca_fit")
def pca_fit(spark, folder):
    fitted = decompose.pca_fit(_embeddings(spark, folder), "embedding", var_threshold=0.95)
    rows = [
        (i + 1, float(fitted.singular_values[i]), float(fitted.variances[i]), float(fitted.singular_share[i]),
         float(fitted.variance_share[i])) for i in range(len(fitted))
    ]
    return spark.createDataFrame(
        rows, "component int, singular_value double, variance double, singular_share double, variance_share double")


# A fixed 64 x 3 matrix, the same rule in SQL.
_MATRIX = np.array([[((i + 1) * (j + 2) % 7 - 3) / 10 for j in range(3)] for i in range(64)])


@query("pca_transform", """SELECT vec_id, """ + ", ".join(
    f"sum(x * ((i + 1) * {j + 2} % 7 - 3) / 10) AS score_{j + 1}" for j in range(3)) + """
  FROM (SELECT vec_id, unnest(embedding)::DOUBLE AS x, unnest(range(0, 64)) AS i FROM embeddings) GROUP BY vec_id""",
       six("score_1", "score_2", "score_3"))
def pca_transform(spark, folder):
    """Projection of the embeddings on a fixed matrix."""
    rows = _embeddings(spark, folder).select("vec_id", "embedding")
    return decompose.with_scores(rows, "embedding", _MATRIX).drop("embedding")


@query("pca_manual")
def pca_manual(spark, folder):
    """Standardised columns projected on the fewest components with 95 % of the variance."""
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", *NUMBERS)
    ready = decompose.standardized(lines, NUMBERS)
    return decompose.pca_to_share(ready, "features", 0.95).scores(ready, "features").drop("features")


@query("pca_loadings")
def pca_loadings(spark, folder):
    ready = decompose.standardized(table(spark, folder, "lineitem").select(*NUMBERS), NUMBERS)
    return decompose.pca_to_share(ready, "features", 0.95).loadings(spark, NUMBERS)


def _reduced(spark, folder, fit):
    """Fitted on the training rows, applied to both parts."""
    train, test = _split(spark, folder)
    ready = decompose.standardized(train, vector="embedding", name="features")
    other = decompose.standardized(test, vector="embedding", train=train, name="features")
    fitted = fit(ready)
    return scores.stacked_scores({
        name: fitted.scores(df, "features").drop("embedding", "features")
        for name, df in (("train", ready), ("test", other))
    })


@query("pca_90")
def pca_90(spark, folder):
    return _reduced(spark, folder, lambda df: decompose.pca_to_share(df, "features", 0.9))


@query("factor_analysis")
def factor_analysis(spark, folder):
    return _reduced(spark, folder, lambda df: decompose.factor_fit(df, "features"))


@query("lda_projection")
def lda_projection(spark, folder):
    return _reduced(spark, folder, lambda df: decompose.lda_fit(df, "features", "label"))


@query("lda_variances")
def lda_variances(spark, folder):
    """Variance of each discriminant over the training rows."""
    train, _ = _split(spark, folder)
    ready = decompose.standardized(train, vector="embedding", name="features")
    projected = decompose.lda_fit(ready, "features", "label").scores(ready, "features")
    names = [c for c in projected.columns if c.startswith("score_")]
    return projected.agg(*[F.var_samp(c).alias(c) for c in names])


@query("regression_scores", """WITH s AS (SELECT l_returnflag, l_extendedprice AS y, l_quantity * 2100 AS p FROM lineitem),
  m AS (SELECT *, avg(y) OVER (PARTITION BY l_returnflag) AS g FROM s)
  SELECT l_returnflag, avg(pow(y - p, 2)) AS mse, sqrt(avg(pow(y - p, 2))) AS rmse,
    sqrt(avg(pow(ln(1 + y) - ln(1 + p), 2))) AS rmsle,
    1 - (sum(pow(y - p, 2)) / sum(pow(y - g, 2))) * (count(*) - 1) / (count(*) - 3 - 1) AS adj_r2
  FROM m GROUP BY l_returnflag""", {"mse": 1, "rmse": 6, "rmsle": 6, "adj_r2": 6})
def regression_scores(spark, folder):
    lines = table(spark, folder, "lineitem").select(
        "l_returnflag", F.col("l_extendedprice").alias("y"), (F.col("l_quantity") * 2100).alias("p"))
    return scores.regression_scores(lines, "y", "p", 3, ["l_returnflag"])


_COUNTS = f"""(SELECT count(*) FILTER (y = 1 AND p >= 0.5) * 1.0 AS tp, count(*) FILTER (y = 0 AND p >= 0.5) * 1.0 AS fp,
  count(*) FILTER (y = 1 AND p < 0.5) * 1.0 AS fn, count(*) FILTER (y = 0 AND p < 0.5) * 1.0 AS tn FROM {SCORED})"""
_SCORES_SQL = f"""SELECT (tp + tn) / (tp + fp + fn + tn) AS accuracy, coalesce(tp / nullif(tp + fp, 0), 0) AS precision,
  coalesce(tp / nullif(tp + fn, 0), 0) AS recall, coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1,
  (tp / nullif(tp + fn, 0) + tn / nullif(tn + fp, 0)) / 2 AS roc_auc FROM {_COUNTS}"""
_SCORE_DIGITS = six("accuracy", "precision", "recall", "f1", "roc_auc")


@query("classification_scores", _SCORES_SQL, _SCORE_DIGITS)
def classification_scores(spark, folder):
    return scores.classification_scores(scores.with_threshold(scored(spark, folder), "p"), "y", "prediction")


@query("threshold_labels", f"SELECT doc_id, CAST(p >= 0.5 AS INTEGER) AS prediction FROM {SCORED}")
def threshold_labels(spark, folder):
    return scores.with_threshold(scored(spark, folder), "p").select("doc_id", "prediction")


@query("classification_report", f"""WITH s AS ({_SCORES_SQL}),
  g AS (SELECT p, count(*) FILTER (y = 1) AS a, count(*) FILTER (y <> 1) AS b FROM {SCORED} GROUP BY p),
  c AS (SELECT p, sum(b) OVER w / sum(b) OVER () AS fpr, sum(a) OVER w / sum(a) OVER () AS tpr FROM g
    WINDOW w AS (ORDER BY p DESC))
  SELECT 'row' AS part, CAST(doc_id AS VARCHAR) AS name, p AS x, CAST(p >= 0.5 AS INTEGER)::DOUBLE AS y FROM {SCORED}
  UNION ALL SELECT 'score', name, value, NULL FROM (UNPIVOT s ON accuracy, precision, recall, f1, roc_auc)
  UNION ALL SELECT 'roc', CAST(NULL AS VARCHAR), fpr, tpr FROM c
  UNION ALL SELECT 'roc', NULL, 0, 0""", six("x", "y"))
def classification_report(spark, folder):
    """Hard labels, scores and ROC points in one long table."""
    rows, table_of_scores, curve = models.classification_report(scored(spark, folder), "y", "p")
    parts = [
        rows.select(F.lit("row").alias("part"), F.col("doc_id").cast("string").alias("name"),
                    F.col("p").alias("x"), F.col("prediction").cast("double").alias("y")),
        table_of_scores.unpivot([], list(scores.CLASSIFICATION), "name", "x").select(
            F.lit("score").alias("part"), "name", "x", F.lit(None).cast("double").alias("y")),
        curve.select(F.lit("roc").alias("part"), F.lit(None).cast("string").alias("name"),
                     F.col("fpr").alias("x"), F.col("tpr").alias("y")),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("dice", f"""SELECT subject, modality, 2.0 * sum(label * predicted) / nullif(sum(label) + sum(predicted), 0) AS dice
  FROM {VOXELS} GROUP BY 1, 2""", six("dice"))
def dice(spark, folder):
    return volumes.dice(voxels(spark, folder), "label", "predicted", ["subject", "modality"])


_UNION_SQL = """SELECT '{0}' AS split, avg(CAST((o_totalprice > 150000) = (o_orderstatus = 'F') AS DOUBLE)) AS accuracy,
  {1} AS rows FROM orders WHERE o_orderpriority = '{2}'"""


@query("union_score_rows", " UNION ALL ".join(
    _UNION_SQL.format(*x) for x in (("Train", "count(*)", "1-URGENT"), ("Validation", "NULL", "2-HIGH"),
                                    ("Test", "count(*)", "3-MEDIUM"))), six("accuracy"))
def union_score_rows(spark, folder):
    """Score rows of three splits; one of them lacks a score."""
    orders = table(spark, folder, "orders").select(
        "o_orderpriority", (F.col("o_orderstatus") == "F").cast("int").alias("y"),
        (F.col("o_totalprice") > 150000).cast("int").alias("p"))
    counted = {**{"accuracy": scores.accuracy}, "rows": lambda y, p: F.count(F.lit(1))}
    part = {n: orders.where(F.col("o_orderpriority") == v) for n, v in (
        ("Train", "1-URGENT"), ("Validation", "2-HIGH"), ("Test", "3-MEDIUM"))}
    return scores.stacked_scores({
        n: scores.classification_scores(df, "y", "p", scores={"accuracy": scores.accuracy} if n == "Validation" else counted)
        for n, df in part.items()
    })


@query("l_norm_penalty", """SELECT CAST(i AS INTEGER) AS dimension, 0.001 * sum(abs(x)) AS l1, 0.01 * sqrt(sum(x * x)) AS l2
  FROM (SELECT unnest(embedding)::DOUBLE AS x, unnest(range(0, 64)) AS i FROM embeddings) GROUP BY 1""", six("l1", "l2"))
def l_norm_penalty(spark, folder):
    """L1 and L2 penalty of each embedding dimension taken as a coefficient vector."""
    cells = _embeddings(spark, folder).select(F.posexplode("embedding").alias("dimension", "x"))
    one = scores.l_norm_penalty(cells, "x", 0.001, 1.0, ["dimension"]).withColumnRenamed("penalty", "l1")
    two = scores.l_norm_penalty(cells, "x", 0.01, 2.0, ["dimension"]).withColumnRenamed("penalty", "l2")
    return one.join(two, "dimension")


def _binary(spark, folder):
    """Embeddings with a two-class target: even classes against odd ones."""
    rows = _embeddings(spark, folder).withColumn("target", F.col("label") % 2)
    split = splitting.train_test_split(rows, ["vec_id"], ["label"], seed=2)
    return split.where("split = 'train'").drop("split"), split.where("split = 'test'").drop("split")


@query("linear_classifier")
def linear_classifier(spark, folder):
    """Scores per split of a regularised logistic regression."""
    train, test = _binary(spark, folder)
    model = models.linear_classifier(train, "embedding", "target", weight=0.01, l1_share=0.5)
    return models.evaluate(model, {"Train": train, "Test": test}, "embedding", "target")


@query("loss_history")
def loss_history(spark, folder):
    train, _ = _binary(spark, folder)
    return models.loss_history(models.linear_classifier(train, "embedding", "target"), train)


@query("mlp_classifier")
def mlp_classifier(spark, folder):
    """Scores per split of a small feed-forward network."""
    train, test = _binary(spark, folder)
    model = models.mlp_classifier(train, "embedding", "target", hidden=(12,), max_iter=40)
    return models.evaluate(model, {"Train": train, "Test": test}, "embedding", "target")


@query("batch_predict")
def batch_predict(spark, folder):
    """Target, probability and prediction of every row."""
    train, test = _binary(spark, folder)
    model = models.linear_classifier(train, "embedding", "target")
    rows = train.unionByName(test)
    return models.batch_predict(model, rows, "embedding", "target").drop("embedding")
