"""Fits checked by what must hold for them, in numbers that SQL computes from the same tables."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from ..functions import vectors as v
from ..operators import cluster, decompose, models, scaling, splitting
from ..sources.tables import table
from .model_queries import _binary, _embeddings, _split
from .registry import query, six
from .statistics_queries import NUMBERS

_CELLS = """cells AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS x, unnest(range(0, 64)) AS i FROM embeddings)"""


def _matrix_rows(spark, matrix, name="value"):
    rows = [(i, j, float(x)) for (i, j), x in np.ndenumerate(matrix)]
    return spark.createDataFrame(rows, f"i int, j int, {name} double")


@query("eig_rebuilt", f"""WITH {_CELLS} SELECT CAST(a.i AS INTEGER) AS i, CAST(b.i AS INTEGER) AS j, covar_samp(a.x, b.x) AS value
  FROM cells a JOIN cells b USING (vec_id) GROUP BY 1, 2""", six("value"))
def eig_rebuilt(spark, folder):
    """The covariance, rebuilt from its eigenvalues and vectors."""
    _, _, cov = decompose.vector_moments(_embeddings(spark, folder), "embedding")
    values, vectors = decompose.eig_sorted(cov)
    return _matrix_rows(spark, (vectors * values) @ vectors.T)


@query("pca_fit_total", f"""WITH {_CELLS}, m AS (SELECT sum(s) AS total, (SELECT count(*) FROM embeddings) AS n
    FROM (SELECT var_samp(x) AS s FROM cells GROUP BY i))
  SELECT total, total * (n - 1) AS squares, 1.0 AS last_share, true AS orthonormal, true AS falling FROM m""",
       six("total", "squares", "last_share"))
def pca_fit_total(spark, folder):
    """All components together hold all variance; they are orthonormal and ordered."""
    fitted = decompose.pca_fit(_embeddings(spark, folder), "embedding")
    unit = np.allclose(fitted.components @ fitted.components.T, np.eye(len(fitted)), atol=1e-9)
    return spark.createDataFrame(
        [(float(fitted.variances.sum()), float((fitted.singular_values ** 2).sum()), float(fitted.variance_share[-1]), bool(unit),
          bool((np.diff(fitted.variances) <= 1e-12).all()))],
        "total double, squares double, last_share double, orthonormal boolean, falling boolean")


def _score_covariance(spark, scored):
    names = [c for c in scored.columns if c.startswith("score_")]
    return decompose.covariance_table(scored, names)


@query("pca_manual_uncorrelated", f"""SELECT count(*) AS n, 0.0 AS widest_covariance, {len(NUMBERS)} * count(*) / (count(*) - 1.0) AS total,
  true AS enough, true AS no_more_than_needed FROM lineitem""", six("widest_covariance", "total"))
def pca_manual_uncorrelated(spark, folder):
    """Scores are uncorrelated, and the fewest that hold 95 % of the variance of standardised columns."""
    ready = decompose.standardized(table(spark, folder, "lineitem").select(*NUMBERS), NUMBERS)
    fitted = decompose.pca_to_share(ready, "features", 0.95)
    scored = fitted.scores(ready, "features")
    cells = _score_covariance(spark, scored)
    total, own = float(fitted.variances.sum()), fitted.matrix.shape[1]
    kept = F.sum(F.when(F.col("row_name") == F.col("column_name"), F.col("covariance")))
    last = F.min(F.when(F.col("row_name") == F.col("column_name"), F.col("covariance")))
    n = ready.select(F.count(F.lit(1))).scalar()
    return cells.agg(
        F.max(F.when(F.col("row_name") != F.col("column_name"), F.abs("covariance"))).alias("widest_covariance"),
        F.lit(total).alias("total"), (kept >= 0.95 * total - 1e-9).alias("enough"),
        ((kept - last < 0.95 * total) | F.lit(own == 1)).alias("no_more_than_needed"),
    ).select(n.alias("n"), F.coalesce("widest_covariance", F.lit(0.0)).alias("widest_covariance"), "total", "enough", "no_more_than_needed")


@query("pca_90_uncorrelated", "SELECT 0.0 AS widest_covariance, true AS enough, true AS no_more_than_needed", six("widest_covariance"))
def pca_90_uncorrelated(spark, folder):
    """As pca_manual_uncorrelated for the training vectors and 90 %."""
    train, _ = _split(spark, folder)
    ready = decompose.standardized(train, vector="embedding", name="features")
    fitted = decompose.pca_to_share(ready, "features", 0.9)
    _, _, cov = decompose.vector_moments(decompose.as_vector_column(
        fitted.scores(ready, "features"), [f"score_{k + 1}" for k in range(fitted.matrix.shape[1])], "s"), "s")
    kept, total = np.trace(cov), fitted.variances.sum()
    widest = np.abs(cov - np.diag(np.diag(cov))).max()
    return spark.createDataFrame(
        [(float(widest), bool(kept >= 0.9 * total - 1e-9), bool(kept - np.diag(cov).min() < 0.9 * total))],
        "widest_covariance double, enough boolean, no_more_than_needed boolean")


@query("lda_within_unit", """WITH k AS (SELECT count(DISTINCT label) - 1 AS k FROM embeddings)
  SELECT CAST(a.i AS INTEGER) AS i, CAST(b.i AS INTEGER) AS j, CAST(a.i = b.i AS INTEGER)::DOUBLE AS value
  FROM (SELECT unnest(range(0, k)) AS i FROM k) a, (SELECT unnest(range(0, k)) AS i FROM k) b""", six("value"))
def lda_within_unit(spark, folder):
    """The pooled covariance of the discriminants within classes is the identity."""
    train, _ = _split(spark, folder)
    ready = decompose.standardized(train, vector="embedding", name="features")
    fitted = decompose.lda_fit(ready, "features", "label")
    names = [f"score_{k + 1}" for k in range(fitted.matrix.shape[1])]
    scored = decompose.as_vector_column(fitted.scores(ready, "features"), names, "s")
    means = cluster.update_centres(scored, "s", "label").select(F.col("label").alias("l"), "centre", "n")
    inside = scored.join(F.broadcast(means), F.col("label") == F.col("l")).withColumn("s", F.zip_with("s", "centre", lambda x, c: x - c))
    n, _, cov = decompose.vector_moments(inside, "s")
    return _matrix_rows(spark, cov * (n - 1) / (n - means.count()))


@query("factor_communality", "SELECT CAST(unnest(range(0, 64)) AS INTEGER) AS i, 1.0 AS value", {"value": 3})
def factor_communality(spark, folder):
    """Communality and noise of each standardised column add up to its variance."""
    train, _ = _split(spark, folder)
    ready = decompose.standardized(train, vector="embedding", name="features")
    fitted = decompose.factor_fit(ready, "features")
    whole = (fitted.loadings_matrix ** 2).sum(axis=1) + fitted.noise
    return spark.createDataFrame([(i, float(x)) for i, x in enumerate(whole)], "i int, value double")


@query("kmeans_fit_fixed", """SELECT d AS distance, (SELECT count(*) FROM embeddings) AS n, 0::BIGINT AS not_nearest, 0.0 AS off_mean
  FROM (VALUES ('euclidean'), ('manhattan'), ('cosine_similarity')) t(d)""", six("off_mean"))
def kmeans_fit_fixed(spark, folder):
    """After a fit every row's centre is the nearest, and every centre the mean of its rows."""
    parts = []
    for distance in ("euclidean", "manhattan", "cosine_similarity"):
        rows = _embeddings(spark, folder)
        centres = cluster.kmeans_fit(rows, "embedding", 10, distance=distance, seed=3)
        labelled = cluster.assign_clusters(rows, "embedding", centres, distance)
        means = cluster.update_centres(labelled, "embedding", "cluster").collect()
        off = max(abs(x - y) for r in means for x, y in zip(r["centre"], centres[r["cluster"]]))
        build = v.distance_builder("cosine_dissimilarity" if distance.startswith("cosine") else distance)
        away = [build("embedding", F.lit(list(map(float, c)))) for c in centres]
        mine = F.get(F.array(*away), F.col("cluster"))
        parts.append(labelled.agg(
            F.lit(distance).alias("distance"), F.count(F.lit(1)).alias("n"),
            F.count(F.when(mine > F.array_min(F.array(*away)) + 1e-9, 1)).alias("not_nearest"), F.lit(float(off)).alias("off_mean")))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("elbow_one_cluster", f"""WITH {_CELLS}, m AS (SELECT i, avg(x) AS c FROM cells GROUP BY i)
  SELECT 1 AS n_clusters, 'euclidean' AS distance, sum(pow(x - c, 2)) AS inertia, 0.0 AS silhouette FROM cells JOIN m USING (i)""",
       six("inertia", "silhouette"))
def elbow_one_cluster(spark, folder):
    """With one cluster the inertia is the total spread."""
    return cluster.elbow_test(_embeddings(spark, folder), "embedding", ks=(1,), scores=("inertia", "silhouette"), seed=5)


@query("batch_predict_recomputed", "SELECT vec_id, true AS same_probability, true AS same_label FROM embeddings")
def batch_predict_recomputed(spark, folder):
    """Probabilities equal the logistic function of the coefficients, labels their threshold."""
    train, test = _binary(spark, folder)
    model = models.linear_classifier(train, "embedding", "target")
    scored = models.batch_predict(model, train.unionByName(test), "embedding", "target")
    score = v.dot("embedding", F.lit([float(x) for x in model.coefficients])) + F.lit(float(model.intercept))
    again = 1 / (1 + F.exp(-score))
    return scored.select(
        "vec_id", (F.abs(again - F.col("probability_1")) < 1e-9).alias("same_probability"),
        ((F.col("probability_1") >= 0.5).cast("int") == F.col("prediction")).alias("same_label"))


@query("loss_history_recomputed", "SELECT true AS falling, true AS last_is_the_loss, ln(2) - ln(2) AS first_gap", six("first_gap"))
def loss_history_recomputed(spark, folder):
    """Losses never rise, the first is that of the class shares and the last that of the fitted model."""
    train, _ = _binary(spark, folder)
    weight = 0.001
    model = models.linear_classifier(train, "embedding", "target", weight=weight)
    loss = [r["loss"] for r in models.loss_history(model, train).orderBy("epoch").collect()]
    share = train.agg(F.avg(F.col("target").cast("double"))).first()[0]
    score = v.dot("embedding", F.lit([float(x) for x in model.coefficients])) + F.lit(float(model.intercept))
    mean = train.agg(F.avg(F.log1p(F.exp(F.when(F.col("target") == 1, -score).otherwise(score))))).first()[0]
    spread = [r[0] ** 0.5 for r in train.select(F.posexplode("embedding")).groupBy("pos").agg(F.var_samp("col"), F.first("pos")).orderBy("pos").select("var_samp(col)").collect()]
    penalty = weight / 2 * sum((c * s) ** 2 for c, s in zip(model.coefficients, spread))
    first = -(share * np.log(share) + (1 - share) * np.log(1 - share))
    return spark.createDataFrame(
        [(all(b <= a + 1e-12 for a, b in zip(loss, loss[1:])), bool(abs(loss[-1] - mean - penalty) < 1e-6), float(loss[0] - first))],
        "falling boolean, last_is_the_loss boolean, first_gap double")


@query("sample_per_label_sizes", """SELECT quality, least(count(*), 4) AS n, true AS of_label FROM documents JOIN labels USING (doc_id) GROUP BY quality""")
def sample_per_label_sizes(spark, folder):
    """Every label gives the asked number of rows, all of its own."""
    labels = table(spark, folder, "labels")
    labelled = table(spark, folder, "documents").select("doc_id", "text").join(labels, "doc_id")
    drawn = splitting.sample_per_label(labelled, "quality", ["doc_id"], 4, seed=11)
    back = drawn.select("doc_id", F.col("quality").alias("drawn")).join(labels, "doc_id")
    return back.groupBy("quality").agg(
        F.count_distinct("doc_id").alias("n"), F.bool_and(F.col("drawn") == F.col("quality")).alias("of_label"))


@query("quantile_place", """WITH g AS (SELECT quantile_cont(value, list_transform(range(0, 1000), lambda k: k / 999.0)) AS g FROM events),
  r AS (SELECT event_id, value, g, CAST(list_sum(list_transform(g, lambda x: CAST(x < value AS INTEGER))) AS BIGINT) AS below,
    CAST(list_sum(list_transform(g, lambda x: CAST(x <= value AS INTEGER))) AS BIGINT) AS upto FROM events, g WHERE value IS NOT NULL)
  SELECT event_id, CASE WHEN upto > below THEN (below + upto - 1) / 2.0 / 999
    ELSE (below - 1 + (value - g[below]) / (g[below + 1] - g[below])) / 999 END AS place FROM r
  UNION ALL SELECT event_id, NULL FROM events WHERE value IS NULL""", {"place": 5})
def quantile_place(spark, folder):
    """Places in the grid of exact quantiles, from which normal scores are read."""
    events = table(spark, folder, "events").select("event_id", "value")
    return scaling.grid_place(events, "value", "place").drop("value")


_HOLES = """h AS (SELECT vec_id, label, CASE vec_id % 5 WHEN 1 THEN NULL WHEN 2 THEN list_concat([NULL], embedding[2:]) ELSE embedding END::DOUBLE[] AS v
    FROM embeddings), w AS (SELECT * FROM h WHERE vec_id % 5 NOT IN (1, 2)),
  cells AS (SELECT vec_id, label, unnest(v) AS x, unnest(range(0, 64)) AS i FROM w), means AS (SELECT label, i, avg(x) AS c FROM cells GROUP BY 1, 2)"""


def _with_holes(spark, folder):
    """The vectors, of which a fifth is NULL and a fifth has a NULL element."""
    part, own = F.pmod("vec_id", F.lit(5)), F.col("embedding")
    torn = F.concat(F.array(F.lit(None).cast("double")), F.slice(own, 2, 64))
    return _embeddings(spark, folder).withColumn("embedding", F.when(part == 2, torn).when(part != 1, own))


@query("kmeans_assign_nulls", f"""WITH {_HOLES}, d AS (SELECT vec_id, m.label AS reference, sqrt(sum(pow(x - c, 2))) AS d
    FROM cells JOIN means m USING (i) GROUP BY 1, 2)
  SELECT h.vec_id, CAST(arg_min(reference, (d, reference)) AS INTEGER) AS cluster, min(d) AS distance
  FROM h LEFT JOIN d USING (vec_id) GROUP BY h.vec_id""", six("distance"))
def kmeans_assign_nulls(spark, folder):
    """Incomplete vectors have no cluster, and centres come from the others."""
    rows = _with_holes(spark, folder)
    _, centres = cluster.centre_list(rows, "embedding", "label")
    near = cluster.nearest_centre("embedding", centres)
    return rows.withColumn("near", near).select("vec_id", F.col("near.label").alias("cluster"), F.col("near.distance").alias("distance"))


@query("kmeans_fit_nulls", f"""WITH {_HOLES}, m AS (SELECT i, avg(x) AS c FROM cells GROUP BY i)
  SELECT CAST(i AS INTEGER) AS dimension, c AS mean FROM m""", six("mean"))
def kmeans_fit_nulls(spark, folder):
    """One cluster's centre is the mean of the complete vectors, with every distance."""
    rows = _with_holes(spark, folder)
    found = [cluster.kmeans_fit(rows, "embedding", 1, distance=d, seed=1)[0] for d in ("euclidean", "manhattan", "cosine_similarity")]
    same = np.mean(found, axis=0) if np.ptp(found, axis=0).max() < 1e-9 else np.full(64, np.nan)
    return spark.createDataFrame([(i, float(x)) for i, x in enumerate(same)], "dimension int, mean double")


@query("pca_fit_nulls", f"""WITH {_HOLES} SELECT CAST(a.i AS INTEGER) AS i, CAST(b.i AS INTEGER) AS j, covar_samp(a.x, b.x) AS value
  FROM cells a JOIN cells b USING (vec_id) GROUP BY 1, 2""", six("value"))
def pca_fit_nulls(spark, folder):
    """The covariance of the complete vectors, rebuilt from all components of a fit."""
    fitted = decompose.pca_fit(_with_holes(spark, folder), "embedding")
    return _matrix_rows(spark, (fitted.components.T * fitted.variances) @ fitted.components)


@query("pca_transform_nulls", f"""WITH {_HOLES} SELECT h.vec_id, sum(x * ((i + 1) * 2 % 7 - 3)) AS score_1, sum(x * ((i + 1) * 3 % 7 - 3)) AS score_2
  FROM h LEFT JOIN cells USING (vec_id) GROUP BY h.vec_id""", six("score_1", "score_2"))
def pca_transform_nulls(spark, folder):
    """Incomplete vectors have no scores."""
    rows = _with_holes(spark, folder).select("vec_id", "embedding")
    matrix = np.array([[float((i + 1) * (j + 2) % 7 - 3) for i in range(64)] for j in range(2)])
    ones = np.ones(2)
    fitted = decompose.Components(matrix, ones, ones, ones, ones, np.zeros(64))
    return decompose.pca_transform(rows, "embedding", fitted).drop("embedding")
