"""Queries over vectors and clusters."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import vectors as v
from ..operators import cluster
from ..sources.tables import table
from .registry import query, six


def _embeddings(spark, folder):
    return table(spark, folder, "embeddings").withColumn("embedding", v.doubles("embedding"))


_CELLS = """cells AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS x, unnest(range(0, 64)) AS i FROM embeddings),
  means AS (SELECT label, i, avg(x) AS c FROM cells GROUP BY 1, 2)"""

_BETWEEN = """(SELECT a.vec_id, m.label AS reference, sqrt(sum(pow(x - c, 2))) AS euclidean,
  sum(abs(x - c)) AS manhattan, sum(x * c) / (sqrt(sum(x * x)) * sqrt(sum(c * c))) AS similarity,
  any_value(a.label) AS label FROM cells a JOIN means m USING (i) GROUP BY 1, 2)"""


@query("vector_distances", f"""WITH {_CELLS} SELECT vec_id, euclidean, manhattan, similarity,
  1 - similarity AS dissimilarity FROM {_BETWEEN} WHERE label = reference""",
       six("euclidean", "manhattan", "similarity", "dissimilarity"))
def vector_distances(spark, folder):
    """Each vector against the mean of its own class, with every distance."""
    rows = _embeddings(spark, folder)
    means = cluster.update_centres(rows, "embedding", "label").select("label", "centre")
    return rows.join(means, "label").select(
        "vec_id", v.euclidean("embedding", "centre").alias("euclidean"),
        v.manhattan("embedding", "centre").alias("manhattan"),
        v.cosine_similarity("embedding", "centre").alias("similarity"),
        v.cosine_dissimilarity("embedding", "centre").alias("dissimilarity"))


@query("pairwise_distance", f"WITH {_CELLS} SELECT vec_id, CAST(reference AS INTEGER) AS reference, manhattan AS distance FROM {_BETWEEN}",
       six("distance"))
def pairwise_distance(spark, folder):
    """Every vector against every class mean."""
    rows = _embeddings(spark, folder)
    _, centres = cluster.centre_list(rows, "embedding", "label")
    return cluster.distances_to(rows, "embedding", centres, ["vec_id"], "manhattan")


@query("kmeans_assign", f"""WITH {_CELLS} SELECT vec_id, CAST(arg_min(reference, (euclidean, reference)) AS INTEGER) AS euclidean,
  CAST(arg_min(reference, (manhattan, reference)) AS INTEGER) AS manhattan,
  CAST(arg_min(reference, (-similarity, reference)) AS INTEGER) AS cosine FROM {_BETWEEN} GROUP BY vec_id""")
def kmeans_assign(spark, folder):
    """Nearest class mean of every vector under each distance."""
    rows = _embeddings(spark, folder)
    _, centres = cluster.centre_list(rows, "embedding", "label")
    for name, distance in (("euclidean", "euclidean"), ("manhattan", "manhattan"), ("cosine", "cosine_similarity")):
        rows = cluster.assign_clusters(rows, "embedding", centres, distance, name)
    return rows.select("vec_id", "euclidean", "manhattan", "cosine")


@query("kmeans_update", f"WITH {_CELLS} SELECT label, CAST(i AS INTEGER) AS dimension, c AS mean FROM means", six("mean"))
def kmeans_update(spark, folder):
    centres = cluster.update_centres(_embeddings(spark, folder), "embedding", "label")
    return centres.select("label", F.posexplode("centre").alias("dimension", "mean"))


@query("kmeans_fit")
def kmeans_fit(spark, folder):
    """Cluster of every vector after a fit with each distance."""
    rows = _embeddings(spark, folder)
    for name, distance in (("euclidean", "euclidean"), ("manhattan", "manhattan"), ("cosine", "cosine_similarity")):
        centres = cluster.kmeans_fit(rows, "embedding", 10, distance=distance, seed=3)
        rows = cluster.assign_clusters(rows, "embedding", centres, distance, name)
    return rows.select("vec_id", "euclidean", "manhattan", "cosine")


_WCSS = f"(SELECT sum(pow(x - c, 2)) FROM cells JOIN means USING (label, i))"


@query("wcss", f"WITH {_CELLS} SELECT {_WCSS} AS score", six("score"))
def wcss(spark, folder):
    return cluster.wcss(_embeddings(spark, folder), "embedding", "label")


_DISTANCE_SQL = {
    "euclidean": "list_distance(a.v, b.v)",
    "manhattan": "list_sum(list_transform(list_zip(a.v, b.v), lambda p: abs(p[1] - p[2])))",
    "cosine_dissimilarity": "list_cosine_distance(a.v, b.v)",
}


def _pairs_sql(distance: str) -> str:
    return f"""e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
  d AS (SELECT a.vec_id AS i, a.label AS li, b.vec_id AS j, b.label AS lj, {_DISTANCE_SQL[distance]} AS d
    FROM e a JOIN e b ON a.vec_id <> b.vec_id)"""


_SILHOUETTE = """(SELECT avg(CASE WHEN a = 0 AND b = 0 THEN 0 WHEN b = 0 THEN -1 WHEN a = 0 THEN 1
    ELSE (b - a) / greatest(a, b) END) FROM (SELECT i, max(m) FILTER (lj = li) AS a, min(m) FILTER (lj <> li) AS b
    FROM (SELECT i, li, lj, avg(d) AS m FROM d GROUP BY 1, 2, 3) GROUP BY i) WHERE a IS NOT NULL AND b IS NOT NULL)"""
_DUNN = "(SELECT min(d) FILTER (li <> lj) / max(d) FILTER (li = lj) FROM d)"


@query("silhouette", f"WITH {_pairs_sql('euclidean')} SELECT {_SILHOUETTE} AS score", six("score"))
def silhouette(spark, folder):
    return cluster.silhouette(_embeddings(spark, folder), "embedding", "label")


@query("silhouette_estimate", f"""WITH {_pairs_sql('euclidean')}, s AS (SELECT label, count(*) AS size FROM embeddings GROUP BY 1),
  m AS (SELECT size, least(size, CAST(ceil(200.0 * size / sum(size) OVER ()) AS BIGINT)) AS m,
    CAST(size AS DOUBLE) / sum(size) OVER () AS w FROM s WHERE size > 1)
  SELECT {_SILHOUETTE} AS exact, true AS within, sum(size)::BIGINT AS n_rows, sum(m)::BIGINT AS n_sampled,
    sqrt(2 * ln(2 / 0.001) * sum(w * w / m * CASE WHEN m = size THEN 0 ELSE 1 - (m - 1) / CAST(size AS DOUBLE) END)) AS bound FROM m""",
       six("exact", "bound"))
def silhouette_estimate(spark, folder):
    """The estimate from some 200 rows with its bound, and whether the exact score lies within."""
    rows = _embeddings(spark, folder)
    found = cluster.silhouette_estimate(rows, "embedding", "label", ["vec_id"], sample_rows=200, seed=3)
    exact = cluster.silhouette(rows, "embedding", "label").select("score").scalar()
    return found.withColumn("exact", exact).select(
        "exact", (F.abs(F.col("score") - F.col("exact")) <= F.col("bound")).alias("within"), "n_rows", "n_sampled", "bound")


@query("silhouette_cosine", f"WITH {_pairs_sql('cosine_dissimilarity')} SELECT {_SILHOUETTE} AS score", six("score"))
def silhouette_cosine(spark, folder):
    return cluster.silhouette(_embeddings(spark, folder), "embedding", "label", "cosine_dissimilarity")


@query("silhouette_manhattan", f"WITH {_pairs_sql('manhattan')} SELECT {_SILHOUETTE} AS score", six("score"))
def silhouette_manhattan(spark, folder):
    return cluster.silhouette(_embeddings(spark, folder), "embedding", "label", "manhattan")


@query("dunn", f"WITH {_pairs_sql('euclidean')} SELECT {_DUNN} AS score", six("score"))
def dunn(spark, folder):
    return cluster.dunn(_embeddings(spark, folder), "embedding", "label")


_ORDER_GROUPS = """g AS (SELECT DISTINCT CAST(floor(o_totalprice / 60000) AS INTEGER) * 100 + o_custkey % 2 AS label,
    [CAST(o_totalprice AS DOUBLE) / 1000 + 100 * floor(o_totalprice / 60000), 40.0 * (o_custkey % 2) + (o_orderkey % 97) / 10.0] AS v FROM orders)"""


@query("dunn_separated", f"""WITH {_ORDER_GROUPS}, d AS (SELECT a.label = b.label AS same, list_distance(a.v, b.v) AS d
    FROM g a JOIN g b ON a.v <> b.v OR a.label <> b.label)
  SELECT min(d) FILTER (NOT same) / max(d) FILTER (same) AS score, min(d) FILTER (NOT same) AS closest,
    max(d) FILTER (same) AS widest, (SELECT count(*) * (count(*) - 1) // 2 FROM g) AS pairs, true AS few_compared FROM d""",
       six("score", "closest", "widest"))
def dunn_separated(spark, folder):
    """Groups of orders that lie apart: exact extremes from a small part of all pairs."""
    price, odd = F.col("o_totalprice"), F.col("o_custkey") % 2
    step = F.floor(price / 60000)
    rows = table(spark, folder, "orders").select(
        (step * 100 + odd).cast("int").alias("label"),
        F.array(price / 1000 + 100 * step, 40.0 * odd + (F.col("o_orderkey") % 97) / 10.0).alias("v"))
    found = cluster.dunn_details(rows, "v", "label")
    return found.select("score", "closest", "widest", "pairs", (F.col("compared") < F.col("pairs") * 0.5).alias("few_compared"))


@query("cluster_scores", f"""WITH {_CELLS}, {_pairs_sql('cosine_dissimilarity')}
  SELECT {_WCSS} AS inertia, {_SILHOUETTE} AS silhouette, {_DUNN} AS dunn""", six("inertia", "silhouette", "dunn"))
def cluster_scores(spark, folder):
    return cluster.cluster_scores(_embeddings(spark, folder), "embedding", "label", "cosine_dissimilarity")


@query("elbow_test")
def elbow_test(spark, folder):
    return cluster.elbow_test(
        _embeddings(spark, folder), "embedding", ks=(2, 4), distances=("euclidean", "cosine_similarity"),
        scores=("inertia", "silhouette"), seed=5)
