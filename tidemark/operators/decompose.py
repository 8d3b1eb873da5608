"""Covariance based projections.

Each fit makes one or two distributed passes over the rows; only p x p numbers
come to the driver. Projections are matrix products on Arrow batches.
"""

from __future__ import annotations

import warnings
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Correlation, Summarizer
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import finite
from ..functions.vectors import complete, doubles, whole
from ..session import stored

# Partial sums that one task adds up.
FAN_IN = 64
# Rows that one matrix product takes.
PRODUCT_ROWS = 4_096


def as_vector_column(df: DataFrame, columns: Sequence[str], name: str = "features") -> DataFrame:
    """Pack numeric columns into one array column."""
    return df.withColumn(name, F.array(*[finite(c) for c in columns]))


def covariance_table(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Sample covariance of every pair of columns: row_name, column_name, covariance.

    A pair is taken over the rows that have both values. One scan, whatever the width: every task adds
    up products of blocks of rows, of values and of marks for present values, and the tasks' sums,
    one row for each column, meet in groups of FAN_IN. Values are shifted by the means of the first
    rows, which changes nothing but the rounding.
    """
    names, p = list(columns), len(columns)
    rows = df.select(*[finite(c).alias(f"c{k}") for k, c in enumerate(names)])
    first = rows.limit(PRODUCT_ROWS).agg(*[F.avg(f"c{k}").alias(f"c{k}") for k in range(p)]).first()
    shift = np.array([x if x is not None and np.isfinite(x) else 0.0 for x in first])
    doubles_list = pa.list_(pa.float64())
    parts = ("n", "x", "y", "xy")
    schema = pa.schema([("task", pa.int64()), ("i", pa.int32()), *[(c, doubles_list) for c in parts]])
    ddl = "task bigint, i int, " + ", ".join(f"{c} array<double>" for c in parts)

    def products(batches):
        total = np.zeros((4, p, p))
        for batch in batches:
            for at in range(0, batch.num_rows, PRODUCT_ROWS):
                some = batch.slice(at, PRODUCT_ROWS)
                x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in some.columns]) - shift
                there = ~np.isnan(x)
                x, there = np.where(there, x, 0.0), there.astype(np.float64)
                total += there.T @ there, x.T @ there, there.T @ x, x.T @ x
        task = TaskContext.get().partitionId()
        # A row at a time: no message is wider than one column's sums.
        for i in range(p):
            yield pa.RecordBatch.from_pylist([{"task": task, "i": i, **dict(zip(parts, total[:, i]))}], schema)

    def added(table: pa.Table) -> pa.Table:
        sums = {c: table[c].combine_chunks().flatten().to_numpy().reshape(table.num_rows, p).sum(axis=0) for c in parts}
        return pa.Table.from_pylist([{"task": table["task"][0].as_py() // FAN_IN, "i": table["i"][0].as_py(), **sums}], schema)

    # A table without rows has its pairs, too.
    nothing = F.array_repeat(F.lit(0.0), p)
    empty = df.sparkSession.range(p).select(
        F.lit(0).cast("long").alias("task"), F.col("id").cast("int").alias("i"), *[nothing.alias(c) for c in parts])
    sums = stored(rows.mapInArrow(products, ddl).unionByName(empty))
    most = sums.agg(F.max("task")).first()[0]
    while True:
        sums = sums.groupBy("i", F.floor(F.col("task") / FAN_IN)).applyInArrow(added, ddl)
        if most < FAN_IN:
            break
        most //= FAN_IN
    labels = F.array(*map(F.lit, names))
    cells = sums.select("i", F.posexplode(F.arrays_zip(*parts)).alias("j", "s"))
    n, x, y, xy = (F.col(f"s.{c}") for c in parts)
    value = F.when(n > 1, (xy - x * y / n) / (n - 1))
    return cells.select(
        F.get(labels, F.col("i")).alias("row_name"), F.get(labels, F.col("j")).alias("column_name"), value.alias("covariance"))


def vector_moments(df: DataFrame, vector: str) -> tuple[int, np.ndarray, np.ndarray]:
    """Row count, mean and sample covariance of the complete rows of an array column, by two tree
    aggregations."""
    rows = df.where(complete(vector)).select(array_to_vector(doubles(vector)).alias("v"))
    summary = rows.agg(Summarizer.metrics("count", "mean", "std").summary(F.col("v")).alias("s")).first()["s"]
    mean, sd = summary["mean"].toArray(), summary["std"].toArray()
    corr = Correlation.corr(rows, "v").first()[0].toArray()
    corr = np.where(np.isnan(corr), 0.0, corr)  # constant columns
    np.fill_diagonal(corr, 1.0)
    return int(summary["count"]), mean, corr * np.outer(sd, sd)


def eig_sorted(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues from large to small and their vectors as columns. The sign makes the largest
    loading of a vector positive."""
    values, vectors = np.linalg.eigh(np.asarray(matrix, dtype=float))
    values, vectors = values[::-1], vectors[:, ::-1]
    top = np.abs(vectors).argmax(axis=0)
    signs = np.sign(vectors[top, np.arange(vectors.shape[1])])
    return values, vectors * np.where(signs == 0, 1.0, signs)


def project(vector: Column | str, matrix: np.ndarray, centre: np.ndarray | None = None) -> Column:
    """Array of products of a row's vector, less `centre`, with the columns of `matrix` (p x k); NULL
    for an incomplete vector."""
    table = np.asarray(matrix, dtype=float)
    shift = np.zeros(table.shape[0]) if centre is None else np.asarray(centre, dtype=float)

    @F.arrow_udf(T.ArrayType(T.DoubleType()))
    def products(v: pa.Array) -> pa.Array:
        there = v.is_valid().to_numpy(zero_copy_only=False)
        rows = v.flatten().to_numpy(zero_copy_only=False).reshape(there.sum(), -1)
        out = (rows - shift) @ table if len(rows) else np.empty((0, table.shape[1]))
        ends = np.concatenate([[0], np.cumsum(there)]).astype(np.int32) * np.int32(table.shape[1])
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(out.ravel()), mask=pa.array(~there))

    return products(whole(vector))


def with_scores(df: DataFrame, vector: str, matrix: np.ndarray, centre: np.ndarray | None = None) -> DataFrame:
    """Add columns score_1 ... score_k."""
    k = np.asarray(matrix).shape[1]
    projected = df.withColumn("__p", project(vector, matrix, centre))
    return projected.select(*df.columns, *[F.col("__p")[i].alias(f"score_{i + 1}") for i in range(k)])


@dataclass
class Components:
    """Kept components as rows, with their singular values, variances and cumulative shares."""

    components: np.ndarray
    singular_values: np.ndarray
    variances: np.ndarray
    singular_share: np.ndarray
    variance_share: np.ndarray
    mean: np.ndarray

    def __len__(self) -> int:
        return len(self.singular_values)

    def keep(self, mask: np.ndarray) -> "Components":
        return Components(
            self.components[mask], self.singular_values[mask], self.variances[mask],
            self.singular_share[mask], self.variance_share[mask], self.mean)


def pca_fit(df: DataFrame, vector: str, kaiser: bool = False, sval_threshold: float = 1.0,
            var_threshold: float = 1.0, digits: int = 4, n_components: int | None = None) -> Components:
    """Principal components, filtered in this order: cumulative singular value share, variance at
    least 1 (`kaiser`), cumulative variance share; values are rounded before they are compared."""
    n, mean, cov = vector_moments(df, vector)
    variances, vectors = eig_sorted(cov)
    variances = np.clip(variances, 0.0, None)
    kept = min(n_components or len(variances), n, len(variances))
    variances, vectors = variances[:kept], vectors[:, :kept]
    singular = np.sqrt(variances * (n - 1))
    found = Components(
        vectors.T, singular, variances, singular.cumsum() / singular.sum(), variances.cumsum() / variances.sum(), mean)
    found = found.keep(np.round(found.singular_share, digits) <= round(sval_threshold, digits))
    if kaiser:
        found = found.keep(np.round(found.variances, digits) >= 1.0)
    return found.keep(np.round(found.variance_share, digits) <= round(var_threshold, digits))


def pca_transform(df: DataFrame, vector: str, fitted: Components) -> DataFrame:
    """Scores of the rows as they are, without centring."""
    return with_scores(df, vector, fitted.components.T)


def standardized(df: DataFrame, columns: Sequence[str] | None = None, vector: str | None = None,
                 train: DataFrame | None = None, name: str = "features") -> DataFrame:
    """Array column of (x - mean) / population deviation, fitted on `train`."""
    source = df if vector else as_vector_column(df, columns, name)
    fit_on = source if train is None else (train if vector else as_vector_column(train, columns, name))
    column = vector or name
    summary = fit_on.where(complete(column)).select(array_to_vector(doubles(column)).alias("v")).agg(
        Summarizer.metrics("count", "mean", "variance").summary(F.col("v")).alias("s")).first()["s"]
    n = summary["count"]
    width = np.sqrt(summary["variance"].toArray() * (n - 1) / n)
    width = np.where(width == 0, 1.0, width)
    mean = F.array(*[F.lit(float(x)) for x in summary["mean"].toArray()])
    inverse = F.array(*[F.lit(float(1 / x)) for x in width])
    centred = F.zip_with(doubles(column), mean, lambda x, m: x - m)
    return source.withColumn(name, F.zip_with(centred, inverse, lambda x, w: x * w))


@dataclass
class Reduction:
    """A linear map to few scores: `matrix` (p x k), the subtracted centre and, where they
    exist, the variances of all directions."""

    matrix: np.ndarray
    centre: np.ndarray
    variances: np.ndarray

    def scores(self, df: DataFrame, vector: str) -> DataFrame:
        return with_scores(df, vector, self.matrix, self.centre)

    def loadings(self, spark, names: Sequence[str]) -> DataFrame:
        """(feature, component, loading)"""
        rows = [(n, j + 1, float(self.matrix[i, j]))
                for i, n in enumerate(names) for j in range(self.matrix.shape[1])]
        return spark.createDataFrame(rows, "feature string, component int, loading double")


@dataclass
class Factors(Reduction):
    """A factor model: also the loadings (p x k) and each column's own noise."""

    loadings_matrix: np.ndarray
    noise: np.ndarray


def pca_to_share(df: DataFrame, vector: str, share: float) -> Reduction:
    """The fewest components whose variance reaches the given share of the total."""
    _, mean, cov = vector_moments(df, vector)
    values, vectors = eig_sorted(cov)
    reached = values.cumsum() / values.sum()
    k = int(np.argmax(reached >= share - 1e-12)) + 1
    return Reduction(vectors[:, :k], mean, values)


def factor_count(values: np.ndarray) -> int:
    """Eigenvalues whose log magnitude is positive."""
    size = np.abs(values)
    return int((size > 1.0).sum())


def factor_fit(df: DataFrame, vector: str, n_factors: int | None = None, tolerance: float = 1e-9,
               max_iter: int = 100_000) -> "Factors":
    """Maximum-likelihood factor analysis by expectation and maximisation on the covariance matrix.

    The rounds need only p x p numbers. They start at the leading directions and end when a round
    raises the likelihood per row by less than `tolerance` of its size; a fit that hasn't ended after
    `max_iter` rounds warns. The map gives the expected factors of a row.
    """
    n, mean, cov = vector_moments(df, vector)
    spread = cov * (n - 1) / n
    values, vectors = eig_sorted(cov)
    k = max(1, factor_count(values) if n_factors is None else n_factors)
    floor = 1e-10 * max(values[0], 1e-300)
    noise = np.clip(np.diag(spread) / 2, floor, None)
    loadings = vectors[:, :k] * np.sqrt(np.clip(values[:k], floor, None) / 2)
    before = -np.inf
    for _ in range(max_iter):
        # The factors expected given the rows, as a map, and their second moments.
        weighted = loadings / noise[:, None]
        inner = np.linalg.inv(np.eye(k) + loadings.T @ weighted)
        expect = inner @ weighted.T
        moved = spread @ expect.T
        # The likelihood per row, by the determinant and inverse of a k x k matrix.
        fit = np.log(noise).sum() - np.linalg.slogdet(inner)[1] + (np.diag(spread) / noise).sum() - np.trace(weighted.T @ moved)
        likelihood = -0.5 * (fit + len(noise) * np.log(2 * np.pi))
        if likelihood - before < tolerance * (1 + abs(likelihood)):
            break
        before = likelihood
        loadings = moved @ np.linalg.inv(inner + expect @ moved)
        noise = np.clip(np.diag(spread) - (loadings * moved).sum(axis=1), floor, None)
    else:
        warnings.warn(f"factor analysis has not converged in {max_iter} rounds", RuntimeWarning, stacklevel=2)
    return Factors(expect.T, mean, (loadings ** 2).sum(axis=0), loadings, noise)


def lda_fit(df: DataFrame, vector: str, label: str) -> Reduction:
    """Directions with the largest between-class variance for unit within-class variance, at most
    classes - 1. The within-class scatter is the total less the between-class scatter."""
    df = df.where(complete(vector))
    n, mean, cov = vector_moments(df, vector)
    summary = Summarizer.metrics("mean", "count").summary(array_to_vector(doubles(vector)))
    classes = df.groupBy(label).agg(summary.alias("s")).select(
        F.col("s.count").alias("n"), vector_to_array("s.mean").alias("m")).collect()
    sizes = np.array([r["n"] for r in classes], dtype=float)
    offsets = np.array([r["m"] for r in classes]) - mean
    between = (offsets * sizes[:, None]).T @ offsets
    within = (cov * (n - 1) - between) / (n - len(classes))
    values, vectors = eig_sorted(within)
    kept = values > values.max() * 1e-10
    white = vectors[:, kept] / np.sqrt(values[kept])
    strength, turn = eig_sorted(white.T @ (between / max(1, len(classes) - 1)) @ white)
    k = min(len(classes) - 1, int((strength > strength.max() * 1e-10).sum()))
    return Reduction(white @ turn[:, :k], mean, strength[:k])
