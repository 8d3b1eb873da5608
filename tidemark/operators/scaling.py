"""Scalers with inverses, monotone transforms, equal-width bins."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import finite
from ..functions.distributions import normal_score
from .quantiles import quantile_row, quantiles
from .ranking import join_summary


def standard_parameters(train: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row with a struct (centre, width) per column: mean and population deviation."""
    def width(c: str) -> Column:
        sd = F.stddev_pop(finite(c))
        return F.when(sd == 0, F.lit(1.0)).otherwise(sd)

    return train.agg(*[
        F.struct(F.avg(finite(c)).alias("centre"), width(c).alias("width")).alias(c) for c in columns
    ])


def _applied(df: DataFrame, parameters: DataFrame, formula) -> DataFrame:
    """Apply the fitted numbers (one row, read once) as literals."""
    fitted = parameters.first().asDict()
    return df.select(*[
        formula(finite(c), *[F.lit(v).cast("double") for v in fitted[c]]).alias(c) if c in fitted else F.col(c)
        for c in df.columns
    ])


def scale(df: DataFrame, parameters: DataFrame) -> DataFrame:
    """(x - centre) / width for every fitted column; fit on train, apply to any table."""
    return _applied(df, parameters, lambda x, centre, width: (x - centre) / width)


def unscale(df: DataFrame, parameters: DataFrame) -> DataFrame:
    return _applied(df, parameters, lambda x, centre, width: x * width + centre)


def standard_scale(df: DataFrame, columns: Sequence[str], train: DataFrame | None = None) -> DataFrame:
    return scale(df, standard_parameters(train if train is not None else df, columns))


def minmax_by_group(df: DataFrame, keys: Sequence[str], column: str, name: str) -> DataFrame:
    """(x - min) / (max - min) within each group; a constant group gives 0. The group's `low`
    and `high` are kept so that the scaling can be undone."""
    bounds = df.groupBy(*keys).agg(F.min(column).alias("low"), F.max(column).alias("high"))
    joined = join_summary(df, bounds, keys)
    scaled = F.coalesce(F.try_divide(F.col(column) - F.col("low"), F.col("high") - F.col("low")), F.lit(0.0))
    return joined.withColumn(name, scaled)


def minmax_inverse(df: DataFrame, column: str, name: str) -> DataFrame:
    return df.withColumn(name, F.col(column) * (F.col("high") - F.col("low")) + F.col("low"))


def _minimum(df: DataFrame, column: str) -> Column:
    return df.agg(F.min(finite(column))).scalar()


def log_transform(df: DataFrame, column: str, small_constant: float = 1.0, name: str | None = None) -> DataFrame:
    """ln(x - min + c)"""
    shifted = finite(column) - _minimum(df, column) + F.lit(small_constant)
    return df.withColumn(name or column, F.log(shifted))


def sqrt_transform(df: DataFrame, column: str, small_constant: float = 1e-10, name: str | None = None) -> DataFrame:
    """sqrt(x + max(c, min))"""
    shift = F.greatest(F.lit(small_constant), _minimum(df, column))
    return df.withColumn(name or column, F.sqrt(finite(column) + shift))


def bin_layout(df: DataFrame, column: str, method: str = "sturges", num_bins: int | None = None) -> DataFrame:
    """One row: low, high and number of equal-width bins k."""
    x = finite(column)
    base = df.agg(F.count(x).alias("n"), F.min(x).alias("low"), F.max(x).alias("high"))
    n = F.col("n").cast("double")
    if num_bins is not None:
        k = F.lit(num_bins)
    elif method == "sturges":
        k = F.floor(1 + F.sqrt(n))
    elif method == "freedman_diaconis":
        q = quantile_row(df, column, (0.25, 0.75))
        width = 2 * (q[1] - q[0]) / F.pow(n, F.lit(1 / 3))
        # without spread between the quartiles there is no width: one bin
        k = F.greatest(F.lit(1), F.coalesce(F.floor(F.try_divide(F.col("high") - F.col("low"), width)), F.lit(1)))
    elif method == "sqrt":
        k = F.floor(F.sqrt(n))
    else:
        raise ValueError(f"unknown method: {method}")
    return base.select("low", "high", k.cast("long").alias("k"))


def create_bins(df: DataFrame, column: str, method: str = "sturges", num_bins: int | None = None,
                name: str = "bin_index", fit: DataFrame | None = None) -> DataFrame:
    """Index 1..k of the equal-width bin; the maximum gets k + 1. The bins are laid out over
    `fit`, by default the table itself."""
    layout = bin_layout(df if fit is None else fit, column, method, num_bins)
    low, high, k = (F.lit(v) for v in layout.first())
    x = finite(column)
    spread = F.width_bucket(x, low, high, k)
    return df.withColumn(name, F.when(low < high, spread).when(x.isNotNull(), k + 1).cast("long"))


def bin_edges(df: DataFrame, column: str, method: str = "sturges", num_bins: int | None = None) -> DataFrame:
    """The k + 1 edges, numbered from 0."""
    layout = bin_layout(df, column, method, num_bins)
    return layout.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("k"))).alias("edge")).select(
        "edge", (F.col("low") + F.col("edge") * (F.col("high") - F.col("low")) / F.col("k")).alias("value"))


# Grid size and the probability the ends are clipped to.
NORMAL_GRID = 1_000
NORMAL_CLIP = 1e-7


def quantile_normal(df: DataFrame, column: str, name: str | None = None) -> DataFrame:
    """Map values to normal scores by their place in a grid of exact quantiles.

    The grid is a bounded array; each value is placed between its neighbours in
    it, tied values in the middle of their run.
    """
    placed = grid_place(df, column, name or column)
    p = F.greatest(F.least(F.col(name or column), F.lit(1 - NORMAL_CLIP)), F.lit(NORMAL_CLIP))
    return placed.withColumn(name or column, normal_score(p))


def grid_place(df: DataFrame, column: str, name: str) -> DataFrame:
    """The place of each value, from 0 to 1, in a grid of NORMAL_GRID exact quantiles."""
    x = finite(column)
    probabilities = [i / (NORMAL_GRID - 1) for i in range(NORMAL_GRID)]
    grid = quantiles(df, x, probabilities).select("q").first()
    if not grid:
        return df.withColumn(name, F.lit(None).cast("double"))
    return df.withColumn(name, _grid_place(grid[0], probabilities)(x))


def _grid_place(grid: list[float], probabilities: list[float]):
    values, places = np.asarray(grid, dtype=float), np.asarray(probabilities)

    @F.pandas_udf("double")
    def place(x: pd.Series) -> pd.Series:
        low = np.interp(x, values, places)
        high = 1 - np.interp(-x, -values[::-1], 1 - places[::-1])
        return pd.Series((low + high) / 2).where(x.notna())

    return place
