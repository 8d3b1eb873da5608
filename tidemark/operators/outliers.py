"""Quantile-range outliers: finding, counting and replacing them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import finite
from .profile import unpivoted
from .quantiles import quantile_row, quantiles
from .ranking import last_seen, over_series, positions

Span = tuple[float, float]


def _limits(q: Sequence[Column], scale: float) -> tuple[Column, Column]:
    """Thresholds from quantiles, the first two being the low and the high one."""
    width = q[1] - q[0]
    return q[0] - F.lit(scale) * width, q[1] + F.lit(scale) * width


def outlier_flag(df: DataFrame, column: str, span: Span = (0.25, 0.75), scale: float = 1.5) -> Column:
    """True outside the thresholds; NULL for missing values."""
    low, high = _limits(quantile_row(df, column, span), scale)
    x = finite(column)
    return (x < low) | (x > high)


def outliers(df: DataFrame, column: str, order: Sequence[str], span: Span = (0.25, 0.75),
             scale: float = 1.5) -> DataFrame:
    """The outlying rows with their position (from 0) in the given row order."""
    numbered = positions(df, [], [F.col(c) for c in order], "__row")
    found = numbered.where(outlier_flag(df, column, span, scale))
    return found.select(*df.columns, (F.col("__row") - 1).alias("row"))


def treat_outliers(df: DataFrame, column: str, method: str = "clip", span: Span = (0.25, 0.75),
                   scale: float = 1.5, name: str | None = None, fit: DataFrame | None = None) -> DataFrame:
    """Replace outliers: `clip` gives median + sign(x) * iqr, or the `median`, or the `mean`.
    The statistics come from `fit`, by default the table itself."""
    fit = df if fit is None else fit
    q = quantile_row(fit, column, [*span, 0.5])
    low, high = _limits(q, scale)
    x = finite(column)
    if method == "clip":
        replacement = q[2] + F.signum(x) * (q[1] - q[0])
    elif method == "median":
        replacement = q[2]
    elif method == "mean":
        replacement = fit.agg(F.avg(finite(column))).scalar()
    else:
        raise ValueError(f"unknown method: {method}")
    return df.withColumn(name or column, F.when((x < low) | (x > high), replacement).otherwise(x))


def impute_median(df: DataFrame, column: str, name: str | None = None) -> DataFrame:
    """Outliers and missing values become the median, rounded half to even for integers."""
    q = quantile_row(df, column, [0.25, 0.75, 0.5])
    low, high = _limits(q, 1.5)
    x = finite(column)
    whole = isinstance(df.schema[column].dataType, T.IntegralType)
    median = F.bround(q[2], 0) if whole else q[2]
    return df.withColumn(name or column, F.when(x.between(low, high), x).otherwise(median))


def impute_neighbours(df: DataFrame, column: str, key: Sequence[str], order: Sequence[str],
                      name: str | None = None) -> DataFrame:
    """Outliers (of the whole column) become the mean of the values just before and after them
    in their series. The first and the last row of a series stay. Missing values count as
    outliers. Neighbours are taken as they were, not as replaced."""
    low, high = _limits(quantile_row(df, column, (0.25, 0.75)), 1.5)
    flagged = df.withColumn("__x", finite(column)).withColumn(
        "__odd", ~F.coalesce(F.col("__x").between(low, high), F.lit(False)))
    ordering = [F.col(c) for c in order]

    def build(rows: DataFrame, keys: list[str]) -> DataFrame:
        w = Window.partitionBy(*keys).orderBy(*ordering)
        # lag of a constant tells a missing neighbour from a neighbour without value
        inner = F.lag(F.lit(1)).over(w).isNotNull() & F.lead(F.lit(1)).over(w).isNotNull()
        mean = (F.lag("__x").over(w) + F.lead("__x").over(w)) / 2
        return rows.withColumn("__new", F.when(F.col("__odd") & inner, mean).otherwise(F.col("__x")))

    done = over_series(flagged, key, ordering, 1, 1, build)
    return done.withColumn(name or column, F.col("__new")).drop("__x", "__odd", "__new")


def outliers_to_ffill(df: DataFrame, column: str, key: Sequence[str], order: Sequence[str],
                      span: Span = (0.01, 0.99), scale: float = 3.0, name: str | None = None) -> DataFrame:
    """Outliers become the last ordinary value before them; leading ones become NULL."""
    odd = outlier_flag(df, column, span, scale)
    kept = F.when(~F.coalesce(odd, F.lit(False)), finite(column))
    return last_seen(df, key, list(order), kept, name or column)


def outlier_counts(df: DataFrame, columns: Sequence[str], span: Span = (0.01, 0.99),
                   scale: float = 3.0) -> DataFrame:
    """Number of outliers of each column."""
    cells = unpivoted(df, columns)
    low, high = _limits([F.col("q")[0], F.col("q")[1]], scale)
    limits = quantiles(cells, "value", list(span), ["column"]).select(
        "column", low.alias("low"), high.alias("high"))
    # one row per column: the limits become constants of a single pass
    counts = []
    for row in limits.collect():
        x = finite(row["column"])
        odd = (x < row["low"]) | (x > row["high"])
        counts.append(F.struct(F.lit(row["column"]).alias("column"), F.count(F.when(odd, 1)).alias("n_outliers")))
    if not counts:
        return limits.select("column", F.lit(0).cast("long").alias("n_outliers"))
    return df.agg(F.array(*counts).alias("__c")).select(F.inline("__c"))


def topk_outlier_columns(df: DataFrame, columns: Sequence[str], k: int = 4, span: Span = (0.01, 0.99),
                         scale: float = 3.0) -> DataFrame:
    """The k columns with most outliers; equal counts in name order."""
    counts = outlier_counts(df, columns, span, scale)
    return counts.orderBy(F.col("n_outliers").desc(), "column").limit(k)
