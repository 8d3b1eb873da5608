"""Column profiles: describe, moments, quantile ranges, counts of values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import finite
from .quantiles import quantiles
from ..session import stored
from .ranking import join_on


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def features_and_target(df: DataFrame, target: str) -> tuple[DataFrame, DataFrame]:
    """The table without the target column, and the target alone."""
    return df.drop(target), df.select(target)


def unpivoted(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = (), cast: str = "double") -> DataFrame:
    """(keep..., column, value): one row per cell. NaN becomes NULL."""
    cells = [finite(c) if cast == "double" else F.col(c).cast(cast) for c in columns]
    pairs = F.array(*[
        F.struct(F.lit(name).alias("column"), cell.alias("value")) for name, cell in zip(columns, cells)
    ])
    return df.select(*keep, F.explode(pairs).alias("__cell")).select(
        *keep, F.col("__cell.column").alias("column"), F.col("__cell.value").alias("value"))


def value_counts(cells: DataFrame, keys: Sequence[str] = ("column", "value")) -> DataFrame:
    return cells.where(F.col("value").isNotNull()).groupBy(*keys).agg(F.count(F.lit(1)).alias("n_value"))


def _listed(counts: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The counts, with a row that counts nothing for each column, so that none is missing."""
    names = F.array(*map(F.lit, columns))
    value = counts.schema["value"].dataType
    empty = counts.sparkSession.range(1).select(
        F.explode(names).alias("column"), F.lit(None).cast(value).alias("value"), F.lit(0).cast("long").alias("n_value"))
    return counts.unionByName(empty)


def _weighted_moments(counts: DataFrame) -> DataFrame:
    """(column, n, mean, min, max, m2, m3, m4): sizes and sums of powers of the distances to the mean,
    from stored counts of values."""
    v, w = F.col("value"), F.col("n_value")
    first = counts.groupBy("column").agg(
        F.sum(w).alias("n"), F.try_divide(F.sum(v * w), F.sum(w).cast("double")).alias("mean"), F.min(v).alias("min"), F.max(v).alias("max"))
    away = v - F.col("mean")
    powers = counts.join(F.broadcast(first.select("column", "mean")), "column").groupBy("column").agg(
        *[F.sum(w * F.pow(away, F.lit(float(k)))).alias(f"m{k}") for k in (2, 3, 4)])
    return first.join(powers, "column")


def _with_modes(counts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Cardinality and highest count per column, and the values reaching it."""
    top = counts.groupBy("column").agg(
        F.count(F.lit(1)).alias("cardinality"), F.max("n_value").alias("mode_count"))
    ties = counts.join(top.select("column", F.col("mode_count").alias("__top")), "column")
    return top, ties.where(F.col("n_value") == F.col("__top")).select("column", "value")


def _missing(df: DataFrame, columns: Sequence[str], sentinels: Sequence) -> DataFrame:
    """Missing cells per column: NULL, NaN, or one of the sentinels of the column's kind."""
    fields = {f.name: f.dataType for f in df.schema.fields}
    counts = []
    for name in columns:
        number = isinstance(fields[name], T.NumericType)
        c = finite(name) if number else F.col(name)
        mine = [s for s in sentinels if isinstance(s, (int, float)) == number]
        gone = c.isNull() | c.isin(mine) if mine else c.isNull()
        counts.append(F.struct(
            F.lit(name).alias("column"), F.count(F.when(gone, 1)).alias("missing"),
            F.lit(fields[name].simpleString()).alias("dtype")))
    return df.agg(F.array(*counts).alias("__m")).select(F.inline("__m"))


# Types described by their texts.
TEXT_LIKE = ("date", "timestamp", "timestamp_ntz", "boolean")


def describe(df: DataFrame, missing_values: Sequence = (), columns: Sequence[str] | None = None) -> DataFrame:
    """One row per column: count, mean, std, min, q25, q50, q75, max, mode, mode_text, skew, dtype,
    cardinality, missing.

    A numeric mode is the median of all most frequent values; `mode_text` is
    the smallest most frequent text. Skew is the population skew, for columns
    with more than one value. Numbers are NULL for text columns. Dates, times
    and booleans are described as their texts; nested columns are left out.
    """
    chosen = list(columns) if columns is not None else df.columns
    numbers = [c for c in numeric_columns(df) if c in chosen]
    texts = [c for c in text_columns(df) if c in chosen]
    others = [c for c, kind in df.dtypes if kind in TEXT_LIKE and c in chosen]
    names = _missing(df, numbers + texts, missing_values)
    if others:
        names = names.unionByName(_missing(df, others, ()))
    texts = texts + others
    parts = []
    if numbers:
        counts = _listed(stored(value_counts(unpivoted(df, numbers))), numbers)
        stats = _weighted_moments(counts).select(
            "column", F.col("n").alias("count"), "mean", F.sqrt(F.try_divide(F.col("m2"), F.col("n") - 1)).alias("std"),
            "min", "max", F.try_divide(F.sqrt("n") * F.col("m3"), F.pow("m2", F.lit(1.5))).alias("__skew"))
        top, modes = _with_modes(counts.where("value IS NOT NULL"))
        quart = quantiles(counts, "value", [0.25, 0.5, 0.75], ["column"], "n_value").select("column", F.col("q").alias("__q"))
        middle = quantiles(modes, "value", [0.5], ["column"]).select("column", F.col("q")[0].alias("mode"))
        both = stats.join(top, "column", "left").join(quart, "column", "left").join(middle, "column", "left")
        parts.append(both.select(
            "column", "count", "mean", "std", "min", F.col("__q")[0].alias("q25"), F.col("__q")[1].alias("q50"),
            F.col("__q")[2].alias("q75"), "max", "mode", F.lit(None).cast("string").alias("mode_text"),
            F.when(F.col("cardinality") > 1, F.col("__skew")).alias("skew"),
            F.coalesce("cardinality", F.lit(0)).alias("cardinality")))
    if texts:
        counts = _listed(stored(value_counts(unpivoted(df, texts, cast="string"))), texts)
        stats = counts.groupBy("column").agg(F.sum("n_value").alias("count"))
        top, modes = _with_modes(counts.where("value IS NOT NULL"))
        smallest = modes.groupBy("column").agg(F.min("value").alias("mode_text"))
        both = stats.join(top, "column", "left").join(smallest, "column", "left")
        none = F.lit(None).cast("double")
        parts.append(both.select(
            "column", "count", *[none.alias(c) for c in ("mean", "std", "min", "q25", "q50", "q75", "max", "mode")],
            "mode_text", none.alias("skew"), F.coalesce("cardinality", F.lit(0)).alias("cardinality")))
    table = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return table.join(names, "column")


def moments(df: DataFrame, columns: Sequence[str], ddof: int = 0) -> DataFrame:
    """One row per column: n, mean, median, mode (smallest) and its count, sdev, and the
    bias-corrected skew and kurtosis."""
    counts, n = stored(value_counts(unpivoted(df, columns))), F.col("n")
    stats = _weighted_moments(counts).select(
        "column", "n", "mean", (F.col("m2") / n).alias("__var"),
        F.try_divide(F.sqrt("n") * F.col("m3"), F.pow("m2", F.lit(1.5))).alias("__g1"),
        (F.try_divide(n * F.col("m4"), F.col("m2") * F.col("m2")) - 3).alias("__g2"))
    top, modes = _with_modes(counts)
    smallest = modes.groupBy("column").agg(F.min("value").alias("mode"))
    middle = quantiles(counts, "value", [0.5], ["column"], "n_value").select(
        "column", F.col("q")[0].alias("median"))
    sdev = F.sqrt(F.try_divide(F.col("__var") * n, n - ddof))
    skew = F.col("__g1") * F.try_divide(F.sqrt(n * (n - 1)), n - 2)
    kurt = F.try_divide(n - 1, (n - 2) * (n - 3)) * ((n + 1) * F.col("__g2") + 6)
    return (
        stats.join(top.drop("cardinality"), "column").join(smallest, "column").join(middle, "column")
        .select("column", "n", "mean", "median", "mode", "mode_count", sdev.alias("sdev"),
                skew.alias("skew"), kurt.alias("kurtosis"))
    )


def iqr(df: DataFrame, columns: Sequence[str], span: tuple[float, float] = (0.25, 0.75)) -> DataFrame:
    """Distance between two quantiles of each column; `span` in fractions."""
    q = quantiles(unpivoted(df, columns), "value", list(span), ["column"])
    return q.select("column", (F.col("q")[1] - F.col("q")[0]).alias("iqr"))


def skew_table(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return unpivoted(df, columns).groupBy("column").agg(F.skewness("value").alias("skew"))


def label_counts(df: DataFrame, label: str) -> DataFrame:
    """Rows and share of all rows per label."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    total = df.agg(F.count(F.lit(1))).scalar()
    return counts.select(label, "n", (F.col("n") * F.lit(100.0) / total).alias("percent"))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Sorted unique values with their counts."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n")).orderBy(F.col(column).asc_nulls_last())


def _impurity_of(share: Column, method: str) -> Column:
    if method == "shannon":
        return F.sum(F.when(share > 0, -share * F.log2(share)))
    if method == "gini":
        return F.lit(1.0) - F.sum(share * share)
    raise ValueError(f"no impurity is called {method!r}; choose shannon or gini")


def impurity(df: DataFrame, column: str, method: str = "shannon") -> DataFrame:
    """Entropy (log2) or Gini impurity of a column, as one row."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    total = df.agg(F.count(F.lit(1))).scalar()
    return counts.select((F.col("n") / total).alias("share")).agg(
        _impurity_of(F.col("share"), method).alias("impurity"))


def info_gain(df: DataFrame, split: str, target: str, method: str = "shannon") -> DataFrame:
    """Impurity of the target minus its weighted impurity within the values of `split`."""
    pairs = df.groupBy(F.col(split).alias("__s"), F.col(target).alias("__t")).agg(F.count(F.lit(1)).alias("n"))
    sizes = pairs.groupBy("__s").agg(F.sum("n").alias("size"))
    total = df.agg(F.count(F.lit(1))).scalar()
    inner = (
        join_on(pairs, sizes, ["__s"])
        .groupBy("__s", "size").agg(_impurity_of(F.col("n") / F.col("size"), method).alias("part"))
        .agg(F.sum(F.col("part") * F.col("size") / total).alias("after"))
    )
    return impurity(df, target, method).select(
        (F.col("impurity") - inner.select("after").scalar()).alias("info_gain"))
