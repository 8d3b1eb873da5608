"""Category codes, indicators and their inverses."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .profile import text_columns, unpivoted
from ..session import stored
from .attach import attach
from .ranking import join_summary, positions


def sorted_codes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Dictionary (column, value, code): values in sorted order, codes from 0."""
    values = unpivoted(df, columns, cast="string").where(F.col("value").isNotNull()).distinct()
    return positions(values, ["column"], [F.col("value")], "code").withColumn(
        "code", (F.col("code") - 1).cast("int"))


def label_encode(df: DataFrame, column: str, name: str | None = None) -> DataFrame:
    """Add the code of a column's value in sorted order; NULL stays NULL."""
    codes = sorted_codes(df, [column]).select(F.col("value").alias(column), F.col("code").alias("__code"))
    return join_summary(df, codes, [column]).withColumn(name or f"{column}_code", F.col("__code")).drop("__code")


def label_decode(df: DataFrame, column: str, codes: DataFrame, name: str) -> DataFrame:
    """Value of a code, from a dictionary of one column made by sorted_codes; NULL for unknown codes."""
    values = codes.select(F.col("code").alias(column), F.col("value").alias(name))
    return join_summary(df, values, [column])


def first_seen_codes(df: DataFrame, order: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Dictionary (column, value, code): values in order of first appearance by `order`."""
    columns = list(columns or text_columns(df))
    cells = unpivoted(df, columns, [order], cast="string").where(F.col("value").isNotNull())
    first = cells.groupBy("column", "value").agg(F.min(order).alias("__first"))
    return positions(first, ["column"], [F.col("__first"), F.col("value")], "code").select(
        "column", "value", (F.col("code") - 1).cast("int").alias("code"))


def factorize(df: DataFrame, order: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Replace every text column by its codes in order of first appearance; missing gives -1."""
    columns = list(columns or text_columns(df))
    codes = stored(first_seen_codes(df, order, columns))
    out = df
    for c in columns:
        mine = codes.where(F.col("column") == c).select(F.col("value").alias(c), F.col("code").alias(f"__{c}"))
        out = attach(out, mine, [c])
    return out.select(*[
        F.coalesce(F.col(f"__{c}"), F.lit(-1)).alias(c) if c in columns else F.col(c) for c in df.columns
    ])


def one_hot_drop_first(df: DataFrame, column: str, levels: Sequence | None = None) -> DataFrame:
    """Indicator columns `{column}_{level}` for all levels but the first in sorted order.

    `levels` names them, sorted; by default they are the values found. Each becomes a column, so a
    table is as wide as they are many; `one_hot_sparse` has no such width.
    """
    if levels is None:
        levels = sorted(r[0] for r in df.select(column).where(F.col(column).isNotNull()).distinct().collect())
    flags = [F.coalesce(F.col(column) == v, F.lit(False)).cast("int").alias(f"{column}_{v}") for v in levels[1:]]
    return df.select(*[c for c in df.columns if c != column], *flags)


def one_hot_inverse(df: DataFrame, column: str, levels: Sequence[str]) -> DataFrame:
    """The level behind indicator columns made by one_hot_drop_first from sorted `levels`."""
    value = F.lit(levels[0])
    for level in levels[1:]:
        value = F.when(F.col(f"{column}_{level}") == 1, F.lit(level)).otherwise(value)
    return df.withColumn(column, value)


def one_hot_sparse(df: DataFrame, column: str, codes: DataFrame, name: str, drop_first: bool = True) -> DataFrame:
    """Add the indicators of any number of levels as a sparse vector (size, indices, values).

    `codes` is a stored dictionary by sorted_codes; it never leaves the cluster, and the rows stay
    where they are if it is small. The first level has no indicator with `drop_first`. A NULL gives
    NULL, and a value that the dictionary lacks a vector without indicators and of size NULL.
    """
    mine = codes.where(F.col("column") == column).select(F.col("value").alias("__level"), F.col("code").alias("__code"))
    first = 1 if drop_first else 0
    size = mine.agg(F.count(F.lit(1)) - first).scalar()
    coded = attach(df.withColumn("__level", F.col(column).cast("string")), mine, ["__level"])
    place, known = F.col("__code") - first, F.col("__code").isNotNull()
    none = F.array().cast("array<int>")
    vector = F.struct(
        F.when(known, size).alias("size"), F.when(known & (place >= 0), F.array(place.cast("int"))).otherwise(none).alias("indices"),
        F.when(known & (place >= 0), F.array(F.lit(1.0))).otherwise(none.cast("array<double>")).alias("values"))
    return coded.withColumn(name, F.when(F.col(column).isNotNull(), vector)).drop("__level", "__code")


def one_hot_sparse_inverse(df: DataFrame, vector: str, column: str, codes: DataFrame, name: str, drop_first: bool = True) -> DataFrame:
    """The levels behind sparse vectors made by one_hot_sparse; NULL where it knew none."""
    mine = codes.where(F.col("column") == column).select(F.col("code").alias("__code"), F.col("value").alias(name))
    first = 1 if drop_first else 0
    place = F.coalesce(F.get(F.col(f"{vector}.indices"), F.lit(0)) + first, F.lit(0) if drop_first else F.lit(None).cast("int"))
    coded = df.withColumn("__code", F.when(F.col(f"{vector}.size").isNotNull(), place.cast("int")))
    return attach(coded, mine, ["__code"]).drop("__code")
