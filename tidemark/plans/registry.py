"""Registry of queries and the SQL each is checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def _shift(digits: int) -> float:
    """Moves exact halves off the rounding boundary, the same way on both sides."""
    return 4 * 10.0 ** -(digits + 4)


def rounded(df: DataFrame, columns: dict[str, int]) -> DataFrame:
    """Round doubles so that a different summation order cannot show in a comparison."""
    return df.select(*[
        F.round(F.col(f"`{c}`") + F.lit(_shift(columns[c])), columns[c]).alias(c) if c in columns else F.col(f"`{c}`")
        for c in df.columns
    ])


def _rounded_sql(sql: str, columns: dict[str, int]) -> str:
    def form(c: str, d: int) -> str:
        value = f'round("{c}" + CAST({_shift(d):.12f} AS DOUBLE), {d})'
        return f'CASE WHEN {value} = 0 THEN CAST(0 AS DOUBLE) ELSE {value} END AS "{c}"'

    parts = ", ".join(form(c, d) for c, d in columns.items())
    return f"SELECT * REPLACE ({parts}) FROM ({sql})"


def query(name: str, sql: str | None = None, digits: dict[str, int] | None = None):
    """Register a query; `digits` rounds the named double columns on both sides."""

    def register(run: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is already registered")
        if digits:
            QUERIES[name] = lambda spark, folder: rounded(run(spark, folder), digits)
        else:
            QUERIES[name] = run
        if sql is not None:
            SQL[name] = _rounded_sql(sql, digits) if digits else sql
        return run

    return register


def six(*names: str) -> dict[str, int]:
    return dict.fromkeys(names, 6)
