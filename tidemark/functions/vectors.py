"""Distances and products of two array<double> columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .columns import as_column


def doubles(c: Column | str) -> Column:
    return as_column(c).cast("array<double>")


def complete(c: Column | str) -> Column:
    """True for a vector that is there and has no NULL or NaN element."""
    return F.coalesce(F.forall(doubles(c), lambda x: x.isNotNull() & ~F.isnan(x)), F.lit(False))


def whole(c: Column | str) -> Column:
    """The vector as doubles; NULL if it isn't complete."""
    return F.when(complete(c), doubles(c))


def _total(c: Column) -> Column:
    return F.aggregate(c, F.lit(0.0), lambda acc, v: acc + v)


def dot(x: Column | str, y: Column | str) -> Column:
    return _total(F.zip_with(doubles(x), doubles(y), lambda a, b: a * b))


def norm(x: Column | str) -> Column:
    return F.sqrt(_total(F.transform(doubles(x), lambda a: a * a)))


def euclidean(x: Column | str, y: Column | str) -> Column:
    return F.sqrt(_total(F.zip_with(doubles(x), doubles(y), lambda a, b: (a - b) * (a - b))))


def manhattan(x: Column | str, y: Column | str) -> Column:
    return _total(F.zip_with(doubles(x), doubles(y), lambda a, b: F.abs(a - b)))


def cosine_similarity(x: Column | str, y: Column | str) -> Column:
    """Dot product over norms; NULL where a norm is zero."""
    return F.try_divide(dot(x, y), norm(x) * norm(y))


def cosine_dissimilarity(x: Column | str, y: Column | str) -> Column:
    return F.lit(1.0) - cosine_similarity(x, y)


DISTANCES = {
    "euclidean": euclidean,
    "manhattan": manhattan,
    "cosine_dissimilarity": cosine_dissimilarity,
}


def distance_builder(name: str):
    if name not in DISTANCES:
        raise ValueError(f"unknown distance: {name}")
    return DISTANCES[name]
