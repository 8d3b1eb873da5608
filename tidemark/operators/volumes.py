"""Voxel tables: (subject, modality, x, y, z, value, label)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def volume_slice(voxels: DataFrame, modality: int, axis: str, position: int) -> DataFrame:
    """One plane of one modality: the voxels with x, y or z fixed."""
    if axis not in ("x", "y", "z"):
        raise ValueError(f"axis must be x, y or z, not {axis!r}")
    return voxels.where((F.col("modality") == modality) & (F.col(axis) == position))


def dice(rows: DataFrame, truth: str, predicted: str, keys: list[str]) -> DataFrame:
    """Twice the overlap of two masks over the sum of their sizes, per group."""
    both = F.sum(F.when((F.col(truth) == 1) & (F.col(predicted) == 1), 1).otherwise(0))
    sizes = F.sum((F.col(truth) == 1).cast("int")) + F.sum((F.col(predicted) == 1).cast("int"))
    return rows.groupBy(*keys).agg(F.try_divide(F.lit(2.0) * both, sizes.cast("double")).alias("dice"))
