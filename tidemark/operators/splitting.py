"""Repeatable random splits and samples with exact sizes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .ranking import lowest_by_hash


def train_test_split(df: DataFrame, id_columns: Sequence[str], stratify_on: Sequence[str] = (),
                     train_size: float = 0.8, seed: int = 0) -> DataFrame:
    """Add column `split` ('train' or 'test'): exactly round(train_size * n) train rows per
    stratum, chosen by a seeded hash of the row id, so a rerun gives the same split."""
    strata = [F.coalesce(F.col(c).cast("string"), F.lit("None")) for c in stratify_on]
    keyed = df.withColumn("__stratum", F.concat_ws("_", *strata) if strata else F.lit(""))
    quota = F.bround(F.col("n") * F.lit(train_size), 0)
    chosen = lowest_by_hash(keyed, ["__stratum"], id_columns, seed, quota, "__train")
    return chosen.select(*df.columns, F.when(F.col("__train"), "train").otherwise("test").alias("split"))


def sample_rows(df: DataFrame, id_columns: Sequence[str], n: int, seed: int = 42) -> DataFrame:
    """n rows in a seeded random order. The top-n runs per partition before it is merged."""
    ordering = F.xxhash64(*[F.col(c) for c in id_columns], F.lit(seed))
    return df.orderBy(ordering, *id_columns).limit(n)


def sample_per_label(df: DataFrame, label: str, id_columns: Sequence[str], n: int = 4, seed: int = 0) -> DataFrame:
    """n random rows per label without replacement. Spark keeps only the n best rows of a label
    in each partition before the shuffle."""
    ordering = [F.xxhash64(*[F.col(c) for c in id_columns], F.lit(seed)), *[F.col(c) for c in id_columns]]
    ranked = df.withColumn("__rank", F.row_number().over(Window.partitionBy(label).orderBy(*ordering)))
    return ranked.where(F.col("__rank") <= n).drop("__rank")
