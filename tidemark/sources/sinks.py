"""Writers: series as CSV, and split tables partitioned by their split."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .tables import read_csv_lines


def write_timeseries_csv(series: DataFrame, path: str) -> None:
    """A series as CSV; the calendar bin is an ordinary column."""
    series.write.option("header", True).option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").csv(path)


def read_timeseries_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return read_csv_lines(spark, path, schema)


def write_parquet(series: DataFrame, path: str, partition_by: str | None = None) -> None:
    writer = series.write
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)


def write_split(labelled: DataFrame, path: str, split_column: str = "split") -> None:
    """Train and test rows below one path, one folder per split."""
    write_parquet(labelled, path, split_column)
