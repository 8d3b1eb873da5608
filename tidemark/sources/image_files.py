"""Catalogue of volume image files and their label files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.splitting import sample_rows

# What an image file name starts with and contains; what marks training folders.
PREFIX = "BRATS"
KIND = "nii"
TRAINING = "Tr"


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """(path, length) of the files directly in a folder; contents are not read."""
    return spark.read.format("binaryFile").load(folder).select("path", "length")


def file_catalog(images: DataFrame, labels: DataFrame | None = None, sample_size: int | None = None,
                 seed: int = 42) -> DataFrame:
    """(id, name, image_path, length, label_path) from listings of an image and a label folder."""
    name = F.substring_index("path", "/", -1)
    files = images.select(F.col("path").alias("image_path"), "length", name.alias("name")).where(
        F.col("name").startswith(PREFIX) & F.col("name").contains(KIND))
    second = F.get(F.split("name", "_"), F.lit(1))
    files = files.withColumn("id", F.substring_index(second, ".", 1))
    if sample_size is not None:
        files = sample_rows(files, ["name"], sample_size, seed)
    if labels is None:
        return files.select("id", "name", "image_path", "length", F.lit(None).cast("string").alias("label_path"))
    pairs = labels.select(name.alias("name"), F.col("path").alias("label_path"))
    return files.join(pairs, "name", "left").select("id", "name", "image_path", "length", "label_path")


def task_catalog(spark: SparkSession, task_path: str, image_dir: str = "imagesTr/",
                 label_dir: str = "labelsTr/", sample_size: int | None = None, seed: int = 42) -> DataFrame:
    """Catalogue of a task folder; labels belong to training image folders only."""
    root = task_path.rstrip("/")
    labels = list_files(spark, f"{root}/{label_dir}") if TRAINING in image_dir else None
    return file_catalog(list_files(spark, f"{root}/{image_dir}"), labels, sample_size, seed)
