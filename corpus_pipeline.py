"""From raw documents to packed training sequences, in stages that each write what the next reads.

Documents are dropped by id: rows that share an id stay if any of them is accepted, and rows
without an id count as one such group in the classifier's stage and always stay in the
deduplication.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import table
from tidemark.llm.packing import pack
from tidemark.llm.quality_classifier import classify
from tidemark.llm.quality_rules import accepted
from tidemark.llm.simhash import simhash_groups
from tidemark.session import scratch_path, stored


def _without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows whose id is not in `ids` (id), which moves only if it is small."""
    gone = ids.select(F.col("id").alias("__gone"))
    return docs.join(gone, F.col("doc_id").eqNullSafe(F.col("__gone")), "left_anti")


def keep_by_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; source and language are host and path."""
    judged = classify(docs, table(spark, sf_dir, "labels"), F.col("source"), F.col("lang"))
    by_id = judged.groupBy(F.col("doc_id").alias("id")).agg(F.max("accepted").alias("accepted"))
    return _without(docs, stored(by_id.where("NOT accepted").select("id")))


def keep_by_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that every rule of the current policy accepts."""
    return accepted(docs)


def keep_one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each SimHash component the document with the smallest id; of its repeated rows one."""
    groups = stored(simhash_groups(docs, size=4, distance=4).where("id IS NOT NULL"))
    kept = _without(docs, stored(groups.where("id <> component").select("id").distinct()))
    repeated = stored(groups.groupBy("id").count().where("count > 1").select("id"))
    if repeated.isEmpty():
        return kept
    several = kept.join(repeated.withColumnRenamed("id", "__id"), F.col("doc_id") == F.col("__id"), "left_semi")
    return _without(kept, repeated).unionByName(several.dropDuplicates(["doc_id"]))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, placed in sequences of 2048 tokens."""
    return pack(docs, capacity=2048)


STAGES = [
    ("quality classifier", keep_by_classifier),
    ("quality rules", keep_by_rules),
    ("simhash near-dedup", keep_one_of_near_duplicates),
    ("best-fit packing", pack_sequences),
]

# A trained classifier and a genetic packing have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to the documents; each result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        path = scratch_path(spark, f"stage-{number}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
