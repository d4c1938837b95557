"""From documents to packed training sequences, one operator for each stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sightline.llm import jaccard_join, packing, quality_rules, suffix_dedup, toxicity
from sightline.llm.common import table
from sightline.session import configure, cut

# Bytes of rows that a task hands to Python at once, so that its memory does not follow the splits of the tables.
BATCH_BYTES = "2m"


def _in_small_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the adaptive rules keep."""
    return quality_rules.keep(docs)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents under the toxicity threshold."""
    _in_small_batches(spark)
    return toxicity.keep(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar ones."""
    _in_small_batches(spark)
    return jaccard_join.thin(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that occur elsewhere too."""
    _in_small_batches(spark)
    return suffix_dedup.trimmed(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their places in sequences."""
    _in_small_batches(spark)
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality),
    ("toxicity", clean),
    ("jaccard_join", near_duplicates),
    ("suffix_dedup", repeated_passages),
    ("packing", packed),
]

# Tokenizing and the classifier are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written and read again before the next."""
    docs = table(configure(spark), sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
