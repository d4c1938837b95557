"""The queries of the corpus operators and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sightline.llm import (
    block_labeller,
    jaccard_join,
    multi_index,
    oracle,
    packing,
    quality_classifier,
    quality_rules,
    sharding,
    spelling,
    suffix_dedup,
    tiled_cosine,
    toxicity,
    whitening,
    word_table,
)
from sightline.llm.common import table
from sightline.session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return function(configure(spark), folder)

    QUERIES[function.__name__] = run
    return run


@query
def op3_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.judge(table(spark, folder, "documents"))


ORACLES["op3_quality_rules"] = oracle.QUALITY


@query
def op1_sharding(spark: SparkSession, folder: str) -> DataFrame:
    placed = sharding.assign(table(spark, folder, "documents"))
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query
def op4_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"))


@query
def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.judge(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query
def op8_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join.link(table(spark, folder, "documents"))


@query
def op7_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.remove(table(spark, folder, "documents"))


@query
def op5_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return quality_classifier.judge(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query
def op6_word_table(spark: SparkSession, folder: str) -> DataFrame:
    coded = word_table.coded(table(spark, folder, "documents"))
    return coded.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids_text", 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"),
    )


@query
def op2_multi_index(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    return multi_index.search(vectors, vectors.where(F.col("vec_id") % 20 == 0))


@query
def op9_block_labeller(spark: SparkSession, folder: str) -> DataFrame:
    return block_labeller.extract(table(spark, folder, "pages"))


@query
def op11_tiled_cosine(spark: SparkSession, folder: str) -> DataFrame:
    return tiled_cosine.link(table(spark, folder, "embeddings"))


@query
def op12_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.variants(table(spark, folder, "documents"))


ORACLES["op12_spelling_variants"] = oracle.SPELLING


@query
def op13_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whiten(table(spark, folder, "embeddings"))
