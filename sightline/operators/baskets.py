"""Baskets of items from sightings and feature rows, and their summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sightline.functions.scoring import (
    count_bin,
    last_score_item,
    size_item,
    threat_item,
    threat_item_split,
)


def sighting_items(sightings: DataFrame, split_six: bool = False) -> DataFrame:
    """Four categorical items per sighting: sector, size, count bin, threat level."""
    threat = threat_item_split if split_six else threat_item
    return sightings.select(
        "sector",
        size_item("size").alias("size"),
        count_bin("count_seen").alias("count"),
        threat("threat_score").alias("score"),
    )


def sighting_baskets(sightings: DataFrame, split_six: bool = False) -> DataFrame:
    items = F.array_compact(F.array("sector", "size", "count", "score"))
    return sighting_items(sightings, split_six).select(items.alias("items"))


def baskets_from_features(
    features: DataFrame, customers: list[str], score: str = "lastScore"
) -> DataFrame:
    """Label item plus the customers whose count is positive, from a wide table."""

    def item(customer: str) -> Column:
        count = F.col(customer).cast("string").try_cast("double").cast("long")
        return F.when(count > 0, F.lit(customer))

    present = F.array_compact(F.array(last_score_item(score), *[item(c) for c in customers]))
    return features.select("ip", present.alias("items"))


def customer_baskets(counts: DataFrame, last_scores: DataFrame) -> DataFrame:
    """The same baskets from the long form; bounded by the number of customers."""
    gathered = counts.groupBy("ip").agg(F.collect_set("anonymous_id").alias("c"))
    label = F.array_compact(F.array(last_score_item("lastScore")))
    items = F.array_sort(F.concat(label, F.col("c")))
    return gathered.join(last_scores.select("ip", "lastScore"), "ip").select(
        "ip", items.alias("items")
    )


def item_frequency(baskets: DataFrame, support: float | None = None, top: int | None = None) -> DataFrame:
    """Share of baskets that hold each item, over a threshold or the first few."""
    total = baskets.agg(F.count("*").alias("n")).scalar()
    counted = (
        baskets.select(F.explode(F.array_distinct("items")).alias("item"))
        .groupBy("item")
        .agg(F.count("*").alias("n"))
        .withColumn("support", F.col("n") / total)
    )
    if support is not None:
        counted = counted.where(F.col("support") >= support)
    if top is not None:
        counted = counted.orderBy(F.col("n").desc(), "item").limit(top)
    return counted


def basket_summary(baskets: DataFrame) -> DataFrame:
    """Baskets, distinct items, density and the spread of basket sizes, one row."""
    sizes = (
        baskets.select(F.size("items").cast("long").alias("size"))
        .groupBy("size")
        .agg(F.count("*").alias("w"))
    )
    n_items = (
        baskets.select(F.explode("items").alias("item"))
        .distinct()
        .agg(F.count("*").alias("n_items"))
        .scalar()
    )
    rows, cells = F.sum("w"), F.sum(F.col("size") * F.col("w"))
    # There are no more distinct sizes than items, so the exact median is cheap.
    return sizes.agg(
        rows.alias("n_baskets"),
        cells.alias("n_cells"),
        F.min("size").alias("min_size"),
        F.percentile("size", F.lit(0.5), F.col("w")).alias("median_size"),
        (cells / rows).alias("mean_size"),
        F.max("size").alias("max_size"),
    ).select(
        "n_baskets",
        n_items.alias("n_items"),
        (F.col("n_cells") / (F.col("n_baskets") * n_items)).alias("density"),
        "min_size",
        "median_size",
        "mean_size",
        "max_size",
    )


def basket_sizes(baskets: DataFrame) -> DataFrame:
    return baskets.groupBy(F.size("items").alias("size")).agg(F.count("*").alias("n"))
