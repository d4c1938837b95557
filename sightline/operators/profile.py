"""Per-IP profiles and per-customer count features."""

from __future__ import annotations

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sightline.functions.values import packed, with_score_order
from sightline.session import cut

# Beyond this many customers the wide table stops being a table; use the sparse or long form.
MAX_CUSTOMER_COLUMNS = 10_000


def customer_list(sightings: DataFrame) -> DataFrame:
    """Customers with their row counts, by id."""
    return sightings.groupBy("anonymous_id").agg(F.count("*").alias("n")).orderBy("anonymous_id")


def customer_ids(sightings: DataFrame, limit: int = MAX_CUSTOMER_COLUMNS) -> list[str]:
    """Sorted customer ids on the driver, to name the columns of the wide table."""
    ids = sightings.select("anonymous_id").where(F.col("anonymous_id").isNotNull()).distinct()
    found = [row[0] for row in ids.limit(limit + 1).collect()]
    if len(found) > limit:
        raise ValueError(f"more than {limit} customers: use ip_features_sparse or customer_counts")
    return sorted(found)


def customer_index(sightings: DataFrame) -> DataFrame:
    """Customers numbered from 0 in the order of their ids: (anonymous_id, customer).

    The ids are range-partitioned and sorted, numbered inside each part, and
    shifted by the sizes of the parts before it, so no task sees all of them.
    The numbers are a written table: every use reads the same ones, and joins
    know its size.
    """
    ids = sightings.select("anonymous_id").where(F.col("anonymous_id").isNotNull()).distinct()
    placed = cut(ids.orderBy("anonymous_id").withColumn("part", F.spark_partition_id()))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("part").agg(F.count("*").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")
    )
    inside = F.row_number().over(Window.partitionBy("part").orderBy("anonymous_id"))
    numbered = placed.withColumn("inside", inside).join(F.broadcast(starts), "part")
    return cut(numbered.select("anonymous_id", (F.col("start") + F.col("inside") - 1).alias("customer")))


def customer_counts(sightings: DataFrame) -> DataFrame:
    """Long form of the count columns: one row per IP and customer that saw it."""
    return sightings.groupBy(F.col("data").alias("ip"), "anonymous_id").agg(
        F.count("*").alias("n")
    )


def _pair_partials(sightings: DataFrame) -> DataFrame:
    """Mergeable figures per (IP, customer).

    An IP that holds a large share of all rows is spread over its customers
    here, and what is left of it for the merge is one row per customer. All
    buffers have a fixed width, so the rows are hashed and never sorted.
    """
    ordered = with_score_order(sightings, "threat_score", "_order")
    # Rows without a time or a score have no key, so extremes ignore them.
    moments = ordered.withColumns(
        {"_first": packed("first_seen", "_order"), "_last": packed("last_seen", "_order")}
    )
    return moments.groupBy(F.col("data").alias("ip"), "anonymous_id").agg(
        F.count("*").alias("n"),
        F.max("threat_score").alias("max_score"),
        F.min("threat_score").alias("min_score"),
        F.sum("threat_score").alias("sum_score"),
        F.count("threat_score").alias("n_score"),
        F.max("count_seen").alias("max_count"),
        F.min("_first").alias("first"),
        F.min_by("threat_score", "_first").alias("first_score"),
        F.max("_last").alias("last"),
        F.max_by("threat_score", "_last").alias("last_score"),
    )


def _score_figures() -> list[Column]:
    """What the partials of an IP merge to."""
    return [
        F.max("max_score").alias("maxScore"),
        F.min("min_score").alias("minScore"),
        (F.sum("sum_score") / F.sum("n_score")).alias("avgScore"),
        F.min_by("first_score", "first").alias("firstScore"),
        F.max_by("last_score", "last").alias("lastScore"),
        F.max("max_count").alias("trueCount"),
        F.sum("n").alias("dataSetCount"),
        F.count("anonymous_id").alias("totalCustomersHit"),
    ]


def _with_trends(merged: DataFrame) -> DataFrame:
    moved = F.col("maxScore") != F.col("minScore")
    up = moved & (F.col("firstScore") < F.col("lastScore"))
    down = moved & (F.col("firstScore") > F.col("lastScore"))
    return merged.withColumns(
        {
            "trendUp": F.when(up, 1.0).otherwise(0.0),
            "trendDown": F.when(down, 1.0).otherwise(0.0),
        }
    )


def _favourite() -> Column:
    """Number of the customer with the highest count, then the smallest id; no id comes first."""
    number = F.coalesce("customer", F.lit(-1).cast("long"))
    return F.max_by(number, packed(F.col("n"), -number))


def _named(merged: DataFrame, index: DataFrame) -> DataFrame:
    """The favourite by its id instead of its number."""
    names = index.select(
        F.col("customer").alias("_favourite"), F.col("anonymous_id").alias("mostCommonCustomerHit")
    )
    return merged.join(names, "_favourite", "left").drop("_favourite")


def _scores(sightings: DataFrame) -> DataFrame:
    """One row per IP: its scores, counts and trends."""
    return _with_trends(_pair_partials(sightings).groupBy("ip").agg(*_score_figures()))


def _merged(sightings: DataFrame, index: DataFrame, entries: bool = False) -> DataFrame:
    """One row per IP, with its favourite; with ``entries``, also its customers as (customer, n) by number."""
    numbered = _pair_partials(sightings).join(index, "anonymous_id", "left")
    figures = [*_score_figures(), _favourite().alias("_favourite")]
    if entries:
        # At most one entry per customer that saw the IP.
        known = F.when(F.col("customer").isNotNull(), F.struct("customer", "n"))
        figures.append(F.array_sort(F.collect_list(known)).alias("entries"))
    return _named(_with_trends(numbered.groupBy("ip").agg(*figures)), index)


PROFILE_COLUMNS = [
    "ip",
    "maxScore",
    "minScore",
    "avgScore",
    "lastScore",
    "trendUp",
    "trendDown",
    "trueCount",
    "dataSetCount",
    "mostCommonCustomerHit",
    "totalCustomersHit",
]


def _customer_columns(numbers: dict[str, int], customers: list[str]) -> list[Column]:
    """One count column per listed customer, zero where it did not see the IP."""
    zero = F.lit(0).cast("long")
    return [
        F.coalesce(F.try_element_at("counts", F.lit(numbers.get(c, -1)).cast("long")), zero).alias(c)
        for c in customers
    ]


def ip_profile(sightings: DataFrame, index: DataFrame | None = None) -> DataFrame:
    """Score range, trend, counts and favourite customer of every IP."""
    index = customer_index(sightings) if index is None else index
    return _merged(sightings, index).select(*PROFILE_COLUMNS)


def first_last_scores(sightings: DataFrame) -> DataFrame:
    return _scores(sightings).select("ip", "firstScore", "lastScore")


def trends(sightings: DataFrame) -> DataFrame:
    return _scores(sightings).select("ip", "trendUp", "trendDown")


def most_common_customer(sightings: DataFrame) -> DataFrame:
    best = F.min(F.struct((-F.col("n")).alias("rank"), "anonymous_id"))
    return (
        customer_counts(sightings)
        .groupBy("ip")
        .agg(best.alias("best"))
        .select(
            "ip",
            F.col("best.anonymous_id").alias("mostCommonCustomerHit"),
            (-F.col("best.rank")).alias("n"),
        )
    )


def _sparse(size: int, names: list[str]) -> Column:
    """The entries of an IP as one sparse vector over all customers.

    The column declares its size, and the names of its places where they are
    given, so that assemblers need not read a row to learn them.
    """
    layout = F.struct(
        F.struct(
            F.lit(0).alias("type"),
            F.lit(size).alias("size"),
            F.transform("entries", lambda e: e["customer"].cast("int")).alias("indices"),
            F.transform("entries", lambda e: e["n"].cast("double")).alias("values"),
        ).alias("v")
    )
    attributes = {"num_attrs": size}
    if names:
        attributes = {"attrs": {"numeric": [{"idx": i, "name": n} for i, n in enumerate(names)]}, "num_attrs": size}
    vector = F.from_json(F.to_json(layout), StructType().add("v", VectorUDT()))["v"]
    return vector.alias("customerCounts", metadata={"ml_attr": attributes})


def ip_features_sparse(sightings: DataFrame, index: DataFrame | None = None) -> DataFrame:
    """The profile with the counts by customer as one sparse vector, ``customerCounts``.

    Any number of customers will do: an IP carries entries only for those that
    saw it. ``index`` numbers the places of the vector (``customer_index`` of
    these sightings by default; that of a larger table, when vectors of
    several parts have to agree). Places get the ids as names where there are
    at most ``MAX_CUSTOMER_COLUMNS``, which is all the driver ever reads.
    """
    index = customer_index(sightings) if index is None else index
    size = index.count()
    few = index.orderBy("customer").collect() if size <= MAX_CUSTOMER_COLUMNS else []
    merged = _merged(sightings, index, entries=True)
    return merged.select(*PROFILE_COLUMNS, _sparse(size, [row["anonymous_id"] for row in few]))


def _wide(
    sightings: DataFrame, customers: list[str] | None
) -> tuple[DataFrame, list[Column], list[int]]:
    """Profiles with the map of counts by customer number, the columns that read it, and their numbers."""
    index = customer_index(sightings)
    names = customer_ids(index) if customers is None else customers
    listed = index.where(F.col("anonymous_id").isin(names)).collect()
    numbers = {row["anonymous_id"]: row["customer"] for row in listed}
    merged = _merged(sightings, index, entries=True).withColumn("counts", F.map_from_entries("entries"))
    return merged, _customer_columns(numbers, names), list(numbers.values())


def ip_features_wide(sightings: DataFrame, customers: list[str] | None = None) -> DataFrame:
    """The profile with one count column per customer, on request: see ``ip_features_sparse``."""
    merged, counts, _ = _wide(sightings, customers)
    return merged.select(*PROFILE_COLUMNS, *counts)


def ip_features_flag(sightings: DataFrame, customers: list[str] | None = None) -> DataFrame:
    """Reduced variant: a flag for an average above neutral instead of the scores."""
    merged, counts, _ = _wide(sightings, customers)
    above = F.when(F.col("avgScore") > 5.0, 1.0).otherwise(0.0).alias("avgScore > 5")
    return merged.select(
        "ip",
        above,
        "trendUp",
        "trendDown",
        "trueCount",
        "mostCommonCustomerHit",
        "totalCustomersHit",
        *counts,
    )


def ip_profile_full(sightings: DataFrame, customers: list[str] | None = None) -> DataFrame:
    """Variant without the last score, counting only the listed customers as hits."""
    merged, counts, numbers = _wide(sightings, customers)
    listed = F.array(*[F.lit(n) for n in numbers]).cast("array<bigint>")
    hits = F.size(F.array_intersect(F.map_keys("counts"), listed))
    return merged.select(
        "ip",
        "maxScore",
        "minScore",
        "avgScore",
        "trendUp",
        "trendDown",
        F.col("trueCount").alias("maxCount"),
        "dataSetCount",
        "mostCommonCustomerHit",
        hits.cast("long").alias("totalCustomersHit"),
        *counts,
    )


def ip_counts(sightings: DataFrame) -> DataFrame:
    return sightings.groupBy(F.col("data").alias("ip")).agg(F.count("*").alias("n"))


def single_ip(sightings: DataFrame, ip: str) -> DataFrame:
    """All sightings of one IP, filtered at the scan."""
    return sightings.where(F.col("data") == ip)
