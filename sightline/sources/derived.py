"""Sighting, geo, graph and series views over star-schema tables.

Each view is a plain projection or equi-join over whole tables, so the work
of every query grows with them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sightline.functions.values import epoch_seconds
from sightline.sources.readers import blocks_from_cidr

# Sector of a customer by its number modulo 7, size modulo 3.
SECTORS = [
    "IT & Svcs",
    "healthcare",
    "govt services",
    "government",
    "IT",
    "cybersecurity",
    "retail",
]
SIZES = ["small", "medium", "large"]
CUSTOMERS = 86


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _text(value):
    return F.col(value).cast("string") if isinstance(value, str) else value.cast("string")


def _pick(number, names):
    return F.get(F.array(*[F.lit(n) for n in names]), (number % len(names)).cast("int"))


def sightings(spark: SparkSession, folder: str) -> DataFrame:
    """One sighting per line item, dated by its order."""
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        "l_quantity",
        "l_discount",
        "l_shipdate",
    )
    orders = table(spark, folder, "orders").select(
        "o_orderkey", "o_orderdate", "o_orderpriority"
    )
    part = F.col("l_partkey")
    customer = F.col("l_suppkey") % CUSTOMERS
    host = F.concat(
        F.lit("h"), _text(part), F.lit(".n"), _text(part % 50),
        F.lit(".site"), _text(part % 21), F.lit(".com"),
    )
    address = F.concat_ws(
        ".", _text(part % 223 + 1), _text(part % 251), _text(part % 241), _text(part % 239)
    )
    shipped, ordered = F.col("l_shipdate"), F.col("o_orderdate")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.concat_ws("-", _text("l_orderkey"), _text("l_linenumber")).alias("record_id"),
        F.lit("2001-12-31").alias("report_date"),
        F.concat(F.lit("cust_"), F.lpad(_text(customer), 2, "0")).alias("anonymous_id"),
        _pick(customer, SECTORS).alias("sector"),
        _pick(customer, SIZES).alias("size"),
        F.when(part % 4 == 0, host).otherwise(address).alias("data"),
        (F.col("l_quantity") * F.col("l_linenumber")).alias("count_seen"),
        epoch_seconds(F.least(shipped, ordered)).alias("first_seen"),
        epoch_seconds(F.greatest(shipped, ordered)).alias("last_seen"),
        F.least(F.round(F.col("l_discount") * 100), F.lit(9.0)).alias("threat_score"),
        F.col("o_orderpriority").alias("estimate"),
    )


def cidr_blocks(spark: SparkSession, folder: str) -> DataFrame:
    """Eight /8 networks per nation, every ninth first octet left free."""
    nation = table(spark, folder, "nation").select("n_nationkey")
    numbers = F.explode(F.sequence(F.lit(0), F.lit(7))).alias("k")
    return nation.select("n_nationkey", numbers).select(
        F.concat(_text(1 + 9 * F.col("n_nationkey") + F.col("k")), F.lit(".0.0.0/8")).alias(
            "network"
        ),
        _text("n_nationkey").alias("geoname_id"),
        _text("n_nationkey").alias("registered_country_geoname_id"),
    )


def ip_blocks(spark: SparkSession, folder: str) -> DataFrame:
    return blocks_from_cidr(cidr_blocks(spark, folder))


def locations(spark: SparkSession, folder: str) -> DataFrame:
    nation = table(spark, folder, "nation")
    region = table(spark, folder, "region")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").cast("int").alias("geoname_id"),
        F.lit("en").alias("locale_code"),
        _text("r_regionkey").alias("continent_code"),
        F.col("r_name").alias("continent_name"),
        _text("n_nationkey").alias("country_iso_code"),
        F.col("n_name").alias("country_name"),
    )


def link_edges(spark: SparkSession, folder: str) -> DataFrame:
    """Directed, non-bipartite graph: supplier number to part number, one id space.

    Numbers that are both kinds have edges in both directions, so there are
    cycles, triangles and more than one strongly connected component.
    """
    lines = table(spark, folder, "lineitem").select(
        F.col("l_suppkey").alias("src"), F.col("l_partkey").alias("dst")
    )
    return lines.where(F.col("src") != F.col("dst")).distinct()


def link_vertices(edges: DataFrame) -> DataFrame:
    ends = F.explode(F.array("src", "dst")).alias("id")
    return edges.select(ends).distinct()


def series_hour(spark: SparkSession, folder: str) -> DataFrame:
    """Events counted per hour."""
    return (
        table(spark, folder, "events")
        .groupBy((F.floor(epoch_seconds("ts") / 3600) * 3600).cast("long").alias("ts"))
        .agg(F.count("*").alias("n"))
    )
