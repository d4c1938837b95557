"""Text and Parquet scans with declared schemas."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sightline import schemas
from sightline.functions.net import cidr_range
from sightline.functions.values import int_or_null, strip


def read_csv(
    spark: SparkSession, path: str, schema: StructType, header: bool = False
) -> DataFrame:
    """CSV under a declared schema; blank lines are skipped by the scan."""
    return spark.read.schema(schema).option("header", header).csv(path)


def read_text_table(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header row, every column a string."""
    return spark.read.option("header", True).option("inferSchema", False).csv(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def typed_sightings(text: DataFrame) -> DataFrame:
    """Give a table of sightings in text form its declared types.

    A cell that is not a number becomes null; the row stays.
    """
    columns = []
    for field in schemas.SIGHTINGS:
        source = F.col(field.name)
        if field.name in ("first_seen", "last_seen"):
            # Times may be written as '1488326400' or '1488326400.0'.
            whole = source.try_cast("long")
            source = F.coalesce(whole, source.try_cast("double").try_cast("long"))
        else:
            source = source.try_cast(field.dataType)
        columns.append(source.alias(field.name))
    return text.select(*columns)


def read_sightings(spark: SparkSession, path: str, header: bool = False) -> DataFrame:
    return typed_sightings(read_csv(spark, path, schemas.SIGHTINGS_TEXT, header))


def read_locations(spark: SparkSession, path: str) -> DataFrame:
    """Country locations: CSV with header, ids as numbers."""
    text = read_text_table(spark, path)
    return text.select(
        *[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schemas.LOCATIONS]
    )


def blocks_from_cidr(cidr: DataFrame) -> DataFrame:
    """Turn ``network`` text into ``start``/``stop`` and a block id.

    The id packs start and prefix length, so it is fixed by the block itself:
    no counter runs over the table, and a rebuild gives the same ids.
    """
    start, stop, length = cidr_range("network")
    return cidr.select(
        (start * 64 + length).cast("long").alias("block_id"),
        start.cast("long").alias("start"),
        stop.cast("long").alias("stop"),
        int_or_null("geoname_id").alias("geoname_id"),
        int_or_null("registered_country_geoname_id").alias("registered_country_geoname_id"),
    )


def read_ip_blocks(spark: SparkSession, path: str) -> DataFrame:
    return blocks_from_cidr(read_text_table(spark, path))


def read_ip_ranges(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, schemas.IP_RANGES, header=True)


def read_hosts(spark: SparkSession, path: str) -> DataFrame:
    """First column of a host list, stripped."""
    rows = read_csv(spark, path, StructType.fromDDL("host string"))
    return rows.select(strip("host").alias("host"))


def read_baskets(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """Text file with one basket per line to arrays of distinct items.

    A quoted item may hold the separator, outer spaces, and quotes written twice.
    """
    lines = spark.read.text(path).where(F.length(F.trim("value")) > 0)
    end = f"(?:{re.escape(sep)}|\\z)"
    quoted = '"[^"]*+(?:""[^"]*+)*+"'
    found = F.regexp_extract_all("value", F.lit(f"(?s) *({quoted}(?= *{end})|.*?) *{end}"), F.lit(1))

    def plain(item: Column) -> Column:
        inner = F.replace(F.substring(item, F.lit(2), F.length(item) - 2), F.lit('""'), F.lit('"'))
        return F.when(item.rlike(f"^{quoted}\\z"), inner).otherwise(item)

    items = F.transform(found, plain)
    return lines.select(F.array_distinct(F.filter(items, lambda i: i != "")).alias("items"))
