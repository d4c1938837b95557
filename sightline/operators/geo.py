"""Address-range lookups and geo enrichment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sightline.functions.net import ip_to_long, is_ip
from sightline.functions.values import elapsed, strip
from sightline.operators.labels import score_directions
from sightline.operators.skew import lookup_join
from sightline.session import cut

UNKNOWN = "Unknown"

# Bucket widths, as powers of two. A range is filed at the finest width at
# which it touches at most _SPAN buckets, a range wider than that at the widest.
_SHIFTS = [0, 4, 8, 12, 16]
_SPAN = 16


def _range_buckets() -> Column:
    """(width, bucket) pairs a range is filed under."""
    start, stop = F.col("start"), F.col("stop")

    def pairs(shift: int) -> Column:
        buckets = F.sequence(F.shiftright(start, shift), F.shiftright(stop, shift))
        return F.transform(
            buckets, lambda b: F.struct(F.lit(shift).alias("w"), b.alias("b"))
        )

    def touched(shift: int) -> Column:
        return F.shiftright(stop, shift) - F.shiftright(start, shift) + 1

    filed = F.when(touched(_SHIFTS[0]) <= _SPAN, pairs(_SHIFTS[0]))
    for shift in _SHIFTS[1:-1]:
        filed = filed.when(touched(shift) <= _SPAN, pairs(shift))
    return filed.otherwise(pairs(_SHIFTS[-1]))


def _point_buckets(number: Column, spread: Column) -> Column:
    """The buckets an address can be filed under, one per width.

    What is no address keeps its row under a bucket no range has. Those rows
    are spread by ``spread``, as a null key would send all of them to one task.
    """
    pairs = F.array(
        *[
            F.struct(F.lit(s).alias("w"), F.shiftright(number, s).alias("b"))
            for s in _SHIFTS
        ]
    )
    nowhere = F.array(F.struct(F.lit(-1).alias("w"), F.xxhash64(spread).alias("b")))
    return F.when(number.isNotNull(), pairs).otherwise(nowhere)


def range_lookup(
    points: DataFrame, ranges: DataFrame, key: str, number: str, values: list[str]
) -> DataFrame:
    """Left join of addresses to the ranges that hold them, first range only.

    An equi-join on (width, bucket) with the range as residual: no nested
    loop, and a bucket holds few ranges because narrow ranges are filed under
    narrow buckets. Of several ranges the one with the lowest start, then the
    lowest stop, is taken. ``key`` identifies a point.
    """
    filed = ranges.where(F.col("start") <= F.col("stop")).select(
        F.inline(_range_buckets()), "start", "stop", F.struct(*values).alias("_values")
    )
    probes = points.select(
        key, number, F.inline(_point_buckets(F.col(number), F.col(key)))
    )
    within = (F.col(number) >= F.col("start")) & (F.col(number) <= F.col("stop"))
    same = (probes["w"] == filed["w"]) & (probes["b"] == filed["b"])
    joined = probes.join(filed, same & within, "left")
    hit = F.when(F.col("start").isNotNull(), F.struct("start", "stop", "_values"))
    return (
        joined.groupBy(key)
        .agg(F.min(hit)["_values"].alias("_values"))
        .select(key, *[F.col("_values")[v].alias(v) for v in values])
    )


def geo_export(blocks: DataFrame, locations: DataFrame) -> DataFrame:
    """Flat range dimension; blocks without a location drop out."""
    return blocks.join(locations, "geoname_id").select(
        "start", "stop", "continent_code", "continent_name", "country_iso_code", "country_name"
    )


def host_locations(sightings: DataFrame, ranges: DataFrame) -> DataFrame:
    """Continent and country of every distinct host; names and gaps are Unknown."""
    points = sightings.select("data").distinct().withColumn("_ip", ip_to_long("data"))
    found = range_lookup(points, ranges, "data", "_ip", ["continent_name", "country_name"])
    return found.select(
        "data",
        F.coalesce("continent_name", F.lit(UNKNOWN)).alias("continent"),
        F.coalesce("country_name", F.lit(UNKNOWN)).alias("country"),
    )


def ip_block_lookup(hosts: DataFrame, blocks: DataFrame, host: str = "host") -> DataFrame:
    """Block id of every address in a host list that lies in a block."""
    addresses = (
        hosts.select(strip(host).alias("ip_addr")).where(is_ip("ip_addr")).distinct()
    )
    points = addresses.withColumn("_ip", ip_to_long("ip_addr"))
    found = range_lookup(points, blocks, "ip_addr", "_ip", ["block_id"])
    return found.where(F.col("block_id").isNotNull())


def combine_locations(sightings: DataFrame, located: DataFrame) -> DataFrame:
    """Sightings with the location of their host."""
    return lookup_join(sightings, located, "data")


def feature_enrich(sightings: DataFrame, ranges: DataFrame) -> DataFrame:
    """Every sighting with location, score direction and elapsed time.

    Both dimensions have one row per host, so they are joined to each other
    first and the sightings are shuffled by host once. Hosts are gathered and
    counted in one pass and written.
    """
    hosts = cut(score_directions(sightings, F.count("*").alias("_rows")))
    most = hosts.agg(F.max("_rows")).first()[0] or 0
    per_host = host_locations(hosts, ranges).join(hosts.drop("_rows"), "data")
    return lookup_join(sightings, per_host, "data", at_most=most).withColumn(
        "elapsed", elapsed("first_seen", "last_seen")
    )
