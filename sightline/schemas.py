"""Declared schemas of every table the library reads or writes."""

from __future__ import annotations

from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

_KINDS = {
    "string": StringType(),
    "double": DoubleType(),
    "long": LongType(),
    "int": IntegerType(),
}


def _schema(**columns: str) -> StructType:
    return StructType([StructField(n, _KINDS[k], True) for n, k in columns.items()])


# One row per observation: a customer sensor saw an IP or host.
SIGHTINGS = _schema(
    record_id="string",
    report_date="string",
    anonymous_id="string",
    sector="string",
    size="string",
    data="string",
    count_seen="double",
    first_seen="long",
    last_seen="long",
    threat_score="double",
    estimate="string",
)

# The same row as it lies in text files, where the times are text.
SIGHTINGS_TEXT = _schema(
    record_id="string",
    report_date="string",
    anonymous_id="string",
    sector="string",
    size="string",
    data="string",
    count_seen="string",
    first_seen="string",
    last_seen="string",
    threat_score="string",
    estimate="string",
)

SIGHTING_HEADERS = SIGHTINGS.fieldNames()

ENRICHED = _schema(
    record_id="string",
    report_date="string",
    anonymous_id="string",
    sector="string",
    size="string",
    count_seen="double",
    first_seen="long",
    last_seen="long",
    threat_score="double",
    estimate="string",
    data="string",
    continent="string",
    country="string",
    score_direction="string",
    elapsed="long",
)

# Fixed columns of the per-IP feature table; one count column per customer follows.
IP_FEATURES = _schema(
    ip="string",
    maxScore="double",
    minScore="double",
    avgScore="double",
    lastScore="double",
    trendUp="double",
    trendDown="double",
    trueCount="double",
    dataSetCount="long",
    mostCommonCustomerHit="string",
    totalCustomersHit="long",
)

VERTICES = _schema(id="string", label="string", data="string")
EDGES = _schema(src="string", dst="string", weight="double")

CIDR_BLOCKS = _schema(
    network="string", geoname_id="string", registered_country_geoname_id="string"
)
IP_BLOCKS = _schema(
    block_id="long",
    start="long",
    stop="long",
    geoname_id="int",
    registered_country_geoname_id="int",
)
LOCATIONS = _schema(
    geoname_id="int",
    locale_code="string",
    continent_code="string",
    continent_name="string",
    country_iso_code="string",
    country_name="string",
)
IP_RANGES = _schema(
    start="long",
    stop="long",
    continent_code="string",
    continent_name="string",
    country_iso_code="string",
    country_name="string",
)
HOST_GEO = _schema(data="string", continent="string", country="string")
SCORE_LABELS = _schema(score_label="string", count_seen="double", country="string")
SCORE_DIRECTIONS = _schema(data="string", score_direction="string")
ELAPSED = _schema(record_id="string", dt="long")
