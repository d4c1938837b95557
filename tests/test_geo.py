import random

from pyspark.sql import functions as F

from sightline.operators import geo
from sightline.sources.readers import blocks_from_cidr
from tests.conftest import sightings, values


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def text(number):
    return ".".join(str(number >> s & 255) for s in (24, 16, 8, 0))


def test_blocks_keep_null_ids(spark):
    cidr = spark.createDataFrame(
        [("10.0.0.0/8", "7", ""), ("1.2.3.4/32", "", "x")],
        "network string, geoname_id string, registered_country_geoname_id string",
    )
    got = values(blocks_from_cidr(cidr), "start", "stop", "geoname_id", "registered_country_geoname_id")
    assert got == [(167772160, 184549375, 7, None), (16909060, 16909060, None, None)]
    assert blocks_from_cidr(cidr).select("block_id").distinct().count() == 2


def test_range_lookup_matches_a_scan_of_all_ranges(spark):
    """Wide, narrow, nested, adjacent, unaligned and catch-all ranges."""
    rng = random.Random(5)
    ranges = [(0, 2**32 - 1), (10 << 24, (11 << 24) - 1), (10 << 24, (10 << 24) + 255)]
    ranges += [(2**31 - 1000, 2**31 + 1000), (77, 77), (78, 80), (0, 15), (15, 16)]
    for _ in range(300):
        start = rng.randrange(2**32)
        ranges.append((start, min(2**32 - 1, start + rng.randrange(2 ** rng.randrange(1, 24)))))
    numbers = [0, 15, 16, 77, 78, 81, 10 << 24, 2**31, 2**32 - 1]
    numbers += [rng.randrange(2**32) for _ in range(300)]
    numbers += [rng.choice(r) for r in ranges]
    numbers = sorted(set(numbers))
    for first in (0, 1):  # with the catch-all range and without
        used = ranges[first:]
        frame = spark.createDataFrame([(a, b, i) for i, (a, b) in enumerate(used)], "start long, stop long, v int")
        points = spark.createDataFrame([(text(n), n) for n in numbers] + [("name", None), (None, None)], "k string, n long")
        found = geo.range_lookup(points, frame, "k", "n", ["start", "stop"])
        got = {r["k"]: (r["start"], r["stop"]) for r in found.collect()}
        assert len(got) == len(numbers) + 2 and got["name"] == (None, None) == got[None]
        for n in numbers:
            want = min(((a, b) for a, b in used if a <= n <= b), default=(None, None))
            assert got[text(n)] == want, n
    shown = plan(geo.range_lookup(points, frame, "k", "n", ["v"]))
    assert "NestedLoop" not in shown and "Cartesian" not in shown


def test_hosts_without_a_range_are_unknown(spark):
    ranges = spark.createDataFrame(
        [(16909056, 16909311, "EU", "Europe", "FR", "France")],
        "start long, stop long, continent_code string, continent_name string, country_iso_code string, country_name string",
    )
    rows = sightings(spark, *[{"data": d} for d in ("1.2.3.4", "9.9.9.9", "a.b.com", None, "999.1.1.1")])
    assert values(geo.host_locations(rows, ranges)) == sorted(
        [
            ("1.2.3.4", "Europe", "France"),
            ("9.9.9.9", "Unknown", "Unknown"),
            ("a.b.com", "Unknown", "Unknown"),
            ("999.1.1.1", "Unknown", "Unknown"),
            (None, "Unknown", "Unknown"),
        ],
        key=repr,
    )


def test_block_lookup_keeps_hits_only(spark):
    cidr = spark.createDataFrame(
        [("1.2.3.0/24", "1", "1")],
        "network string, geoname_id string, registered_country_geoname_id string",
    )
    blocks = blocks_from_cidr(cidr)
    hosts = spark.createDataFrame([(" 1.2.3.4 ",), ("1.2.3.4",), ("5.5.5.5",), ("a.com",)], "host string")
    got = geo.ip_block_lookup(hosts, blocks).collect()
    assert [(r["ip_addr"], r["block_id"]) for r in got] == [("1.2.3.4", 16909056 * 64 + 24)]


def test_export_drops_blocks_without_location(spark):
    blocks = spark.createDataFrame([(1, 2, 10), (3, 4, None), (5, 6, 11)], "start long, stop long, geoname_id int")
    places = spark.createDataFrame(
        [(10, "en", "EU", "Europe", "FR", "France")],
        "geoname_id int, locale_code string, continent_code string, continent_name string, country_iso_code string, country_name string",
    )
    assert values(geo.geo_export(blocks, places)) == [(1, 2, "EU", "Europe", "FR", "France")]


def test_enrichment_keeps_every_sighting(spark):
    ranges = spark.createDataFrame(
        [(0, 2**32 - 1, "X", "All", "X", "Any")],
        "start long, stop long, continent_code string, continent_name string, country_iso_code string, country_name string",
    )
    rows = sightings(spark, *[{"data": f"1.1.1.{i % 3}", "threat_score": float(i % 10)} for i in range(60)])
    full = geo.feature_enrich(rows, ranges)
    assert full.count() == 60
    assert full.where(F.col("elapsed") == 1).count() == 60
    assert set(full.columns) - set(rows.columns) == {"continent", "country", "score_direction", "elapsed"}
