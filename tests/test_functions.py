import pytest
from pyspark.sql import functions as F

from sightline.functions import net, scoring, values as v


def apply(spark, kind, inputs, expression):
    frame = spark.createDataFrame([(i, x) for i, x in enumerate(inputs)], f"i int, x {kind}")
    return [r[0] for r in frame.orderBy("i").select(expression).collect()]


def test_is_ip_leaves_octet_range_unchecked_but_the_number_does_not(spark):
    hosts = ["1.2.3.4", "999.1.1.1", "x", " 1.2.3.4 ", "1.2.3", None, ""]
    assert apply(spark, "string", hosts, net.is_ip("x")) == [True, True, False, False, False, None, False]
    assert apply(spark, "string", hosts, net.ip_to_long("x")) == [16909060] + [None] * 6


def test_cidr_ranges(spark):
    start, stop, length = net.cidr_range("x")
    blocks = ["10.0.0.0/8", "1.2.3.0/24", "1.2.3.4/32", "0.0.0.0/0", "1.2.3.4/24", "bad", "1.2.3.4/40"]
    got = apply(spark, "string", blocks, F.struct(start.alias("a"), stop.alias("b"), length.alias("n")))
    assert [tuple(r) for r in got] == [
        (167772160, 184549375, 8),
        (16909056, 16909311, 24),
        (16909060, 16909060, 32),
        (0, 4294967295, 0),
        (16909056, 16909311, 24),
        (None, None, None),
        (None, None, None),
    ]


def test_trim_host(spark):
    hosts = ["abc.123.rfg.example.com", "x", "\t 1.2.3.4 ", "999.1.1.1", "a.b", None]
    assert apply(spark, "string", hosts, net.trim_host("x")) == [
        "example.com", "x", "1.2.3.4", "999.1.1.1", "a.b", None,
    ]
    assert apply(spark, "string", hosts[:1], net.trim_host("x", 3)) == ["rfg.example.com"]


def test_tolerant_casts(spark):
    texts = ["abc", "", "3", "3.5", None]
    assert apply(spark, "string", texts, v.double_or_zero("x")) == [0.0, 0.0, 3.0, 3.5, 0.0]
    assert apply(spark, "string", texts, v.int_or_null("x"))[:3] == [None, None, 3]


def test_elapsed_counts_zero_text_as_present(spark):
    pairs = [("", "5"), (None, "5"), ("0", "5"), ("7", "9"), ("7", "")]
    frame = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, a string, b string")
    got = [r[0] for r in frame.orderBy("i").select(v.elapsed("a", "b")).collect()]
    assert got == [0, 0, 5, 2, 0]


def test_epoch_seconds_ignores_the_session_zone(spark):
    expression = v.epoch_seconds(F.col("x").cast("timestamp_ntz"))
    for zone in ("America/New_York", "UTC"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        assert apply(spark, "string", ["1996-07-01 02:03:04", "1969-12-31 23:59:59"], expression) == [
            836186584, -1,
        ]
    assert apply(spark, "long", [0, -1, 86400], v.epoch_date("x").cast("string")) == [
        "1970-01-01", "1969-12-31", "1970-01-02",
    ]


def test_score_labels(spark):
    scores = [None, 4.9, 5.0, 5.1]
    assert apply(spark, "double", scores, scoring.score_label("x")) == [None, "Low", "Neutral", "High"]
    assert apply(spark, "double", scores, scoring.binary_label("x")) == [None, 0.0, 0.0, 1.0]
    assert apply(spark, "double", scores, scoring.ternary_label("x")) == [None, 0.0, None, 1.0]
    assert apply(spark, "string", ["abc", "6"], scoring.binary_label("x")) == [None, 1.0]


def test_last_score_item_truncates(spark):
    assert apply(spark, "double", [4.9, 5.0, 5.1, None], scoring.last_score_item("x")) == [
        scoring.LAST_SCORE_LOW, scoring.LAST_SCORE_HIGH, scoring.LAST_SCORE_HIGH, None,
    ]


def test_count_bins(spark):
    counts = [-1.0, 0.0, 50.0, 51.0, 150.0, 151.0, 300.0, 301.0]
    assert apply(spark, "double", counts, scoring.count_bin("x")) == [
        "seen>300", "seen<=50", "seen<=50", "seen<=100", "seen<= 150", "seen<= 200", "seen<= 300", "seen>300",
    ]


def test_threat_items_of_both_variants(spark):
    scores = [0.0, 3.0, 4.0, 5.0, 6.0, 7.0, -1.0]
    assert apply(spark, "double", scores, scoring.threat_item("x")) == [
        "low_threat_0", "low_threat_3", "mid_threat_4", "mid_threat_5", "mid_threat_6", "high_threat_7",
        "high_threat_-1",
    ]
    assert apply(spark, "double", scores[:6], scoring.threat_item_split("x")) == [
        "low_threat_0", "low_threat_3", "low_threat_4", "high_threat5", "medium_threat6", "high_threat7",
    ]
    assert apply(spark, "string", ["small", "medium", "huge"], scoring.size_item("x")) == [
        "size_small", "size_medium", "size_large",
    ]


@pytest.mark.parametrize(
    "scores, label",
    [
        ([], "Unknown_State"),
        ([5.0], "Neutral"),
        ([5.0, 6.0], "Trends_High"),
        ([5.0, 6.0, 1.0], "Trends_High"),
        ([5.0, 1.0], "Trends_Low"),
        ([7.0], "Started_High"),
        ([7.0, 1.0], "Started_Low_Went_High"),
        ([1.0], "Stayed_Low"),
        ([5.5], "Unknown_State"),
    ],
)
def test_trajectory(spark, scores, label):
    from sightline.operators.labels import score_directions
    from tests.conftest import sightings

    assert apply(spark, "array<double>", [scores], scoring.trajectory_of_set("x")) == [label]
    rows = sightings(spark, *[{"threat_score": s} for s in scores or [None]])
    assert score_directions(rows).first()["score_direction"] == label


def test_hash_unit_is_uniform_and_fixed(spark):
    frame = spark.range(20000).select(v.hash_unit("id").alias("u"))
    low, high, mean = frame.agg(F.min("u"), F.max("u"), F.avg("u")).first()
    assert 0 <= low and high < 1 and abs(mean - 0.5) < 0.01
    again = spark.range(20000).repartition(7).select(v.hash_unit("id").alias("u"))
    assert frame.exceptAll(again).count() == 0
