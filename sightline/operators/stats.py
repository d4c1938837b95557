"""Summary tables and sector clean-up."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sightline.functions.scoring import score_label
from sightline.functions.values import double_or_zero, elapsed, millis_to_seconds

# Spellings of a sector and the name they are counted under.
SECTOR_NAMES = {
    "IT & Svcs": "Information Technology & Services",
    "healthcare": "Health Care",
    "govt services": "Government",
    "government": "Government",
    "IT Sector": "Information Technology & Services",
    "IT": "Information Technology & Services",
    "cybersecurity": "Cybersecurity",
    "home": "Home",
    "infrastructure": "Infrastructure",
}
SECTOR_THRESHOLD = 300_000
SMALL_SECTORS = "Other"


def host_totals(sightings: DataFrame) -> DataFrame:
    return sightings.groupBy("data").agg(F.sum("count_seen").alias("count_seen"))


def sensor_totals(sightings: DataFrame) -> DataFrame:
    return sightings.groupBy("anonymous_id", "sector", "size").agg(
        F.sum("count_seen").alias("count_seen")
    )


def connection_totals(sightings: DataFrame) -> DataFrame:
    return sightings.groupBy("anonymous_id", "data").agg(
        F.sum("count_seen").alias("count_seen")
    )


def total_events(sightings: DataFrame) -> DataFrame:
    """Sum of all counts; what cannot be read as a number counts 0."""
    count = double_or_zero(F.col("count_seen").cast("string"))
    return sightings.agg(F.coalesce(F.sum(count), F.lit(0.0)).alias("total_events"))


def _rows_by(sightings: DataFrame, keys: list[str], counted: str) -> DataFrame:
    # count(column) skips nulls, so a null key is listed with 0 rows.
    return sightings.groupBy(*keys).agg(F.count(counted).alias("count"))


def customer_stats(sightings: DataFrame) -> DataFrame:
    return _rows_by(sightings, ["anonymous_id", "sector"], "anonymous_id")


def time_stats(sightings: DataFrame) -> DataFrame:
    return _rows_by(sightings, ["first_seen"], "first_seen")


def score_stats(sightings: DataFrame) -> DataFrame:
    return _rows_by(sightings, ["threat_score"], "threat_score")


def sector_stats(sightings: DataFrame) -> DataFrame:
    return _rows_by(sightings, ["sector"], "sector")


def location_label_stats(located: DataFrame) -> DataFrame:
    """Rows per country and High / Low / Neutral."""
    labelled = located.select("country", score_label("threat_score").alias("score_label"))
    return _rows_by(labelled, ["country", "score_label"], "country")


def location_score_stats(located: DataFrame) -> DataFrame:
    return _rows_by(located, ["country", "threat_score"], "country")


def direction_stats(directions: DataFrame) -> DataFrame:
    return _rows_by(directions, ["score_direction"], "score_direction")


def elapsed_stats(sightings: DataFrame) -> DataFrame:
    """Rows per elapsed time, with the time also divided by 1000 as charts show it."""
    spans = sightings.select(elapsed("first_seen", "last_seen").alias("dt"))
    return spans.groupBy("dt").agg(
        F.count("*").alias("count"), F.first(millis_to_seconds("dt")).alias("seconds")
    )


def ranked(frame: DataFrame, by: str, *ties: str) -> DataFrame:
    """Complete rows, largest first."""
    return frame.na.drop().orderBy(F.col(by).desc(), *[F.col(t).asc() for t in ties])


def sector_rollup(sectors: DataFrame, threshold: int = SECTOR_THRESHOLD) -> DataFrame:
    """Merge spellings of a sector; raw sectors up to the threshold become Other."""
    clean = F.create_map(*[F.lit(x) for pair in SECTOR_NAMES.items() for x in pair])
    merged = F.coalesce(F.try_element_at(clean, F.col("sector")), F.col("sector"))
    name = F.when(F.col("count") <= threshold, SMALL_SECTORS).otherwise(merged)
    return (
        sectors.where(F.col("sector").isNotNull())
        .groupBy(name.alias("sector"))
        .agg(F.sum("count").alias("count"))
    )


def country_pivot(location_labels: DataFrame) -> DataFrame:
    """Countries as rows, score labels as columns, row counts as values."""
    return (
        location_labels.groupBy("country")
        .pivot("score_label", ["High", "Neutral", "Low"])
        .agg(F.sum("count"))
    )


def top_countries(location_labels: DataFrame, k: int = 10) -> DataFrame:
    order = [F.col(c).desc_nulls_last() for c in ("High", "Neutral", "Low")]
    return country_pivot(location_labels).orderBy(*order, "country").limit(k)


def first_rows(frame: DataFrame, keys: list[str], n: int) -> DataFrame:
    return frame.orderBy(*keys).limit(n)


def confusion(scored: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """The four counts and the error rate of a binary prediction, in one pass."""
    true, guess = F.col(label) == 1.0, F.col(prediction) == 1.0
    wrong = F.count_if(F.col(label) != F.col(prediction))
    return scored.agg(
        F.count_if(true & guess).alias("true_positive"),
        F.count_if(~true & ~guess).alias("true_negative"),
        # As the report has it: positives are counted false by their label.
        F.count_if(true & ~guess).alias("false_positive"),
        F.count_if(~true & guess).alias("false_negative"),
        (wrong / F.count("*")).alias("error_rate"),
    )


def prediction_counts(scored: DataFrame, prediction: str = "prediction") -> DataFrame:
    return scored.agg(
        F.count_if(F.col(prediction) == 1.0).alias("above"),
        F.count_if(F.col(prediction) == 0.0).alias("below"),
    )
