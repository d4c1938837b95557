"""Score-trajectory labels per host."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sightline.functions.scoring import HIGH_SCORES, LOW_SCORES, NEUTRAL, trajectory


def score_sets(sightings: DataFrame) -> DataFrame:
    """Distinct scores of every host, sorted; nulls are left out.

    Repeats are dropped before the sets are gathered, so a set never holds
    more than the values of the score scale.
    """
    pairs = sightings.select("data", "threat_score").distinct()
    return pairs.groupBy("data").agg(F.sort_array(F.collect_list("threat_score")).alias("scores"))


def score_directions(sightings: DataFrame, *more: Column) -> DataFrame:
    """Where the scores of every host went, without gathering the scores; ``more`` aggregates may follow."""

    def ever(values: list[int]):
        return F.coalesce(
            F.bool_or(F.col("threat_score").isin(*[float(v) for v in values])), F.lit(False)
        )

    seen = sightings.groupBy("data").agg(
        ever(HIGH_SCORES).alias("high"),
        ever(LOW_SCORES).alias("low"),
        ever([NEUTRAL]).alias("neutral"),
        *more,
    )
    label = trajectory(F.col("high"), F.col("low"), F.col("neutral"))
    rest = [c for c in seen.columns if c not in ("data", "high", "low", "neutral")]
    return seen.select("data", label.alias("score_direction"), *rest)


def label_counts(directions: DataFrame) -> DataFrame:
    """Rows per host and label; a host has one label, so each count is 1."""
    return directions.groupBy("data", "score_direction").agg(F.count("*").alias("count"))
