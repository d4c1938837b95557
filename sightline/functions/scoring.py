"""Labels derived from threat scores, counts and sizes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from sightline.functions.values import column

# The score domain is 0 to 9 and 5 is neutral.
NEUTRAL = 5
HIGH_SCORES = [6, 7, 8, 9]
LOW_SCORES = [0, 1, 2, 3, 4]

# Upper bound of each count bin and its label, spelled as consumers expect.
COUNT_BINS = [
    (50, "seen<=50"),
    (100, "seen<=100"),
    (150, "seen<= 150"),
    (200, "seen<= 200"),
    (250, "seen<= 250"),
    (300, "seen<= 300"),
]
COUNT_REST = "seen>300"

# Basket items that state the last score of an IP.
LAST_SCORE_HIGH = "lastScore_greater_5_true"
LAST_SCORE_LOW = "lastScore_greater_5_false"


def score_label(score: Column | str) -> Column:
    """High above neutral, Low below it; a null score has no label."""
    s = column(score)
    return (
        F.when(s > NEUTRAL, "High").when(s < NEUTRAL, "Low").when(s == NEUTRAL, "Neutral")
    )


def trajectory(has_high: Column, has_low: Column, has_neutral: Column) -> Column:
    """Where the scores of one host went, from which kinds of score it ever had."""
    started = (
        F.when(has_high & has_low, "Started_Low_Went_High")
        .when(has_high, "Started_High")
        .when(has_low, "Stayed_Low")
        .otherwise("Unknown_State")
    )
    neutral = (
        F.when(has_high, "Trends_High").when(has_low, "Trends_Low").otherwise("Neutral")
    )
    return F.when(has_neutral, neutral).otherwise(started)


def trajectory_of_set(scores: Column | str) -> Column:
    """The same label from an array of scores."""
    array = column(scores)

    def holds_any(values: list[int]) -> Column:
        return F.arrays_overlap(array, F.array(*[F.lit(float(v)) for v in values]))

    return trajectory(
        holds_any(HIGH_SCORES), holds_any(LOW_SCORES), F.array_contains(array, float(NEUTRAL))
    )


def size_item(size: Column | str) -> Column:
    s = column(size)
    return (
        F.when(s == "small", "size_small")
        .when(s == "medium", "size_medium")
        .otherwise("size_large")
    )


def count_bin(count: Column | str) -> Column:
    n = column(count).cast("long")
    first = F.when(n < 0, COUNT_REST)
    return reduce(
        lambda chain, step: chain.when(n <= step[0], step[1]), COUNT_BINS, first
    ).otherwise(COUNT_REST)


def threat_item(score: Column | str) -> Column:
    """Three-level threat item: 0-3 low, 4-6 mid, everything else high."""
    n = column(score).cast("int")
    level = F.when(n.between(0, 3), "low_threat_").when(n.between(4, 6), "mid_threat_")
    return F.concat(level.otherwise("high_threat_"), n.cast("string"))


def threat_item_split(score: Column | str) -> Column:
    """Threat item of the variant that singles out 6; 5 counts as high there."""
    n = column(score).cast("int")
    level = F.when(n < 5, "low_threat_").when(n == 6, "medium_threat")
    return F.concat(level.otherwise("high_threat"), n.cast("string"))


def last_score_item(score: Column | str) -> Column:
    """Basket item of the last score, compared after truncation."""
    n = column(score).try_cast("double").cast("int")
    return F.when(n < NEUTRAL, LAST_SCORE_LOW).when(n >= NEUTRAL, LAST_SCORE_HIGH)


def binary_label(score: Column | str) -> Column:
    """1 above neutral, else 0; null when the score is not a number."""
    return (column(score).try_cast("double") > float(NEUTRAL)).cast("double")


def ternary_label(score: Column | str) -> Column:
    """1 above neutral, 0 below it; the unusable neutral rows are null."""
    s = column(score).try_cast("double")
    return F.when(s > float(NEUTRAL), 1.0).when(s < float(NEUTRAL), 0.0)
