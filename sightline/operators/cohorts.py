"""Row cohorts by score, time slices and customer co-occurrence."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sightline.functions.values import column, epoch_date


def cohort_conditions(score: Column | str = "threat_score") -> dict[str, Column]:
    s = column(score)
    return {
        "all": F.lit(True),
        "targeted": (s > 0) & (s < 9) & (s != 5),
        "no5s": s != 5,
        "only5s": s == 5,
        "no1s9s5s": ~s.isin(1.0, 9.0, 5.0),
    }


def cohort(sightings: DataFrame, name: str) -> DataFrame:
    return sightings.where(cohort_conditions()[name])


def targeted(sightings: DataFrame) -> DataFrame:
    """Neither neutral nor at either end of the scale."""
    return cohort(sightings, "targeted")


def cohort_counts(sightings: DataFrame) -> DataFrame:
    """Size of every cohort from one pass."""
    conditions = cohort_conditions()
    counted = sightings.agg(*[F.count_if(c).alias(n) for n, c in conditions.items()])
    return counted.unpivot([], list(conditions), "cohort", "n")


def columns_except(frame: DataFrame, names: list[str]) -> DataFrame:
    return frame.drop(*names)


def seen_by_all_wide(features: DataFrame, customers: list[str]) -> DataFrame:
    """Rows of a wide feature table with a positive count for every given customer."""
    return features.where(reduce(Column.__and__, [F.col(c) > 0 for c in customers]))


def cooccurrence(sightings: DataFrame, customers: list[str]) -> DataFrame:
    """How many IPs were seen by every one of ``customers``.

    One flag per customer and IP: the flags combine before the shuffle, so an
    IP with very many sightings costs no more than any other.
    """
    flags = {
        f"f{i}": F.bool_or(F.col("anonymous_id") == c) for i, c in enumerate(customers)
    }
    per_ip = (
        sightings.where(F.col("anonymous_id").isin(*customers))
        .groupBy("data")
        .agg(*[flag.alias(name) for name, flag in flags.items()])
    )
    together = reduce(Column.__and__, [F.col(name) for name in flags])
    return per_ip.agg(F.count_if(together).alias("n_ips"))


def time_slice(
    frame: DataFrame, first_year: int, last_year: int, time: str = "first_seen"
) -> DataFrame:
    """Rows whose epoch-second column falls in the given years, both included."""
    return frame.where(F.year(epoch_date(time)).between(first_year, last_year))
