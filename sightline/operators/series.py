"""Time-series figures that need order: moving averages, quantile points, summaries."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sightline.session import cut

# exp(100) leaves room for large values in a double.
_SAFE_EXPONENT = 100.0
# Rows of a block at most, and blocks scanned in one row.
_MOST_BLOCK = 1 << 16
_FAN = 64


def _bucketed(series: DataFrame, time: str, width: int) -> DataFrame:
    return series.withColumn("_bucket", F.floor(F.col(time) / width))


def _before_bucket(buckets: DataFrame, value: str, name: str) -> DataFrame:
    """Running total over the bucket summary, this bucket left out.

    The summary has one row per bucket of time, however many rows the series
    has, so the single ordered pass over it stays small.
    """
    earlier = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    return buckets.withColumn(name, F.coalesce(F.sum(value).over(earlier), F.lit(0)))


def _followed(first: Column, second: Column) -> Column:
    """State of two stretches of a series, one after the other.

    A state is the weighted mean ``m`` (null without a value), the weight ``w`` it
    has at the end of the stretch, and the decay ``d`` over the stretch. Means and
    weights are kept apart, so a mean outlives a weight that has died down to zero.
    """
    left = first["w"] * second["d"]
    mixed = (left * first["m"] + second["w"] * second["m"]) / (left + second["w"])
    mean = (
        F.when(second["m"].isNull(), first["m"])
        .when(first["m"].isNull() | (left == 0), second["m"])
        .when(second["w"] == 0, second["m"])
        .otherwise(mixed)
    )
    return F.struct(mean.alias("m"), (left + second["w"]).alias("w"), (first["d"] * second["d"]).alias("d"))


def _nothing() -> Column:
    return F.struct(F.lit(None).cast("double").alias("m"), F.lit(0.0).alias("w"), F.lit(1.0).alias("d"))


def _states_before(states: DataFrame) -> DataFrame:
    """(block, before) for (block, state): the state of all blocks before each.

    A prefix scan by levels. Some neighbouring blocks are scanned in one row and
    make one state of the next level, which is scanned the same way. The parts
    of a level are spread over tasks; the last level is one row.
    """
    members = F.array_sort(F.collect_list(F.struct("block", "state")))
    parts = cut(states.groupBy(F.floor(F.col("block") / _FAN).alias("part")).agg(members.alias("members")))
    start = F.struct(F.array().cast("array<struct<block: bigint, before: struct<m: double, w: double, d: double>>>").alias("seen"), _nothing().alias("state"))

    def step(known: Column, member: Column) -> Column:
        here = F.struct(member["block"].alias("block"), known["state"].alias("before"))
        return F.struct(F.concat(known["seen"], F.array(here)).alias("seen"), _followed(known["state"], member["state"]).alias("state"))

    scanned = parts.select("part", F.aggregate("members", start, step).alias("s"))
    inner = scanned.select("part", F.inline("s.seen"))
    if parts.limit(2).count() < 2:
        return inner.select("block", "before")
    above = _states_before(cut(scanned.select(F.col("part").alias("block"), F.col("s.state").alias("state"))))
    above = above.select(F.col("block").alias("part"), F.col("before").alias("above"))
    return inner.join(above, "part").select("block", _followed(F.col("above"), F.col("before")).alias("before"))


def ewm(
    series: DataFrame,
    time: str,
    value: str,
    alpha: float = 0.2,
    bucket_seconds: int = 30 * 86400,
) -> DataFrame:
    """Exponentially weighted mean with adjusted weights, in time order.

    The weights run over row positions. Nulls and NaN have a position but no
    value: they repeat the mean so far, which is null before the first value.
    Positions are cut into blocks that are averaged side by side; a prefix scan
    over the blocks brings each the state of all rows before it, so no history is
    lost. ``time`` must be unique; ``alpha`` is above 0 and at most 1.
    """
    if not 0 < alpha <= 1:
        raise ValueError("alpha must be above 0 and at most 1")
    keep = 1 - alpha
    decay = -math.log1p(-alpha) if alpha < 1 else math.inf
    block = max(1, min(int(_SAFE_EXPONENT / decay), _MOST_BLOCK))

    number = F.col(value).cast("double")
    rows = _bucketed(series.select(time, value, F.when(~F.isnan(number), number).alias("_x")), time, bucket_seconds)
    sizes = rows.groupBy("_bucket").agg(F.count("*").alias("_size"))
    offsets = _before_bucket(sizes, "_size", "_offset").select("_bucket", "_offset")
    in_bucket = Window.partitionBy("_bucket").orderBy(time)
    position = F.col("_offset") + F.row_number().over(in_bucket) - 1
    placed = rows.join(offsets, "_bucket").withColumn("_pos", position)
    placed = cut(placed.select(time, value, "_x", "_pos").withColumn("block", F.floor(F.col("_pos") / block)))
    # sum x_j q^(i-j) = q^i * sum x_j q^-j, with exponents kept small per block.
    step = F.col("_pos") - F.col("block") * block
    grown = F.exp(step * decay) if block > 1 else F.lit(1.0)
    so_far = Window.partitionBy("block").orderBy("_pos").rowsBetween(Window.unboundedPreceding, 0)
    top = F.sum(F.col("_x") * grown).over(so_far)
    weight = F.sum(F.when(F.col("_x").isNotNull(), grown).otherwise(0.0)).over(so_far)
    local = F.struct((top / F.when(weight > 0, weight)).alias("m"), (weight / grown).alias("w"), F.pow(F.lit(keep), step + 1).alias("d"))
    averaged = placed.withColumn("state", local)
    states = cut(averaged.groupBy("block").agg(F.max_by("state", "_pos").alias("state")))
    met = averaged.join(_states_before(states), "block")
    return met.select(time, value, _followed(F.col("before"), F.col("state"))["m"].alias("moving_average"))


def quantile_point(
    series: DataFrame,
    time: str,
    value: str,
    share: float = 0.75,
    bucket_seconds: int = 30 * 86400,
) -> DataFrame:
    """First point in time order at which the running total reaches a share of all.

    Totals per bucket of time find the bucket in which that happens; only its
    rows are then scanned in order.
    """
    rows = _bucketed(series.select(time, value), time, bucket_seconds)
    sums = rows.groupBy("_bucket").agg(F.sum(value).alias("_sum"))
    marked = _before_bucket(sums, "_sum", "_before").withColumn(
        "_total", F.sum("_sum").over(Window.partitionBy())
    )
    reached = F.col("_before") + F.col("_sum") >= F.col("_total") * share
    crossing = (
        marked.where(reached)
        .orderBy("_bucket")
        .limit(1)
        .select("_bucket", "_before", "_total")
    )
    in_order = Window.partitionBy("_bucket").orderBy(time)
    running = rows.join(crossing, "_bucket").withColumn(
        "cumulative", F.col("_before") + F.sum(value).over(in_order)
    )
    return (
        running.where(F.col("cumulative") >= F.col("_total") * share)
        .orderBy(time)
        .limit(1)
        .select(time, value, "cumulative")
    )


def describe(series: DataFrame, value: str) -> DataFrame:
    """Count, mean, deviation, extremes and exact quartiles of one column.

    Equal values are counted before the quartiles are taken, so what meets in
    one task is the distinct values. For counts that sum to N there are at
    most about sqrt(2N) of those.
    """
    present = series.select(F.col(value).cast("double").alias("x")).where(F.col("x").isNotNull())
    counted = present.groupBy("x").agg(F.count("*").alias("w"))
    n = F.sum("w")
    mean = F.sum(F.col("x") * F.col("w")) / n
    quartiles = F.percentile("x", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), F.col("w"))
    shape = counted.agg(
        n.alias("count"),
        mean.alias("mean"),
        F.min("x").alias("min"),
        quartiles.alias("q"),
        F.max("x").alias("max"),
    )
    spread = present.agg(F.stddev_samp("x").alias("std"))
    return shape.select(
        "count",
        "mean",
        F.col("q")[0].alias("p25"),
        F.col("q")[1].alias("p50"),
        F.col("q")[2].alias("p75"),
        "min",
        "max",
        spread.scalar().alias("std"),
    )
