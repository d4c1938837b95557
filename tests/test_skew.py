import pytest
from pyspark.sql import functions as F

from sightline.operators.skew import heavy_keys, lookup_join
from tests.conftest import values


@pytest.fixture
def sides(spark):
    # Key 0 has a third of all rows; nulls and unmatched keys are there too.
    left = spark.range(900).select(
        F.when(F.col("id") % 3 == 0, 0)
        .when(F.col("id") % 50 == 1, None)
        .otherwise(F.col("id") % 40)
        .alias("k"),
        F.col("id").alias("row"),
    )
    right = spark.range(30).select(F.col("id").alias("k"), F.when(F.col("id") != 5, F.col("id") * 10).alias("v"))
    return left, right


def test_heavy_keys_are_bounded(sides):
    left, _ = sides
    assert values(heavy_keys(left, "k", min_rows=100)) == [(0,)]
    assert heavy_keys(left, "k", min_rows=1, keep=7).count() == 7


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("min_rows, keep", [(1, 1000), (100, 1000), (1, 2), (10**9, 1000)])
def test_lookup_join_equals_a_join(sides, how, min_rows, keep):
    left, right = sides
    want = left.join(right, "k", how)
    got = lookup_join(left, right, "k", how, min_rows=min_rows, keep=keep)
    assert got.columns == want.columns
    assert values(got) == values(want)


def test_lookup_join_with_few_rows_is_plain(sides):
    left, right = sides
    got = lookup_join(left, right, "k", at_most=900)
    assert values(got) == values(left.join(right, "k"))
    with pytest.raises(ValueError):
        lookup_join(left, right, "k", how="full")


@pytest.mark.parametrize("how", ["inner", "left"])
def test_lookup_join_spreads_a_heavy_key(spark, how):
    # One key has 90 % of the rows; they stay on the partitions they came from.
    left = spark.range(40_000, numPartitions=8).select(
        F.when(F.col("id") % 10 != 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("row")
    )
    right = spark.range(40_000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = lookup_join(left, right, "k", how, min_rows=1000)
        sizes = [r["n"] for r in got.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
        assert sum(sizes) == 40_000
        assert max(sizes) <= 40_000 / 8 + 1000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
