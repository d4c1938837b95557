"""Helpers shared by the corpus operators."""

from __future__ import annotations

import json
import os
from functools import reduce

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Words are runs of anything but ASCII white space.
SPACE = "[\\x20\\x09-\\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def whole_text(column: str = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(column), F.lit(""))


def words(text: Column) -> Column:
    """Words of a text as an array, empty for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def width(spark: SparkSession) -> int:
    """Number of parts into which hot keys are spread, as wide as a shuffle."""
    return max(64, int(spark.conf.get("spark.sql.shuffle.partitions")))


def ranked(frame: DataFrame, by: str, order: list[str], out: str) -> DataFrame:
    """Add ``out``: a gapless rank from 0 within each value of ``by``.

    Each value of ``by`` is cut into parts by a hash of the ``order`` columns, so
    no task sorts a hot value whole. Ranks follow the parts, then ``order``; the
    rows must not depend on the run, so hand in a table. Rows equal in all of
    ``order`` get different ranks. Null values of ``by`` form one value.
    """
    parts = F.lit(width(frame.sparkSession))
    salted = frame.withColumn("_part", F.pmod(F.xxhash64(*order), parts).cast("int"))
    counts = salted.groupBy(F.col(by).alias("_by"), F.col("_part").alias("_p")).agg(F.count("*").alias("_n"))
    before = Window.partitionBy("_by").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    # At most `width` rows for each value here.
    offsets = counts.select("_by", "_p", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    local = Window.partitionBy(by, "_part").orderBy(*order)
    numbered = salted.withColumn("_local", F.row_number().over(local) - 1)
    met = numbered.join(offsets, numbered[by].eqNullSafe(offsets["_by"]) & (numbered["_part"] == offsets["_p"]))
    return met.withColumn(out, F.col("_before") + F.col("_local")).drop("_by", "_p", "_part", "_local", "_n", "_before")


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def tokenizer_path(name: str, folder: str | None = None) -> str:
    """A tokenizer file in ``folder``, or where the package of public tokenizers has it."""
    return os.path.join(folder, name) if folder else public_tokenizers.path(name)


def tokenizer_text(name: str, folder: str | None = None) -> str:
    """A tokenizer file as text; it travels with the tasks, which need no file then."""
    with open(tokenizer_path(name, folder), encoding="utf-8") as file:
        return json.dumps(json.load(file), ensure_ascii=False)
