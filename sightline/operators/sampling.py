"""Samples and splits that nest, repeat and balance."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sightline.functions.values import hash_unit

# Fractions of the nested samples and the seed they share.
FRACTIONS = [0.005, 0.01, 0.02, 0.03, 0.05, 0.10, 0.25, 0.50]
SEED = 42
TRAIN_FRACTION = 0.65


def bernoulli_samples(
    frame: DataFrame, fractions: list[float] = FRACTIONS, seed: int = SEED
) -> dict[float, DataFrame]:
    """One sample per fraction; with one seed each larger one holds the smaller.

    That holds while the partitioning of ``frame`` stays as it is. Where it may
    change use ``hash_sample``.
    """
    return {fraction: frame.sample(False, fraction, seed) for fraction in fractions}


def hash_sample(frame: DataFrame, keys: list[str], fraction: float) -> DataFrame:
    return frame.where(hash_unit(*keys) < fraction)


def nested_sample_sizes(
    frame: DataFrame, keys: list[str], fractions: list[float] = FRACTIONS
) -> DataFrame:
    """Rows in every nested hash sample, all from one pass."""
    unit = frame.select(hash_unit(*keys).alias("u"))
    names = {f"{fraction}": fraction for fraction in fractions}
    sizes = unit.agg(*[F.count_if(F.col("u") < f).alias(n) for n, f in names.items()])
    return sizes.unpivot([], [F.col(f"`{n}`") for n in names], "fraction", "n")


def split_column(keys: list[str], train: float = TRAIN_FRACTION):
    return F.when(hash_unit(*keys) < train, "train").otherwise("test")


def hash_split(
    frame: DataFrame, keys: list[str], train: float = TRAIN_FRACTION
) -> tuple[DataFrame, DataFrame]:
    unit = hash_unit(*keys)
    return frame.where(unit < train), frame.where(unit >= train)


def random_split(
    frame: DataFrame, train: float = TRAIN_FRACTION, seed: int = SEED
) -> tuple[DataFrame, DataFrame]:
    first, second = frame.randomSplit([train, 1.0 - train], seed)
    return first, second


def class_ratio(frame: DataFrame, label: str = "label") -> float:
    """Rows of class 1 per row of class 0, from one aggregate."""
    row = frame.agg(
        F.count_if(F.col(label) == 1.0).alias("ones"),
        F.count_if(F.col(label) == 0.0).alias("zeros"),
    ).first()
    return row["ones"] / row["zeros"] if row["zeros"] else 1.0


def balance(frame: DataFrame, label: str = "label", seed: int = SEED) -> DataFrame:
    """Undersample whichever class is larger by random draw."""
    ratio = class_ratio(frame, label)
    fractions = {0.0: min(1.0, ratio), 1.0: min(1.0, 1.0 / ratio) if ratio else 1.0}
    return frame.sampleBy(label, fractions, seed)


def hash_balance(frame: DataFrame, keys: list[str], label: str = "label") -> DataFrame:
    """The same undersampling with the draw fixed by the keys."""
    ratio = class_ratio(frame, label)
    keep_zero, keep_one = min(1.0, ratio), min(1.0, 1.0 / ratio) if ratio else 1.0
    bound = F.when(F.col(label) == 1.0, F.lit(keep_one)).otherwise(F.lit(keep_zero))
    # Salted so that the draw is independent of a split made on the same keys.
    return frame.where(hash_unit(F.lit("balance"), *keys) < bound)
