"""Moving averages against pandas, where earlier rows, missing values and steep weights matter."""

import math
import random

import pandas as pd
import pytest

from sightline.operators import series
from tests.conftest import values


def averaged(spark, data, alpha):
    rows = [(i * 3600, x) for i, x in enumerate(data)]
    shuffled = random.Random(1).sample(rows, len(rows))
    frame = spark.createDataFrame(shuffled, "ts long, n double")
    return [r[2] for r in sorted(series.ewm(frame, "ts", "n", alpha).collect(), key=lambda r: r[0])]


def close(got, want):
    assert len(got) == len(want)
    for a, b in zip(got, want, strict=True):
        assert (a is None) == (b is None or math.isnan(b))
        if a is not None:
            assert a == pytest.approx(b, rel=1e-9, abs=1e-300)


@pytest.mark.parametrize("alpha", [0.2, 0.9, 1.0])
def test_ewm_with_missing_values(spark, alpha):
    dice = random.Random(2)
    data = [None, float("nan")] + [dice.choice([None, dice.random() * 10]) for _ in range(300)]
    close(averaged(spark, data, alpha), list(pd.Series(data, dtype=float).ewm(alpha=alpha).mean()))


def test_ewm_keeps_all_history(spark):
    dice = random.Random(3)
    # Old values outweigh new ones through hundreds of rows, over several levels of blocks.
    data = [1e120] + [dice.random() for _ in range(1500)]
    close(averaged(spark, data, 0.2), list(pd.Series(data).ewm(alpha=0.2).mean()))
    gap = [3.0, 5.0] + [None] * 4000 + [7.0]
    close(averaged(spark, gap, 0.2), list(pd.Series(gap).ewm(alpha=0.2).mean()))
    narrow = [dice.random() for _ in range(150)]
    close(averaged(spark, narrow, 0.999), list(pd.Series(narrow).ewm(alpha=0.999).mean()))


def test_ewm_of_nothing(spark):
    assert values(series.ewm(spark.createDataFrame([], "ts long, n double"), "ts", "n")) == []
    with pytest.raises(ValueError):
        series.ewm(spark.createDataFrame([], "ts long, n double"), "ts", "n", alpha=0)
