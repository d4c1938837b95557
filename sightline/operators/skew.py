"""Joins that hold when one key has a large share of all rows.

Adaptive skew handling splits a partition only when both join inputs come
straight from a shuffle. A side that was just grouped by the join key does
not, and cached or checkpointed inputs do not either. These helpers cover
those cases.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sightline.session import cut

# A key with fewer rows than this is no burden to one task.
HEAVY_ROWS = 1_000_000
# Bound on the number of keys treated as heavy, and so on what is broadcast.
# Any other key then has at most one in HEAVY_KEYS of all rows.
HEAVY_KEYS = 10_000


def heavy_keys(
    frame: DataFrame, key: str, min_rows: int = HEAVY_ROWS, keep: int = HEAVY_KEYS
) -> DataFrame:
    """The keys with most rows, at most ``keep`` of them."""
    counts = frame.groupBy(key).agg(F.count("*").alias("_rows"))
    big = counts.where((F.col("_rows") >= min_rows) & F.col(key).isNotNull())
    return big.orderBy(F.col("_rows").desc(), key).limit(keep).select(key)


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    how: str = "inner",
    min_rows: int = HEAVY_ROWS,
    keep: int = HEAVY_KEYS,
    at_most: int | None = None,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Join ``left`` to ``right``, which has one row per ``key``.

    Rows of a heavy key get their match from a broadcast of at most ``keep``
    rows and stay where they are. All other rows, unmatched and null keys
    included, are joined by the shuffle as usual. ``left`` is read once more,
    key column only, to count, which happens at once; without a heavy key the
    join is a plain one. Where ``left`` is known to have ``at_most`` so many
    rows, and those are too few to make any key heavy, nothing is counted.

    ``counted`` is a cheaper table with the same keys as ``left``. Several of
    these joins in a row should count the keys on the table they started from.
    """
    if how not in ("inner", "left"):
        raise ValueError("lookup_join does inner and left joins")
    if at_most is not None and at_most < min_rows:
        return left.join(right, key, how)
    heavy = cut(heavy_keys(left if counted is None else counted, key, min_rows, keep))
    if heavy.isEmpty():
        return left.join(right, key, how)
    # At most `keep` rows: both broadcasts are bounded by construction.
    mark = F.broadcast(heavy)
    served = right.join(mark, key, "left_semi")
    hot = left.join(mark, key, "left_semi").join(F.broadcast(served), key, how)
    cold = left.join(mark, key, "left_anti").join(right, key, how)
    return cold.unionByName(hot)
