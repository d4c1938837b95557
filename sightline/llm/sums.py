"""Sums of large vectors over all partitions, and vectors as matrices."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Values in one row of the shuffle that adds partitions up.
SLICE = 512
# So many partitions send their sums straight to the driver.
FEW_PARTS = 16


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """A list column without nulls, all lists of one width, as a matrix of doubles."""
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False).reshape(len(flat), width)


def lists(values: np.ndarray) -> pa.Array:
    """The rows of a matrix as a list column."""
    offsets = pa.array(np.arange(len(values) + 1) * values.shape[1], pa.int32())
    return pa.ListArray.from_arrays(offsets, pa.array(np.ascontiguousarray(values).reshape(-1)))


def summed(rows: DataFrame, part: Callable[[pa.RecordBatch], np.ndarray], size: int, parts: int | None = None) -> np.ndarray:
    """The sum of ``part`` over all batches of ``rows``, a vector of ``size`` values.

    A partition sends its sum in slices. The slices are added up in the order of
    partitions, one at a time, so a task that adds holds one batch of the shuffle
    and its own slices, whatever the number of partitions, and a sum does not
    depend on the order in which tasks end. Only the total reaches the driver.
    Where ``rows`` are known to lie in at most ``FEW_PARTS`` ``parts``, the driver
    adds their sums itself, in the same order and without a shuffle.
    """
    slices = -(-size // SLICE)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(slices * SLICE)
        for batch in batches:
            if batch.num_rows:
                total[:size] += part(batch)
        if total.any():
            number = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(slices), pa.int32()), pa.array(np.full(slices, number), pa.int32()), lists(total.reshape(slices, SLICE))],
                ["slice", "part", "values"],
            )

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            values = matrix(batch.column("values"), SLICE)
            for k, of in enumerate(batch.column("slice").to_pylist()):
                if of in totals:
                    totals[of] += values[k]
                else:
                    totals[of] = values[k].copy()
        if totals:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(totals), pa.int32()), lists(np.array(list(totals.values())))], ["slice", "values"]
            )

    sent = rows.mapInArrow(sums, "slice int, part int, values array<double>")
    total = np.zeros(slices * SLICE)
    if parts is not None and parts <= FEW_PARTS:
        for r in sorted(sent.collect(), key=lambda r: r["part"]):
            total[r["slice"] * SLICE : (r["slice"] + 1) * SLICE] += r["values"]
        return total[:size]
    # Without a number of partitions, Spark joins the small ones, so a pass takes few tasks however wide its shuffle.
    met = sent.repartition("slice").sortWithinPartitions("slice", "part")
    for r in met.mapInArrow(added, "slice int, values array<double>").collect():
        total[r["slice"] * SLICE : (r["slice"] + 1) * SLICE] = r["values"]
    return total[:size]


def finite(vector: str) -> Column:
    """Whether an array of doubles is there and holds no null, infinity or NaN."""
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.col(vector).isNotNull() & F.coalesce(good, F.lit(False))


def usual_length(rows: DataFrame, vector: str) -> int:
    """The most frequent length of the vectors, the smaller one at a tie, 0 without any."""
    found = rows.groupBy(F.size(vector).alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    return found[0]["d"] if found else 0
