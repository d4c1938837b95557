"""Edges laid out once for repeated joins with a table of vertex states."""

from __future__ import annotations

import math

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sightline.operators.skew import HEAVY_KEYS, HEAVY_ROWS, heavy_keys
from sightline.session import cut


# Rows of one part of the edges.
PART_ROWS = 2_000_000


def shuffle_width(frame: DataFrame) -> int:
    return int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def spread_by(frame: DataFrame, key: str, rows: int = 0) -> DataFrame:
    """Hash-partition and sort by ``key`` in a fixed number of parts, so later joins can rely on both.

    The parts grow in number and not in size where there are many ``rows``.
    """
    parts = max(shuffle_width(frame), math.ceil(rows / PART_ROWS))
    return frame.repartition(parts, key).sortWithinPartitions(key)


def both_ways(edges: DataFrame) -> DataFrame:
    """Every edge in both directions."""
    ends = F.inline(
        F.array(
            F.struct(F.col("src"), F.col("dst")),
            F.struct(F.col("dst").alias("src"), F.col("src").alias("dst")),
        )
    )
    return edges.select(ends)


class Links:
    """Edges from ``src``, held ready for rounds of joins on ``src``.

    Most edges are partitioned by ``src`` once, so a round moves vertex states
    and not edges. The edges of vertices with very many of them stay spread
    over all tasks, and meet the states of those vertices by broadcast; their
    number is bounded by ``heavy_keys``.
    """

    def __init__(
        self,
        edges: DataFrame,
        min_rows: int = HEAVY_ROWS,
        keep: int = HEAVY_KEYS,
        is_cut: bool = False,
    ):
        edges = edges if is_cut else cut(edges)
        self.rows = edges.count()
        self.has_heavy = False
        if self.rows >= min_rows:
            self.heavy = cut(heavy_keys(edges, "src", min_rows, keep))
            self.has_heavy = bool(self.heavy.take(1))
        if self.has_heavy:
            mark = F.broadcast(self.heavy)
            self.hot = edges.join(mark, "src", "left_semi")
            edges = edges.join(mark, "src", "left_anti")
        # Cached, not only written: a cached table keeps its partitioning and order, so
        # the edges are neither shuffled nor sorted again. A lost part is rebuilt from the written edges.
        self.cold = spread_by(edges, "src", self.rows).persist(StorageLevel.MEMORY_AND_DISK)
        # Filled here: the planner knows the partitioning only of a cache that is filled.
        self.cold.count()

    def close(self) -> None:
        self.cold.unpersist()

    def meet(self, states: DataFrame) -> DataFrame:
        """Edges joined to the states of their sources; ``states`` has ``id``."""
        states = states.withColumnRenamed("id", "src")
        met = self.cold.join(states, "src")
        if self.has_heavy:
            few = states.join(F.broadcast(self.heavy), "src", "left_semi")
            met = met.unionByName(self.hot.join(F.broadcast(few), "src"))
        return met
