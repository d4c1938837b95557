"""Triangles through every vertex, edge direction and repeats ignored."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sightline.operators.skew import HEAVY_ROWS, lookup_join
from sightline.session import cut

# From so many pairs on, neighbour lists are hashed part by part.
HASHED_PAIRS = 10_000_000


def triangle_counts(graph, min_heavy: int = HEAVY_ROWS) -> DataFrame:
    """(id, count) for every vertex, 0 included.

    Edges point from the end with fewer neighbours to the end with more. A
    vertex then has at most sqrt(2 m) edges out, m being the number of edges,
    so a neighbour list is short even around a hub. Each edge intersects the
    lists of its two ends: only real triangles are ever formed.
    """
    a, b = F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b")
    proper = F.col("src") < F.col("dst") if graph.two_way else F.col("src") != F.col("dst")
    pairs = cut(graph.edges.where(proper).select(a, b).distinct())
    size = pairs.count()
    ends = pairs.select(F.explode(F.array("a", "b")).alias("id"))
    degrees = cut(ends.groupBy("id").agg(F.count("*").alias("d")))
    ranked = pairs
    for end in ("a", "b"):
        side = degrees.select(F.col("id").alias(end), F.col("d").alias(f"d{end}"))
        ranked = lookup_join(
            ranked, side, end, min_rows=min_heavy, at_most=size, counted=pairs
        )
    a_first = F.struct(F.col("da"), F.col("a")) < F.struct(F.col("db"), F.col("b"))
    oriented = cut(
        ranked.select(
            F.when(a_first, F.col("a")).otherwise(F.col("b")).alias("u"),
            F.when(a_first, F.col("b")).otherwise(F.col("a")).alias("v"),
        )
    )
    lists = cut(oriented.groupBy("u").agg(F.collect_list("v").alias("next")))
    ends_of_v = lists.select(F.col("u").alias("v"), F.col("next").alias("beyond"))
    if size >= HASHED_PAIRS:
        # Too many to broadcast, but few next to the wings: hashed, so that wings are not sorted.
        ends_of_v = ends_of_v.hint("shuffle_hash")
    # A list of one has no second corner.
    pairs_out = lists.where(F.size("next") > 1).select("u", F.explode("next").alias("v"), "next")
    wings = lookup_join(
        pairs_out, ends_of_v, "v", min_rows=min_heavy, at_most=size, counted=oriented,
    )
    common = F.array_intersect("next", "beyond")
    closed = wings.select("u", "v", common.alias("w")).where(F.size("w") > 0)
    n = F.size("w").cast("long")
    corners = F.concat(
        F.array(
            F.struct(F.col("u").alias("id"), n.alias("n")),
            F.struct(F.col("v").alias("id"), n.alias("n")),
        ),
        F.transform("w", lambda x: F.struct(x.alias("id"), F.lit(1).cast("long").alias("n"))),
    )
    none = graph.vertices.select("id", F.lit(0).cast("long").alias("n"))
    return (
        closed.select(F.inline(corners))
        .unionByName(none)
        .groupBy("id")
        .agg(F.sum("n").alias("count"))
    )
