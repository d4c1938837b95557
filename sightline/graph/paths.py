"""Shortest paths between vertex sets and hop counts to landmarks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sightline.graph.links import Links
from sightline.operators.skew import HEAVY_ROWS, lookup_join
from sightline.session import cut


def _ending_in(
    edges: DataFrame, end: str, ids: DataFrame, min_heavy: int, size: int
) -> DataFrame:
    marks = ids.select(F.col("id").alias(end), F.lit(True).alias("_in"))
    return lookup_join(edges, marks, end, min_rows=min_heavy, at_most=size).drop("_in")


def breadth_first_paths(
    graph,
    from_expr: str,
    to_expr: str,
    edge_filter: str | None = None,
    max_length: int = 10,
    min_heavy: int = HEAVY_ROWS,
) -> DataFrame:
    """All shortest paths from the vertices matching one condition to those matching another.

    Columns are ``from, e0, v1, e1, ..., to``. Distances are settled level by
    level over distinct vertices; paths are only spelled out afterwards, over
    the edges that lie on one.
    """
    packed = graph.vertices.select("id", F.struct(*graph.vertices.columns).alias("v"))
    sources, targets = graph.vertices.where(from_expr), graph.vertices.where(to_expr)
    here = F.struct(*graph.vertices.columns)
    at_once = sources.where(to_expr).select(here.alias("from"), here.alias("to"))
    if at_once.take(1):
        return at_once

    edges = graph.edges if edge_filter is None else graph.edges.where(edge_filter)
    edges = cut(edges.select("src", "dst", F.struct(*graph.edges.columns).alias("e")))
    links = Links(edges.select("src", "dst").distinct(), min_heavy)
    size = edges.count()
    levels = [cut(sources.select("id").distinct())]
    visited = levels[0]
    hits = None
    for _ in range(max_length):
        step = links.meet(levels[-1]).select(F.col("dst").alias("id")).distinct()
        frontier = cut(step.join(visited, "id", "left_anti"))
        if not frontier.take(1):
            break
        levels.append(frontier)
        reached = cut(frontier.join(targets.select("id"), "id", "left_semi"))
        if reached.take(1):
            hits = reached
            break
        visited = cut(visited.unionByName(frontier))
    links.close()
    if hits is None:
        return at_once

    # From the hits back: keep the edges between neighbouring levels that lead to one.
    wanted, steps = hits, []
    for level in reversed(levels[:-1]):
        step = _ending_in(edges, "src", level, min_heavy, size)
        step = cut(_ending_in(step, "dst", wanted, min_heavy, size))
        steps.insert(0, step)
        wanted = step.select(F.col("src").alias("id")).distinct()

    names = ["from", *[f"v{i}" for i in range(1, len(steps))], "to"]
    paths = None
    for i, step in enumerate(steps):
        leg = step.select(
            F.col("src").alias(f"_{names[i]}"), F.col("dst").alias(f"_{names[i + 1]}"),
            F.col("e").alias(f"e{i}"),
        )
        paths = leg if paths is None else paths.join(leg, f"_{names[i]}")
    paths = cut(paths)
    found, plain = paths.count(), paths
    for name in names:
        side = packed.select(F.col("id").alias(f"_{name}"), F.col("v").alias(name))
        paths = lookup_join(
            paths, side, f"_{name}", min_rows=min_heavy, at_most=found, counted=plain
        )
    order = [names[0]]
    for i, name in enumerate(names[1:]):
        order += [f"e{i}", name]
    return paths.select(*order)


def landmark_distances(graph, landmarks: list, min_heavy: int = HEAVY_ROWS) -> DataFrame:
    """Long form (id, landmark, distance): hops along edge direction to each landmark."""
    reverse = graph.edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"))
    links = Links(reverse.where(F.col("src") != F.col("dst")).distinct(), min_heavy)
    start = graph.vertices.where(F.col("id").isin(*landmarks))
    frontier = cut(start.select("id", F.col("id").alias("landmark"), F.lit(0).alias("distance")))
    known = frontier
    while frontier.take(1):
        step = links.meet(frontier).groupBy(F.col("dst").alias("id"), "landmark").agg(
            (F.min("distance") + 1).alias("distance")
        )
        seen = known.select("id", "landmark")
        frontier = cut(step.join(seen, ["id", "landmark"], "left_anti"))
        known = cut(known.unionByName(frontier))
    links.close()
    return known
