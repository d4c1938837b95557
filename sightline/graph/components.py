"""Connected and strongly connected components."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sightline.graph.links import Links, both_ways
from sightline.operators.skew import HEAVY_ROWS, lookup_join
from sightline.session import cut

# Random ranks tried side by side in a round of strong components.
RANKS = 3


def _hooked(links: Links, states: DataFrame, value: str) -> DataFrame:
    """Smallest ``value`` among a vertex and the vertices that point to it."""
    sent = links.meet(states.select("id", value)).select(
        F.col("dst").alias("id"), value, F.lit(None).cast(states.schema[value].dataType).alias("was")
    )
    own = states.select("id", value, F.col(value).alias("was"))
    return (
        own.unionByName(sent)
        .groupBy("id")
        .agg(F.min(value).alias(value), F.max("was").alias("was"))
        .where(F.col("was").isNotNull())
    )


def connected_components(
    graph, max_iter: int = 1000, min_heavy: int = HEAVY_ROWS
) -> DataFrame:
    """``component`` is the smallest vertex id that can be reached ignoring direction.

    A round takes the smallest label of the neighbours, then the label of the
    vertex that label names. The second step roughly doubles the distance
    covered, so long chains end in few rounds.
    """
    edges = graph.edges.select("src", "dst").where(F.col("src") != F.col("dst"))
    links = Links(edges if graph.two_way else both_ways(edges).distinct(), min_heavy)
    states = cut(graph.vertices.select("id", F.col("id").alias("component")))
    size = states.count()
    for _ in range(max_iter):
        near = cut(_hooked(links, states, "component"))
        names = near.select(F.col("id").alias("component"), F.col("component").alias("next"))
        # Many vertices may carry one label: this join is skewed by nature.
        far = lookup_join(near, names, "component", min_rows=min_heavy, at_most=size)
        states = cut(far.select("id", F.col("next").alias("component"), "was"))
        if not states.where(F.col("component") != F.col("was")).take(1):
            links.close()
            return states.select("id", "component")
        states = states.select("id", "component")
    raise RuntimeError(f"components did not settle in {max_iter} rounds")


def _trimmed(edges: DataFrame, min_heavy: int, size: int) -> DataFrame:
    """Edges whose source is also a target and whose target is also a source."""
    sources = edges.select(F.col("src").alias("id")).distinct()
    targets = edges.select(F.col("dst").alias("id")).distinct()
    on_cycles = cut(sources.join(targets, "id"))
    kept = edges
    for end in ("src", "dst"):
        marks = on_cycles.select(F.col("id").alias(end), F.lit(True).alias("_in"))
        kept = lookup_join(
            kept, marks, end, min_rows=min_heavy, at_most=size, counted=edges
        ).drop("_in")
    return kept.select("src", "dst")


def _least_labels(links: Links, states: DataFrame, min_heavy: int, size: int) -> DataFrame:
    """For each label column, the least label among a vertex and all that lead to it.

    A label names a vertex, and what leads there leads on, so a round may also
    take the label of the vertex that a label names. That roughly doubles the
    distance covered.
    """
    names = [c for c in states.columns if c != "id"]
    while True:
        sent = links.meet(states).select(F.col("dst").alias("id"), *names, F.lit(False).alias("_own"))
        own = states.withColumn("_own", F.lit(True))
        least = [F.min(c).alias(c) for c in names]
        was = [F.max(F.when(F.col("_own"), F.col(c))).alias(f"_{c}") for c in names]
        near = own.unionByName(sent).groupBy("id").agg(*least, *was, F.max("_own").alias("_own"))
        near = cut(near.where("_own").drop("_own"))
        changed = F.lit(False)
        for c in names:
            changed = changed | (F.col(c) != F.col(f"_{c}"))
        if not near.where(changed).take(1):
            return near.select("id", *names)
        label = F.posexplode(F.array(*names))
        long = near.select("id", label.alias("_k", "_label"))
        long = long.withColumn("_at", F.struct("_k", F.col("_label.id").alias("id")))
        ahead = near.select("id", label.alias("_k", "_next")).select(F.struct("_k", "id").alias("_at"), "_next")
        # Many vertices may carry one label: this join is skewed by nature.
        far = lookup_join(long, ahead, "_at", min_rows=min_heavy, at_most=size * len(names))
        nearer = F.least("_label", "_next")
        states = cut(
            far.groupBy("id").agg(*[F.min(F.when(F.col("_k") == k, nearer)).alias(c) for k, c in enumerate(names)])
        )


def strong_components(graph, max_iter: int = 0, min_heavy: int = HEAVY_ROWS) -> DataFrame:
    """``component`` is the smallest id of the strongly connected component.

    A round gives every vertex a few random ranks and finds, for each, the vertex
    of least rank that leads to it and the one that it leads to. Where both are
    one, the vertex shares a cycle with that one and is settled. Vertices of one
    component agree in all these labels, so edges between different labels lie on
    no cycle and go. The vertex of least rank in each part that is left always
    settles, and random ranks about halve the parts, so few rounds do.

    The result is exact: ``max_iter``, kept for callers that pass a limit, stops
    nothing. Vertices on no cycle are components of their own. Where every edge
    leads back, what is connected is strongly connected.
    """
    vertices = graph.vertices.select("id")
    if graph.two_way:
        named = connected_components(graph, min_heavy=min_heavy)
        joined = vertices.join(named, "id", "left")
        return joined.select("id", F.coalesce("component", "id").alias("component"))
    edges = cut(graph.edges.select("src", "dst").where(F.col("src") != F.col("dst")).distinct())
    size = edges.count()
    settled: DataFrame | None = None
    turn = 0
    while True:
        edges = cut(_trimmed(edges, min_heavy, size))
        if not edges.take(1):
            break
        turn += 1
        active = edges.select(F.explode(F.array("src", "dst")).alias("id")).distinct()
        ranks = {
            f"l{k}": F.struct(F.xxhash64(F.lit(turn), F.lit(k), F.col("id")).alias("rank"), F.col("id").alias("id"))
            for k in range(RANKS)
        }
        start = cut(active.withColumns(ranks))
        back = edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"))
        ends = []
        for way in (edges, back):
            links = Links(way, min_heavy, is_cut=way is edges)
            ends.append(_least_labels(links, start, min_heavy, size).select("id", F.struct(*ranks).alias("labels")))
            links.close()
        met = ends[0].join(ends[1].withColumnRenamed("labels", "back"), "id")
        root = F.coalesce(*[F.when(F.col(f"labels.{c}") == F.col(f"back.{c}"), F.col(f"labels.{c}.id")) for c in ranks])
        placed = cut(met.select("id", F.struct("labels", "back").alias("labels"), root.alias("root")))
        found = placed.where("root is not null").select("id", "root")
        settled = found if settled is None else cut(settled.unionByName(found))
        # Only edges whose ends agree in all labels can lie on a cycle.
        open_ends = placed.where("root is null")
        inner = edges
        for end in ("src", "dst"):
            named = open_ends.select(F.col("id").alias(end), F.col("labels").alias(f"{end}_labels"))
            inner = lookup_join(inner, named, end, min_rows=min_heavy, at_most=size, counted=edges)
        edges = cut(inner.where(F.col("src_labels") == F.col("dst_labels")).select("src", "dst"))
    if settled is None:
        return vertices.select("id", F.col("id").alias("component"))
    smallest = settled.groupBy("root").agg(F.min("id").alias("component"))
    named = lookup_join(settled, smallest, "root", min_rows=min_heavy, at_most=size).select("id", "component")
    joined = vertices.join(named, "id", "left")
    return joined.select("id", F.coalesce("component", "id").alias("component"))
