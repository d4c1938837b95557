"""PageRank and label propagation: rounds of messages along fixed edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sightline.graph.links import Links, both_ways
from sightline.operators.skew import HEAVY_ROWS, lookup_join
from sightline.session import cut


def weighted_edges(edges: DataFrame, min_heavy: int = HEAVY_ROWS) -> DataFrame:
    """Edges with ``weight`` set to one over the out-degree of their source."""
    others = [c for c in edges.columns if c != "weight"]
    edges = cut(edges.select(*others))
    shares = edges.groupBy("src").agg((F.lit(1.0) / F.count("*")).alias("weight"))
    joined = lookup_join(edges, shares, "src", min_rows=min_heavy, at_most=edges.count())
    return cut(joined.select(*others, "weight"))


def page_rank(
    graph,
    reset: float = 0.15,
    source=None,
    max_iter: int | None = None,
    tol: float | None = None,
    min_heavy: int = HEAVY_ROWS,
):
    """Rank of every vertex; exactly one of ``max_iter`` and ``tol`` ends the rounds.

    All vertices start at 1 and a round sets r = reset + (1 - reset) * inflow.
    With ``source`` only that vertex starts at 1 and only it is reset.
    """
    from sightline.graph.core import Graph

    if (max_iter is None) == (tol is None):
        raise ValueError("set exactly one of maxIter and tol")
    weighted = weighted_edges(graph.edges, min_heavy)
    links = Links(weighted.select("src", "dst", "weight"), min_heavy, is_cut=True)
    if source is None:
        base = F.lit(1.0)
    else:
        base = F.when(F.col("id") == F.lit(source), 1.0).otherwise(0.0)
    ranks = cut(graph.vertices.select("id", base.alias("rank")))

    done = 0
    while True:
        inflow = links.meet(ranks).select(
            F.col("dst").alias("id"),
            (F.col("rank") * F.col("weight")).alias("gain"),
            F.lit(None).cast("double").alias("before"),
        )
        own = ranks.select("id", F.lit(0.0).alias("gain"), F.col("rank").alias("before"))
        # The vertices take part with a gain of 0: no second join is needed to
        # keep those without inflow, and targets that are no vertex drop out.
        ranks = cut(
            own.unionByName(inflow)
            .groupBy("id")
            .agg(F.sum("gain").alias("gain"), F.max("before").alias("before"))
            .where(F.col("before").isNotNull())
            .select(
                "id",
                (reset * base + (1.0 - reset) * F.col("gain")).alias("rank"),
                "before",
            )
        )
        done += 1
        if max_iter is not None:
            if done >= max_iter:
                break
        else:
            moved = ranks.agg(F.max(F.abs(F.col("rank") - F.col("before")))).first()[0]
            if moved is None or moved <= tol:
                break
        ranks = ranks.drop("before")
    links.close()
    result = graph.vertices.join(ranks.select("id", F.col("rank").alias("pagerank")), "id")
    return Graph(result, weighted)


def propagate_labels(graph, max_iter: int, min_heavy: int = HEAVY_ROWS) -> DataFrame:
    """Each round a vertex takes the commonest label around it, ties to the smallest.

    Labels travel against and along every edge, repeated edges count again. A
    vertex without edges keeps its own id.
    """
    if graph.two_way:
        # Each direction would count twice, which changes no order.
        ties = graph.edges.select("src", "dst", F.lit(1).cast("long").alias("times"))
    else:
        # Repeats, and the two directions of one tie, travel as one edge that counts as many.
        ties = both_ways(graph.edges).groupBy("src", "dst").agg(F.count("*").alias("times"))
    links = Links(ties, min_heavy)
    labels = cut(graph.vertices.select("id", F.col("id").alias("label")))
    for _ in range(max_iter):
        sent = links.meet(labels).groupBy(F.col("dst").alias("id"), "label").agg(
            (-F.sum("times")).alias("rank")
        )
        own = labels.select("id", "label", F.lit(0).cast("long").alias("rank"))
        best = F.min(F.struct("rank", "label"))["label"]
        labels = cut(sent.unionByName(own).groupBy("id").agg(best.alias("label")))
    links.close()
    return labels
