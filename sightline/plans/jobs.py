"""Jobs that keep what they compute: graph tables and the analyses of the graph, each built when needed."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sightline.graph.build import graph_edges, graph_vertices
from sightline.graph.core import Graph
from sightline.sources.writers import materialize

ANALYSES = {
    "ranks": lambda g: g.pageRank(resetProbability=0.15, maxIter=20).vertices.select("id", "pagerank"),
    "strong": lambda g: g.stronglyConnectedComponents(20).select("id", "component"),
    "triangles": lambda g: g.triangleCount().select("id", F.col("count").alias("triangles")),
    "communities": lambda g: g.labelPropagation(100).select("id", F.col("label").alias("community")),
}


def graph_job(spark: SparkSession, sightings_path: str, folder: str, depth: int = 2) -> Graph:
    """The graph of the sightings stored at a path, from the tables kept in ``folder`` while they are up to date."""

    def table(name: str, build) -> DataFrame:
        return materialize(
            spark,
            f"{folder}/{name}",
            lambda: build(spark.read.parquet(sightings_path), depth),
            inputs=[sightings_path],
            settings=f"{name} depth={depth}",
        )

    return Graph(table("vertices", graph_vertices), table("edges", graph_edges))


def analysis_job(
    spark: SparkSession, sightings_path: str, folder: str, names: Iterable[str] = tuple(ANALYSES), depth: int = 2
) -> dict[str, DataFrame]:
    """The named analyses, each kept in ``folder`` and rebuilt only after the graph tables were."""
    graph = graph_job(spark, sightings_path, folder, depth)
    inputs = [f"{folder}/vertices", f"{folder}/edges"]
    return {
        name: materialize(spark, f"{folder}/{name}", lambda n=name: ANALYSES[n](graph), inputs, name)
        for name in names
    }
