"""The graph type: checked columns, degrees, triplets and algorithm entry points."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sightline.operators.skew import lookup_join
from sightline.session import cut


class Graph:
    """Vertices with a unique ``id`` and edges with ``src`` and ``dst``.

    ``two_way`` states that every edge is there in both directions, as often, which
    spares the algorithms that ignore direction or follow it back from adding it.
    """

    def __init__(self, vertices: DataFrame, edges: DataFrame, two_way: bool = False):
        for frame, kind, names in (
            (vertices, "vertex", ["id"]),
            (edges, "edge", ["src", "dst"]),
        ):
            for name in names:
                if name not in frame.columns:
                    raise ValueError(
                        f"the {kind} table has no column {name!r}, only {frame.columns}"
                    )
        self.vertices = vertices
        self.edges = edges
        self.two_way = two_way

    def __repr__(self) -> str:
        return f"Graph(vertices={self.vertices.columns}, edges={self.edges.columns})"

    def persist(self, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> Graph:
        self.vertices.persist(level)
        self.edges.persist(level)
        return self

    def cache(self) -> Graph:
        return self.persist()

    def unpersist(self, blocking: bool = False) -> Graph:
        self.vertices.unpersist(blocking)
        self.edges.unpersist(blocking)
        return self

    @property
    def outDegrees(self) -> DataFrame:
        return self.edges.groupBy(F.col("src").alias("id")).agg(
            F.count("*").cast("int").alias("outDegree")
        )

    @property
    def inDegrees(self) -> DataFrame:
        return self.edges.groupBy(F.col("dst").alias("id")).agg(
            F.count("*").cast("int").alias("inDegree")
        )

    @property
    def degrees(self) -> DataFrame:
        ends = self.edges.select(F.explode(F.array("src", "dst")).alias("id"))
        return ends.groupBy("id").agg(F.count("*").cast("int").alias("degree"))

    @property
    def triplets(self) -> DataFrame:
        """Every edge with both its vertices, as structs ``src``, ``edge``, ``dst``."""
        # Ids and structs are put together after the joins: rows move with each id once.
        names, columns = self.edges.columns, self.vertices.columns
        others = [c for c in columns if c != "id"]
        edges = cut(self.edges)
        joined, plain, size = edges, edges, edges.count()
        for end in ("src", "dst"):
            side = self.vertices.select(F.col("id").alias(end), F.struct(F.lit(1).alias("_"), *others).alias(f"_{end}"))
            joined = lookup_join(joined, side, end, at_most=size, counted=plain)
        ends = [
            F.struct(*[(F.col(end) if c == "id" else F.col(f"_{end}")[c]).alias(c) for c in columns]).alias(end)
            for end in ("src", "dst")
        ]
        return joined.select(ends[0], F.struct(*names).alias("edge"), ends[1])

    def find(self, pattern: str) -> DataFrame:
        from sightline.graph.motifs import find

        return find(self, pattern)

    def bfs(
        self,
        fromExpr: str,
        toExpr: str,
        edgeFilter: str | None = None,
        maxPathLength: int = 10,
    ) -> DataFrame:
        from sightline.graph.paths import breadth_first_paths

        return breadth_first_paths(self, fromExpr, toExpr, edgeFilter, maxPathLength)

    def shortestPaths(self, landmarks: list) -> DataFrame:
        """All vertices with a map from reachable landmark to number of hops."""
        from sightline.graph.paths import landmark_distances

        found = landmark_distances(self, landmarks)
        entries = F.map_from_entries(F.collect_list(F.struct("landmark", "distance")))
        maps = found.groupBy("id").agg(entries.alias("distances"))
        empty = F.create_map().cast(maps.schema["distances"].dataType)
        joined = self.vertices.join(maps, "id", "left")
        return joined.withColumn("distances", F.coalesce("distances", empty))

    def connectedComponents(self, maxIter: int = 1000) -> DataFrame:
        from sightline.graph.components import connected_components

        return self.vertices.join(connected_components(self, maxIter), "id")

    def stronglyConnectedComponents(self, maxIter: int) -> DataFrame:
        from sightline.graph.components import strong_components

        return self.vertices.join(strong_components(self, maxIter), "id")

    def labelPropagation(self, maxIter: int) -> DataFrame:
        from sightline.graph.ranking import propagate_labels

        return self.vertices.join(
            propagate_labels(self, maxIter).withColumnRenamed("label", "_label"), "id"
        ).withColumn("label", F.col("_label")).drop("_label")

    def pageRank(
        self,
        resetProbability: float = 0.15,
        sourceId=None,
        maxIter: int | None = None,
        tol: float | None = None,
    ) -> Graph:
        from sightline.graph.ranking import page_rank

        return page_rank(self, resetProbability, sourceId, maxIter, tol)

    def triangleCount(self) -> DataFrame:
        from sightline.graph.triangles import triangle_counts

        return self.vertices.join(triangle_counts(self), "id")

    def svdPlusPlus(self, **settings):
        from sightline.graph.factors import svd_plus_plus

        return svd_plus_plus(self, **settings)
