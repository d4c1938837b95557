"""Connected components of links between numbered things."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sightline.session import cut


def components(links: DataFrame) -> DataFrame:
    """(key, root) of every key in ``links`` (a, b): the smallest key reachable.

    A round takes the least label around, by partial minima, so a hub is no hot
    spot, and then the label of the label, which halves the way to the root.
    """
    both = cut(links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = cut(both.groupBy(F.col("a").alias("key")).agg(F.min(F.least("a", "b")).alias("root")))
    while True:
        near = both.join(labels, both["b"] == labels["key"]).groupBy("a").agg(F.min("root").alias("least"))
        moved = cut(
            labels.join(near, labels["key"] == near["a"]).select("key", F.col("root").alias("old"), F.least("root", "least").alias("root"))
        )
        named = moved.select(F.col("key").alias("_key"), F.col("root").alias("_root"))
        labels = cut(moved.join(named, moved["root"] == named["_key"]).select("key", "old", F.least("root", "_root").alias("root")))
        if labels.where("root <> old").isEmpty():
            return labels.select("key", "root")
