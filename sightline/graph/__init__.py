"""Property graphs as two DataFrames, and the algorithms over them."""

from sightline.graph.core import Graph

__all__ = ["Graph"]
