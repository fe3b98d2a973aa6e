"""Attributed-graph analytics on Spark DataFrames."""

from weftgraph.graph import Graph

__all__ = ["Graph"]
