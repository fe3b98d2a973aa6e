"""The graph as a pair of DataFrames."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class Graph:
    """An undirected graph whose vertices carry attributes.

    ``vertices`` has a unique ``id`` and the attribute columns. ``edges`` has
    ``src`` and ``dst`` and holds every undirected edge in both directions, so
    the neighbours of ``x`` are the rows with ``src = x``.
    """

    vertices: DataFrame
    edges: DataFrame
