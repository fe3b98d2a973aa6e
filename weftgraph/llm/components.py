"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftgraph.llm.common import in_tasks, stored


def _smallest_neighbour(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("m"))


def _large_star(edges: DataFrame, rows: int) -> DataFrame:
    """Ties every larger neighbour of a node to the smallest node among it and its neighbours."""
    both = stored(
        edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))), "both-ways"
    )
    smallest = stored(
        in_tasks(_smallest_neighbour(both).select("u", F.least("u", "m").alias("m")), rows),
        "smallest",
    )
    return (
        both.where("v > u").join(smallest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    )


def _small_star(edges: DataFrame, rows: int) -> DataFrame:
    """Ties a node and its smaller neighbours to the smallest of them."""
    downwards = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    down = stored(in_tasks(downwards.distinct(), rows), "downwards")
    smallest = stored(in_tasks(_smallest_neighbour(down), rows), "smallest")
    tied = down.join(smallest, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return in_tasks(tied.unionByName(smallest.select("u", F.col("m").alias("v"))).distinct(), rows)


def _are_stars(edges: DataFrame) -> bool:
    """True if every node is either tied to one other or has others tied to it."""
    ends = F.array(
        F.struct(F.col("u").alias("node"), F.lit(1).alias("tied"), F.lit(0).alias("root")),
        F.struct(F.col("v").alias("node"), F.lit(0).alias("tied"), F.lit(1).alias("root")),
    )
    nodes = (
        edges.select(F.inline(ends))
        .groupBy("node")
        .agg(F.sum("tied").alias("tied"), F.max("root").alias("root"))
    )
    return nodes.where("tied + root > 1").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for the nodes of stored ``edges`` ``(u, v)``; the smallest node names it.

    Alternates large and small stars until every component is one star. A step costs a few
    shuffles of the edges; the number of steps grows with the logarithm of the longest
    chain. Minima are combined before the shuffle and joins are of plain tables, which
    Spark splits where a node has very many edges. No edge ever reaches the driver.
    """
    rows = edges.count()
    current = stored(_small_star(edges.select("u", "v").where("u <> v"), rows), "stars")
    while not _are_stars(current):
        current = stored(_small_star(_large_star(current, rows), rows), "stars")
    roots = current.select(F.col("v").alias("node")).distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        roots.select("node", F.col("node").alias("component"))
    )
