"""Degrees and their distribution."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def out_degree(edges: DataFrame) -> DataFrame:
    """``(src, degree)`` of every vertex with an edge."""
    return edges.groupBy("src").agg(F.count(F.lit(1)).alias("degree"))


def vertex_degree(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """``(id, degree)`` of every vertex, 0 for isolated ones."""
    degrees = out_degree(edges).withColumnRenamed("src", "id")
    return (
        vertices.select("id")
        .join(degrees, "id", "left")
        .select("id", F.coalesce("degree", F.lit(0).cast("bigint")).alias("degree"))
    )


def degree_stats(
    edges: DataFrame, vertices: DataFrame | None = None, include_isolated: bool = False
) -> DataFrame:
    """Mean, population standard deviation and maximum of the degree.

    Isolated vertices count only when asked for, which needs ``vertices``.
    """
    if include_isolated and vertices is None:
        raise ValueError("include_isolated needs the vertices")
    degrees = vertex_degree(vertices, edges) if include_isolated else out_degree(edges)
    return degrees.agg(
        F.count(F.lit(1)).alias("n_vertices"),
        F.avg("degree").alias("avg_degree"),
        F.stddev_pop("degree").alias("std_degree"),
        F.max("degree").alias("max_degree"),
    )


def degree_local(edges: DataFrame, vertex: int | None = None, bucket=None) -> DataFrame:
    """The degree of one vertex; without one, of the smallest id with an edge."""
    if vertex is None:
        wanted = F.col("src") == edges.agg(F.min("src")).scalar()
        shown = F.min("src")
    else:
        wanted = F.col("src") == F.lit(vertex)
        shown = F.lit(vertex).cast("bigint")
    found = edges.where(wanted)
    if bucket is not None:
        found = found.where(bucket)
    return found.agg(shown.alias("node_id"), F.count(F.lit(1)).alias("degree"))


def degree_histogram(edges: DataFrame) -> DataFrame:
    """Vertices per power of two of the degree, as ``(bin, low, high, n_vertices)``."""
    width = F.length(F.bin("degree")) - 1
    return (
        out_degree(edges)
        .groupBy(width.alias("bin"))
        .agg(F.count(F.lit(1)).alias("n_vertices"))
        .select(
            "bin",
            F.expr("shiftleft(1L, bin)").alias("low"),
            F.expr("shiftleft(1L, bin + 1) - 1").alias("high"),
            "n_vertices",
        )
    )


def graph_counts(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """Vertices, undirected edges and the mean degree 2E/V, from one pass over each."""
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    once = F.when(F.col("src") <= F.col("dst"), one).otherwise(none)
    tally = vertices.select(one.alias("v"), none.alias("e")).unionAll(
        edges.select(none.alias("v"), once.alias("e"))
    )
    sums = tally.agg(
        F.coalesce(F.sum("v"), none).alias("v"), F.coalesce(F.sum("e"), none).alias("e")
    )
    return sums.select(
        F.col("v").alias("n_vertices"),
        F.col("e").alias("n_edges"),
        (2 * F.col("e") / F.nullif(F.col("v"), F.lit(0))).alias("mean_degree"),
    )
