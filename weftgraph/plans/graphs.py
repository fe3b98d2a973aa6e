"""Graphs derived from the star-schema tables.

Every builder is linear in its tables: a row of ``lineitem`` yields a fixed
number of edges, and no two rows of a group are ever paired. Ids of different
kinds of vertices are interleaved, so they stay apart at any scale.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftgraph.graph import Graph
from weftgraph.operators.edges import symmetrize

# Vertex id = key x number of kinds + kind.
KINDS = 4
PART, SUPPLIER, CUSTOMER, ORDER = 0, 1, 2, 3
GEO_REGION, GEO_NATION, GEO_SUPPLIER, GEO_CUSTOMER = 0, 1, 2, 3


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _vertex(key: str, kinds: int, kind: int):
    return F.col(key).cast("bigint") * kinds + kind


def part_vertices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(_vertex("p_partkey", KINDS, PART).alias("id"), F.col("p_type").alias("attr"))


def trade_vertices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts with their type; suppliers and customers with their nation."""
    nation = table(spark, sf_dir, "nation")
    supplier = table(spark, sf_dir, "supplier").select(
        _vertex("s_suppkey", KINDS, SUPPLIER).alias("id"), F.col("s_nationkey").alias("n_nationkey")
    )
    customer = table(spark, sf_dir, "customer").select(
        _vertex("c_custkey", KINDS, CUSTOMER).alias("id"), F.col("c_nationkey").alias("n_nationkey")
    )
    placed = supplier.unionByName(customer).join(nation, "n_nationkey")
    return part_vertices(spark, sf_dir).unionByName(
        placed.select("id", F.col("n_name").alias("attr"))
    )


def _sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey)


def trade_edge_list(spark: SparkSession, sf_dir: str, condition: str = "true") -> DataFrame:
    """Part, supplier and customer of every line sold, linked two by two."""
    part, supplier, customer = (
        _vertex("l_partkey", KINDS, PART),
        _vertex("l_suppkey", KINDS, SUPPLIER),
        _vertex("o_custkey", KINDS, CUSTOMER),
    )
    ends = [(part, supplier), (part, customer), (supplier, customer)]
    links = F.array(*[F.struct(x.alias("a"), y.alias("b")) for x, y in ends])
    return _sales(spark, sf_dir).where(condition).select(F.inline(links))


def trade_graph(spark: SparkSession, sf_dir: str) -> Graph:
    """Dense, with suppliers as hubs and at least one triangle per line."""
    return Graph(trade_vertices(spark, sf_dir), symmetrize(trade_edge_list(spark, sf_dir)))


def order_graph(spark: SparkSession, sf_dir: str) -> Graph:
    """Sparse and deep: orders with lines, linked to their customer, parts and suppliers.

    Orders without lines and customers without orders are isolated.
    """
    customers = table(spark, sf_dir, "customer").select(
        _vertex("c_custkey", KINDS, CUSTOMER).alias("id"), F.col("c_mktsegment").alias("attr")
    )
    suppliers = table(spark, sf_dir, "supplier").select(
        _vertex("s_suppkey", KINDS, SUPPLIER).alias("id"), F.lit("supplier").alias("attr")
    )
    orders = table(spark, sf_dir, "orders").select(
        _vertex("o_orderkey", KINDS, ORDER).alias("id"), F.col("o_orderpriority").alias("attr")
    )
    order = _vertex("o_orderkey", KINDS, ORDER).alias("a")
    ends = [
        _vertex(key, KINDS, kind).alias("b")
        for key, kind in (("o_custkey", CUSTOMER), ("l_partkey", PART), ("l_suppkey", SUPPLIER))
    ]
    links = _sales(spark, sf_dir).select(F.inline(F.array(*[F.struct(order, end) for end in ends])))
    vertices = part_vertices(spark, sf_dir).unionByName(suppliers).unionByName(customers)
    return Graph(vertices.unionByName(orders), symmetrize(links))


def hub_graph(spark: SparkSession, sf_dir: str) -> Graph:
    """Customers with their nation and segment, and nations with segments.

    Every edge has one of the few nations or segments as an end, so these hold nearly all
    edges, at any scale.
    """
    customer = table(spark, sf_dir, "customer")
    segment = F.pmod(F.conv(F.substring(F.md5(F.col("c_mktsegment").cast("binary")), 1, 7), 16, 10).cast("bigint"), F.lit(1 << 20))
    ends = customer.select(
        _vertex("c_custkey", KINDS, CUSTOMER).alias("c"),
        _vertex("c_nationkey", KINDS, SUPPLIER).alias("n"),
        (segment * KINDS + PART).alias("s"),
    )
    pairs = F.array(
        *[F.struct(F.col(x).alias("a"), F.col(y).alias("b")) for x, y in (("c", "n"), ("c", "s"), ("n", "s"))]
    )
    vertices = ends.select(F.explode(F.array("c", "n", "s")).alias("id")).distinct()
    return Graph(vertices.withColumn("attr", F.lit("any")), symmetrize(ends.select(F.inline(pairs))))


def geo_graph(spark: SparkSession, sf_dir: str) -> Graph:
    """A forest of regions, nations, suppliers and customers, with the region as attribute."""
    nation = table(spark, sf_dir, "nation")
    kinds = 4
    nation_id = _vertex("n_nationkey", kinds, GEO_NATION)
    placed = (
        table(spark, sf_dir, "customer")
        .select(_vertex("c_custkey", kinds, GEO_CUSTOMER).alias("id"), F.col("c_nationkey").alias("n_nationkey"))
        .unionByName(
            table(spark, sf_dir, "supplier").select(
                _vertex("s_suppkey", kinds, GEO_SUPPLIER).alias("id"), F.col("s_nationkey").alias("n_nationkey")
            )
        )
    )
    region_of = F.col("n_regionkey").cast("string").alias("attr")
    vertices = (
        placed.join(nation, "n_nationkey")
        .select("id", region_of)
        .unionByName(nation.select(nation_id.alias("id"), region_of))
        .unionByName(
            table(spark, sf_dir, "region").select(
                _vertex("r_regionkey", kinds, GEO_REGION).alias("id"), F.col("r_regionkey").cast("string").alias("attr")
            )
        )
    )
    links = placed.select(nation_id.alias("a"), F.col("id").alias("b")).unionByName(
        nation.select(_vertex("n_regionkey", kinds, GEO_REGION).alias("a"), nation_id.alias("b"))
    )
    return Graph(vertices, symmetrize(links))
