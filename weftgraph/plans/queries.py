"""One query per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weftgraph.functions import rounded, to_attribute, to_flag, to_integer, top_k
from weftgraph.graph import Graph
from weftgraph.operators import clustering, degree, edges, mixing, pagerank, paths, results, sample
from weftgraph.plans.graphs import (
    KINDS,
    geo_graph,
    hub_graph,
    order_graph,
    part_vertices,
    table,
    trade_edge_list,
    trade_graph,
    trade_vertices,
)
from weftgraph.plans import metrics
from weftgraph.session import cut, discard, materialize, scratch_path
from weftgraph.sources import csv, tables
from weftgraph.sources.keyed import KeyedTable

Query = Callable[[SparkSession, str], DataFrame]

ADJACENCY_BLOCK = 512
SOURCES = 100
MAX_DEPTH = 6


def _trade_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trade_graph(spark, sf_dir).edges


def _cut(graph: Graph) -> Graph:
    """The graph with its edges stored once each, for operators that read them repeatedly."""
    return Graph(graph.vertices, edges.both_ways(materialize(edges.undirected(graph.edges))[0]))


# --- scans, sinks and keyed writes


def _raw_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as the text of a raw vertex file, with gaps and untidy spellings."""
    gap = F.col("p_partkey") % 7 == 0

    def shown(value: Column) -> Column:
        return F.when(gap, F.lit("")).otherwise(value.cast("string"))

    return table(spark, sf_dir, "part").select(
        F.concat(F.lit(" "), F.col("p_size").cast("string"), F.lit(" ")).alias("views"),
        shown(F.col("p_size") % 2).alias("mature"),
        shown(F.col("p_size")).alias("life_time"),
        F.lit("2020-01-01").alias("created_at"),
        F.lit("2020-01-02").alias("updated_at"),
        F.col("p_partkey").cast("string").alias("numeric_id"),
        F.when(F.col("p_size") % 3 == 0, F.lit(" TRUE ")).otherwise(F.lit("on")).alias("dead_account"),
        F.when(gap, F.lit("")).otherwise(F.concat(F.lit("  "), "p_type", F.lit(" "))).alias("language"),
        F.when(F.col("p_size") % 2 == 0, F.lit("Yes")).otherwise(F.lit("no")).alias("affiliate"),
    )


def read_vertices(spark, sf_dir):
    path = scratch_path(spark, "vertices-csv")
    kept = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    _raw_parts(spark, sf_dir).write.csv(path, header=True, **kept)
    return csv.read_vertices(spark, path)


def read_edges(spark, sf_dir):
    path = scratch_path(spark, "edges-csv")
    edges.undirected(_trade_edges(spark, sf_dir)).write.csv(path, header=True)
    return csv.read_edges(spark, path)


def normalize_flags(spark, sf_dir):
    raw = _raw_parts(spark, sf_dir)
    flags = [to_flag(F.col(c)).alias(c) for c in csv.FLAG_COLUMNS]
    return raw.select(F.col("numeric_id").cast("bigint").alias("id"), *flags)


def normalize_ints(spark, sf_dir):
    raw = _raw_parts(spark, sf_dir)
    numbers = [to_integer(F.col(c), kind).alias(c) for c, kind in csv.INTEGER_COLUMNS.items()]
    return raw.select(F.col("numeric_id").cast("bigint").alias("id"), *numbers)


def normalize_attr(spark, sf_dir):
    raw = _raw_parts(spark, sf_dir)
    return raw.select(
        F.col("numeric_id").cast("bigint").alias("id"), to_attribute(F.col("language")).alias("language")
    )


def symmetrize_edges(spark, sf_dir):
    return edges.symmetrize(trade_edge_list(spark, sf_dir))


def load_counts(spark, sf_dir):
    graph = _cut(trade_graph(spark, sf_dir))
    return tables.write_graph(graph.vertices, graph.edges, scratch_path(spark, "graph"), attr="attr")


def _stored(spark: SparkSession, sf_dir: str) -> tables.StoredGraph:
    """The trade graph as written, for lookups that read what they need of it."""
    graph, path = trade_graph(spark, sf_dir), scratch_path(spark, "graph")
    tables.write_graph(graph.vertices, graph.edges, path, buckets=16, attr="attr")
    return tables.open_graph(spark, path)


def neighbors_stored(spark, sf_dir):
    return edges.neighbors(_stored(spark, sf_dir).edges_of(0), 0)


def degree_local_stored(spark, sf_dir):
    return degree.degree_local(_stored(spark, sf_dir).edges_of(0), 0)


def vertices_with_attr_stored(spark, sf_dir):
    return _stored(spark, sf_dir).vertices_with("ECONOMY")


def stored_edge_order(spark, sf_dir):
    return tables.stored_order(_stored(spark, sf_dir).edges)


def append_absent_edges(spark, sf_dir):
    """Links of finished orders, to which those of all orders are appended twice."""
    graph, path = _cut(trade_graph(spark, sf_dir)), scratch_path(spark, "graph")
    finished = edges.symmetrize(trade_edge_list(spark, sf_dir, "o_orderstatus = 'F'"))
    once, _, spare = cut(edges.undirected(finished))
    tables.write_graph(graph.vertices, edges.both_ways(once), path, attr="attr")
    discard(spark, spare)
    for _ in range(2):
        tables.append_to_graph(spark, path, edges=graph.edges, from_files=True)
    return tables.open_graph(spark, path).graph.edges


def edges_per_bucket_hash(spark, sf_dir):
    return tables.edges_per_bucket(_trade_edges(spark, sf_dir), 8)


def results_json(spark, sf_dir):
    """Degrees written as JSON with the time of the write, and read back."""
    path = scratch_path(spark, "results")
    rows = degree.out_degree(_trade_edges(spark, sf_dir))
    tables.write_results(tables.stamped(rows), path)
    back = tables.read_results(spark, path, "src bigint, degree bigint, written_at timestamp")
    late = F.col("written_at") > F.current_timestamp()
    return back.select("src", "degree", (F.col("written_at").isNotNull() & ~late).alias("stamped"))


def edges_per_bucket(spark, sf_dir):
    return tables.edges_per_bucket(_trade_edges(spark, sf_dir), 8, tables.modulo_shard)


def insert_if_absent(spark, sf_dir):
    """Links of all orders, each offered twice, against those of finished orders."""
    all_edges = _trade_edges(spark, sf_dir)
    stored = edges.symmetrize(trade_edge_list(spark, sf_dir, "o_orderstatus = 'F'"))
    return tables.insert_if_absent(stored, all_edges.unionAll(all_edges), ["src", "dst"])


def append_filtered_edges(spark, sf_dir):
    """Links of finished orders as a keyed table, to which those of all orders are added twice."""
    finished = edges.symmetrize(trade_edge_list(spark, sf_dir, "o_orderstatus = 'F'"))
    stored = KeyedTable.create(finished, scratch_path(spark, "keyed-edges"), ["src", "dst"])
    everything = _cut(trade_graph(spark, sf_dir)).edges
    for _ in range(2):
        stored.append_absent(everything)
    return stored.read()


def upsert_stored(spark, sf_dir):
    """A stored table of the latest event per user, brought up to date by two more batches."""
    log = table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type")
    part = [log.where(F.pmod("event_id", F.lit(3)) == i) for i in range(3)]
    first = tables.upsert_latest(part[0], ["user_id"], "ts", "event_id")
    stored = KeyedTable.create(first, scratch_path(spark, "keyed-events"), ["user_id"])
    for batch in part[1:]:
        stored.upsert(batch, "ts", "event_id")
    return stored.read().select(*log.columns)


def upsert_latest(spark, sf_dir):
    log = table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type")
    return tables.upsert_latest(log, ["user_id"], "ts", "event_id")


def duplicate_keys(spark, sf_dir):
    return tables.duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey"])


def _some_missing(spark, sf_dir):
    """The trade vertices that remain once the parts of brand 1 are withdrawn."""
    gone = table(spark, sf_dir, "part").where("p_brand = 'Brand#1'")
    return trade_vertices(spark, sf_dir).join(
        gone.select((F.col("p_partkey") * KINDS).alias("id")), "id", "left_anti"
    )


def edges_valid(spark, sf_dir):
    return edges.edges_valid(_trade_edges(spark, sf_dir), _some_missing(spark, sf_dir))


def edges_orphan(spark, sf_dir):
    return edges.edges_orphan(_trade_edges(spark, sf_dir), _some_missing(spark, sf_dir))


def graph_counts(spark, sf_dir):
    graph = trade_graph(spark, sf_dir)
    return _rounded(degree.graph_counts(graph.vertices, graph.edges), "mean_degree")


# --- projections and filters


def induced_subgraph(spark, sf_dir):
    return sample.induced_subgraph(trade_graph(spark, sf_dir), 200).edges


def neighbors(spark, sf_dir):
    return edges.neighbors(_trade_edges(spark, sf_dir), 0)


def edge_exists(spark, sf_dir):
    """Lines whose supplier also served a customer with the number of the part."""
    lines = table(spark, sf_dir, "lineitem")
    pairs = lines.select(
        (F.col("l_suppkey") * KINDS + 1).alias("src"),
        (F.col("l_partkey") * KINDS + 2).alias("dst"),
    ).distinct()
    return edges.edge_exists(pairs, _trade_edges(spark, sf_dir))


def vertices_with_attr(spark, sf_dir):
    return mixing.vertices_with_attr(part_vertices(spark, sf_dir), "attr", "ECONOMY")


def vertices_by_attr(spark, sf_dir):
    path = scratch_path(spark, "by-attr")
    tables.write_attr_copy(trade_vertices(spark, sf_dir), path, "attr")
    return spark.read.parquet(f"{path}/vertices_by_attr").select("attr", "id")


def attr_counts(spark, sf_dir):
    return mixing.attr_counts(trade_vertices(spark, sf_dir), "attr")


# --- degrees


def out_degree(spark, sf_dir):
    return degree.out_degree(_trade_edges(spark, sf_dir))


def _rounded(frame: DataFrame, *names: str, digits: int = 6) -> DataFrame:
    """Results as reported: operators return full precision."""
    return frame.withColumns({name: rounded(name, digits) for name in names})


def degree_stats(spark, sf_dir):
    stats = degree.degree_stats(order_graph(spark, sf_dir).edges)
    return _rounded(stats, "avg_degree", "std_degree")


def degree_stats_all(spark, sf_dir):
    graph = order_graph(spark, sf_dir)
    stats = degree.degree_stats(graph.edges, graph.vertices, include_isolated=True)
    return _rounded(stats, "avg_degree", "std_degree")


def degree_local(spark, sf_dir):
    return degree.degree_local(_trade_edges(spark, sf_dir))


def degree_histogram(spark, sf_dir):
    return degree.degree_histogram(_trade_edges(spark, sf_dir))


def adjacency_list(spark, sf_dir):
    blocks = edges.adjacency_list(_trade_edges(spark, sf_dir), ADJACENCY_BLOCK)
    return blocks.select(
        "src", "block", F.size("neighbors").cast("bigint").alias("n"), F.array_join("neighbors", ",").alias("neighbors")
    )


# --- clustering


def _as_bigint(frame: DataFrame) -> DataFrame:
    return frame.withColumn("wedges", F.col("wedges").cast("bigint"))


def wedge_count(spark, sf_dir):
    return _as_bigint(clustering.wedge_count(_trade_edges(spark, sf_dir)))


def triangle_list(spark, sf_dir):
    return clustering.triangle_list(_cut(trade_graph(spark, sf_dir)).edges)


def triangle_count(spark, sf_dir):
    return clustering.triangle_count(_cut(trade_graph(spark, sf_dir)).edges)


def transitivity(spark, sf_dir):
    found = clustering.transitivity(_cut(trade_graph(spark, sf_dir)).edges)
    return _rounded(_as_bigint(found), "transitivity")


def triangles_of_a_hub(spark, sf_dir):
    """Triangles of nation, customer and segment, with hubs of a fifth of all vertices."""
    return clustering.vertex_triangles(_cut(hub_graph(spark, sf_dir)).edges)


def pagerank_of_a_hub(spark, sf_dir):
    """Ranks of a graph whose edges must be cut into slices."""
    return _ranks(_cut(hub_graph(spark, sf_dir)))


def local_cc(spark, sf_dir):
    graph = _cut(trade_graph(spark, sf_dir))
    return clustering.local_cc(graph.vertices, graph.edges).withColumn(
        "coefficient", rounded("coefficient")
    )


def avg_local_cc(spark, sf_dir):
    graph = _cut(trade_graph(spark, sf_dir))
    return _rounded(clustering.avg_local_cc(graph.vertices, graph.edges), "avg_local_cc")


# --- attribute mixing


def edge_attr_join(spark, sf_dir):
    graph = trade_graph(spark, sf_dir)
    return mixing.edge_attr_join(graph.edges, graph.vertices, "attr")


def mixing_matrix(spark, sf_dir):
    graph = trade_graph(spark, sf_dir)
    return mixing.mixing_matrix(graph.edges, graph.vertices, "attr")


def assortativity(spark, sf_dir):
    graph = trade_graph(spark, sf_dir)
    return _rounded(mixing.assortativity(graph.edges, graph.vertices, "attr"), "assortativity")


def assortativity_geo(spark, sf_dir):
    graph = geo_graph(spark, sf_dir)
    return _rounded(mixing.assortativity(graph.edges, graph.vertices, "attr"), "assortativity")


# --- PageRank


def pagerank_step(spark, sf_dir):
    graph = _cut(trade_graph(spark, sf_dir))
    ranks = pagerank.uniform_ranks(graph.vertices)
    step = pagerank.pagerank_step(graph.vertices, graph.edges, ranks)
    return step.withColumn("rank", rounded("rank", 10))


def _ranks(graph: Graph) -> DataFrame:
    ranks = pagerank.pagerank(graph.vertices, graph.edges)
    return ranks.withColumn("rank", rounded("rank", 10))


def pagerank_all(spark, sf_dir):
    return _ranks(_cut(trade_graph(spark, sf_dir)))


def pagerank_isolated(spark, sf_dir):
    return _ranks(_cut(order_graph(spark, sf_dir)))


def pagerank_top10(spark, sf_dir):
    graph = _cut(trade_graph(spark, sf_dir))
    return _rounded(pagerank.pagerank_top(graph.vertices, graph.edges, 10), "rank", digits=10)


# --- paths


def _walks(graph: Graph, max_depth: int | None) -> DataFrame:
    sources = sample.sample_sources(graph.vertices, SOURCES)
    return paths.bfs_distances(graph.edges, sources, max_depth)


def bfs_distances(spark, sf_dir):
    return _walks(_cut(trade_graph(spark, sf_dir)), MAX_DEPTH)


def bfs_summary(spark, sf_dir):
    found = paths.bfs_summary(_walks(_cut(order_graph(spark, sf_dir)), MAX_DEPTH))
    return _rounded(found, "avg_dist")


def bfs_summary_unbounded(spark, sf_dir):
    found = paths.bfs_summary(_walks(_cut(order_graph(spark, sf_dir)), None))
    return _rounded(found, "avg_dist")


def sample_sources(spark, sf_dir):
    return sample.sample_sources(trade_vertices(spark, sf_dir), SOURCES)


def _scores(graph: Graph) -> DataFrame:
    sources = sample.sample_sources(graph.vertices, SOURCES)
    return paths.betweenness(graph.vertices, graph.edges, sources)


def betweenness(spark, sf_dir):
    graph = _cut(trade_graph(spark, sf_dir))
    return _scores(graph).withColumn("score", rounded("score"))


def betweenness_top10(spark, sf_dir):
    graph = _cut(trade_graph(spark, sf_dir))
    return _rounded(top_k(_scores(graph), "score", 10), "score")


# --- result tables


def grouped_median(spark, sf_dir):
    medians = results.grouped_median(table(spark, sf_dir, "events"), ["event_type"], "value")
    return _rounded(medians, "median")


def timing_pivot(spark, sf_dir):
    log = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("metric"), (F.col("user_id") % 2).alias("system"), F.col("value").alias("sec")
    )
    pivoted = results.timing_pivot(log, [0, 1])
    named = pivoted.withColumnsRenamed({"0": "system_0", "1": "system_1"})
    return _rounded(named, "system_0", "system_1")


def _event_totals(spark, sf_dir):
    cents = F.sum(F.round(F.col("value") * 100).cast("bigint"))
    return table(spark, sf_dir, "events").groupBy("event_type").agg(cents.alias("total"))


def merge_results(spark, sf_dir):
    old = _event_totals(spark, sf_dir)
    rerun = old.where(F.col("event_type").isin("click", "view"))
    return results.merge_results(
        old, rerun.select("event_type", (F.col("total") * 2).alias("total")), ["event_type"]
    )


def ledger_reconcile(spark, sf_dir):
    deltas = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("id"), F.round(F.col("value") * 100).cast("bigint").alias("delta")
    )
    wrong = F.when(F.col("id") % 10 == 0, 1).otherwise(0)
    balances = deltas.groupBy("id").agg(F.sum("delta").alias("moved")).select(
        "id", (1000 + F.col("moved") + wrong).alias("balance")
    )
    return results.ledger_reconcile(balances, deltas)


def metric_diff(spark, sf_dir):
    def degrees(graph: Graph) -> DataFrame:
        return degree.out_degree(graph.edges).select(
            F.col("src").alias("metric"), F.col("degree").cast("double").alias("value")
        )

    return results.metric_diff(
        degrees(trade_graph(spark, sf_dir)), degrees(order_graph(spark, sf_dir)), 0.0
    )


def run_metrics(spark, sf_dir):
    """All six metrics of the trade graph from one projection, as reported."""
    graph = _cut(trade_graph(spark, sf_dir))
    found = metrics.run_metrics(graph, "attr", sources=SOURCES)
    return found.select("metric", "field", rounded(F.col("value"), 6).alias("value"))


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        read_vertices, read_edges, normalize_flags, normalize_ints, normalize_attr,
        symmetrize_edges, load_counts, edges_per_bucket, insert_if_absent, upsert_latest,
        duplicate_keys, edges_valid, edges_orphan, graph_counts, induced_subgraph, neighbors,
        edge_exists, vertices_with_attr, vertices_by_attr, attr_counts, out_degree, degree_stats,
        degree_stats_all, degree_local, degree_histogram, adjacency_list, wedge_count,
        triangle_list, triangle_count, transitivity, local_cc, avg_local_cc, edge_attr_join,
        mixing_matrix, assortativity, assortativity_geo, pagerank_step, pagerank_isolated,
        pagerank_top10, bfs_distances, bfs_summary, sample_sources, betweenness,
        betweenness_top10, grouped_median, timing_pivot, merge_results, ledger_reconcile,
        metric_diff, neighbors_stored, degree_local_stored, vertices_with_attr_stored,
        stored_edge_order, append_absent_edges, append_filtered_edges, upsert_stored,
        edges_per_bucket_hash, results_json,
        bfs_summary_unbounded, triangles_of_a_hub, pagerank_of_a_hub, run_metrics,
    )
} | {"pagerank": pagerank_all}
