"""Skew, plan shape and rules that keep jobs distributed."""

from __future__ import annotations

import pathlib

import pytest
from pyspark.sql import functions as F

from weftgraph.operators import clustering, mixing, pagerank, paths, results
from weftgraph.operators.edges import adjacency_list, edges_orphan, edges_valid, symmetrize
from weftgraph.operators.blocks import BlockLayout
from weftgraph.operators.layout import HOT_SHARE, EdgeLayout, walking
from weftgraph.session import checkpoint_dir

LEAVES = 10_000
# Makes Spark treat test-sized partitions as it treats large ones on a cluster.
SMALL_PARTS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def settings(spark):
    before = {}

    def change(**values):
        for key, value in values.items():
            before.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield change
    for key, value in before.items():
        if value is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, value)


@pytest.fixture(scope="module")
def star(spark):
    """A hub that is an end of every edge, and so holds half of all rows."""
    leaves = spark.range(1, LEAVES + 1)
    vertices = leaves.unionAll(spark.range(1)).withColumn("language", F.lit("x"))
    links = leaves.select(F.lit(0).cast("bigint").alias("a"), F.col("id").alias("b"))
    return vertices, symmetrize(links).repartition(16).checkpoint()


def test_hub_is_sliced_over_partitions(star, spark):
    layout = EdgeLayout.build(star[1])
    try:
        assert layout.hot.count() == 1
        assert layout.hot.count() <= HOT_SHARE * layout.partitions
        sizes = layout.edges.select("src", F.size("targets").alias("n"), F.spark_partition_id().alias("p"))
        hub = sizes.where("src = 0").agg(F.sum("n"), F.max("n"), F.countDistinct("p")).first()
        limit = 2 * LEAVES / (HOT_SHARE * layout.partitions)
        assert hub[0] == LEAVES
        assert hub[1] < 1.3 * limit
        assert hub[2] > 1
    finally:
        layout.release()


def test_loops_on_a_star(star, spark):
    vertices, edges = star
    ranks = {r.id: r.rank for r in pagerank.pagerank(vertices, edges, 2).where("id < 2").collect()}
    n = LEAVES + 1
    base = 0.15 / n
    leaf = base + 0.85 * (base + 0.85 * LEAVES / n) / LEAVES
    hub = base + 0.85 * LEAVES * (base + 0.85 / n / LEAVES)
    assert ranks == pytest.approx({0: hub, 1: leaf})
    sources = spark.createDataFrame([(1,), (2,)], "id bigint")
    summary = paths.bfs_summary(paths.bfs_distances(edges, sources)).collect()
    assert {(r.source, r.reached) for r in summary} == {(1, n), (2, n)}
    top = paths.betweenness_top(vertices, edges, sources, 2).collect()
    assert [(r.id, r.score) for r in top] == [(0, 2.0 * (LEAVES - 1)), (1, 0.0)]


def test_adjacency_of_a_hub_is_cut(star):
    blocks = adjacency_list(star[1], block=1000).where("src = 0")
    sizes = blocks.agg(F.max(F.size("neighbors")), F.sum(F.size("neighbors"))).first()
    assert tuple(sizes) == (1000, LEAVES)


def test_out_neighbours_of_a_hub_stay_few(star):
    largest = clustering.oriented(star[1]).groupBy("a").count().agg(F.max("count")).first()[0]
    assert largest == 1


SKEWED = {
    "mixing": lambda v, e: mixing.mixing_matrix(e, v, "language"),
    "orientation": lambda v, e: clustering.oriented(e),
    "orphans": lambda v, e: edges_orphan(e, v),
    "valid": lambda v, e: edges_valid(e, v),
    "pagerank_step": lambda v, e: pagerank.pagerank_step(v, e, pagerank.uniform_ranks(v)),
}


@pytest.mark.parametrize("operator", SKEWED)
def test_skewed_joins_are_split(star, settings, operator):
    settings(**SMALL_PARTS)
    vertices, edges = star
    df = SKEWED[operator](vertices, edges)
    df.collect()
    assert "SortMergeJoin(skew=true)" in plan_of(df)


def wheel(spark, n):
    """A ring around a hub: every edge of the ring is closed by the hub."""
    rim = spark.range(1, n + 1)
    after = (F.col("id") % n + 1).alias("b")
    links = rim.select(F.col("id").alias("a"), F.explode(F.array(F.lit(0).cast("bigint"), after)).alias("b"))
    return symmetrize(links).repartition(16).checkpoint()


def test_triangles_of_a_hub_are_split(spark, settings):
    n = 30_000
    settings(**SMALL_PARTS)
    edges = wheel(spark, n)
    colours = clustering.colours_for(2 * n, spark.sparkContext.defaultParallelism)
    assert colours > 2 and n > 2 * n // colours
    df = clustering.triangle_count(edges)
    assert df.collect()[0].triangles == n
    final = plan_of(df).split("Initial Plan")[0]
    assert "SortMergeJoin(skew=true)" in final and "Broadcast" not in final


def test_colour_triples_share_the_edges_evenly(spark):
    n, colours = 30_000, 6
    ring = clustering.oriented(wheel(spark, n)).where("a <> 0 and b <> 0")
    groups = clustering.colour_copies(ring, colours).groupBy("triple").count()
    rows = [r["count"] for r in groups.collect()]
    assert sum(rows) == colours * n and len(rows) == colours * (colours + 1) * (colours + 2) // 6
    assert max(rows) < 1.2 * 6 * n / colours**2


def test_colours_follow_the_edges():
    assert clustering.colours_for(1_000, 8) == 1
    assert clustering.colours_for(1_000_000, 8) == 4
    for edges in (10**9, 10**11):
        colours = clustering.colours_for(edges, 1_000)
        assert 6 * edges / colours**2 <= clustering.EDGES_PER_TASK < 6 * edges / (colours - 2) ** 2


def test_a_rank_step_ships_two_root_p_values_per_vertex(spark):
    n, partitions = 400, 16
    ids = spark.range(n).select(F.col("id").alias("a"))
    pairs = ids.join(spark.range(n).select(F.col("id").alias("b")), F.col("a") < F.col("b"))
    laid = BlockLayout.build(symmetrize(pairs).checkpoint(), partitions)
    try:
        assert (laid.rows, laid.columns) == (4, 4)
        ones = spark.range(n).select(F.col("id").alias("node"), F.lit(1.0).alias("value"))
        assert laid.shipped(ones).count() == n * laid.columns
        assert laid.partial_sums(ones).count() <= n * laid.rows
        assert {r.value for r in laid.incoming(ones).collect()} == {n - 1.0}
        spread = laid.edges.groupBy(F.spark_partition_id()).count().agg(F.count("*"), F.max("count")).first()
        assert spread[0] == partitions and spread[1] < 1.5 * n * (n - 1) / partitions
        plan = plan_of(laid.incoming(ones))
        # Values to blocks and sums to vertices; the edges stay where they are.
        assert plan[: plan.index("InMemoryRelation")].count("Exchange hashpartitioning") <= 2
    finally:
        laid.release()


def test_blocks_split_the_edges_of_a_hub(star):
    laid = BlockLayout.build(star[1], 16)
    try:
        assert laid.hot.count() == 1
        sizes = laid.edges.groupBy("block").count().agg(F.count("*"), F.max("count")).first()
        assert sizes[0] == 16 and sizes[1] < 1.5 * 2 * LEAVES / 16
        ones = star[0].select(F.col("id").alias("node"), F.lit(1.0).alias("value"))
        sums = {r.node: r.value for r in laid.incoming(ones).where("node < 2").collect()}
        assert sums == {0: float(LEAVES), 1: 1.0}
    finally:
        laid.release()


def test_walks_neither_shuffle_edges_nor_broadcast_rows(spark):
    n = 10_000
    ids = spark.range(n)
    ring = ids.select(F.col("id").alias("a"), ((F.col("id") + 1) % n).alias("b"))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with walking(symmetrize(ring)) as layout:
        assert layout.hot.isEmpty() and layout.partitions == spark.sparkContext.defaultParallelism
        rows = ids.select(F.col("id").alias("node"), F.lit(1.0).alias("share"))
        plan = plan_of(layout.step(rows, "node"))
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    own = plan[: plan.index("InMemoryRelation")]
    # The only thing broadcast is the list of hot vertices, which is checked to be short.
    assert own.count("BroadcastExchange") == 1 and own.count("SortMergeJoin") == 1
    assert own.count("Exchange hashpartitioning") == 1 and own.count("Sort [") == 1


def test_sources_keep_to_distributed_calls():
    package = pathlib.Path(__file__).parent.parent / "weftgraph"
    for path in package.rglob("*.py"):
        if path.parent.name == "llm":
            continue  # has its own rules for what may reach the driver
        text = path.read_text()
        for banned in ("localCheckpoint", ".collect()", ".toPandas(", "crossJoin", ".rdd", "toLocalIterator"):
            assert banned not in text, (path, banned)


def test_checkpoints_go_to_the_configured_folder(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    used = checkpoint_dir(spark)
    assert used == spark.sparkContext.getCheckpointDir()
    if named is not None:
        assert named.rstrip("/") in used


def test_sorted_median_splits_a_hot_group(spark):
    frame = spark.range(20_001).select(F.lit("k").alias("k"), F.col("id").cast("double").alias("v"))
    assert results.grouped_median(frame, ["k"], "v").first().median == 10_000.0
