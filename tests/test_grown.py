"""What grows with the graph: rows sent, groups held, and results of the paths for large graphs."""

from __future__ import annotations

import os
import random

import numpy as np
import pyarrow as pa
import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from weftgraph.operators import blocks, clustering
from weftgraph.operators.edges import both_ways, symmetrize, undirected
from weftgraph.plans import metrics, queries
from weftgraph.session import materialize
from weftgraph.sources import tables
from weftgraph.sources.keyed import filter_cells, possible_keys


def random_graph(spark, n: int, m: int, seed: int = 5):
    """Random links, a hub, negative ids and ids beyond 32 bits."""
    draw = random.Random(seed)
    links = [(draw.randrange(n) - n // 2, draw.randrange(n) * draw.choice([1, 1 << 33])) for _ in range(m)]
    links += [(0, i) for i in range(1, n)]
    neighbours: dict[int, set[int]] = {}
    for a, b in links:
        if a != b:
            neighbours.setdefault(a, set()).add(b)
            neighbours.setdefault(b, set()).add(a)
    return symmetrize(spark.createDataFrame(links, "a bigint, b bigint")).checkpoint(), neighbours


def test_triangles_in_a_grid_of_lists(spark, monkeypatch):
    edges, near = random_graph(spark, 80, 900)
    want = {tuple(sorted((a, b, c))) for a in near for b in near[a] for c in near[a] & near[b]}
    monkeypatch.setattr(clustering, "MOST_COLOURS", 0)
    monkeypatch.setattr(clustering, "PAIRS_AT_ONCE", 50)
    for grid in ((1, 1), (3, 4)):
        monkeypatch.setattr(clustering, "list_grid", lambda *sizes, grid=grid: grid)
        found = [tuple(r) for r in clustering.triangle_list(edges).collect()]
        assert len(found) == len(set(found)) and set(found) == want
    assert clustering.triangle_list(edges.where("false")).count() == 0


@pytest.mark.parametrize("edges", [10**7, 10**8, 6 * 10**8])
def test_lists_are_sent_a_few_times(edges):
    closers = edges // 3
    slices, shards = clustering.list_grid(edges, closers, 12)
    assert slices * shards >= max(12, edges // clustering.LISTED_PER_TASK)
    assert closers <= shards * clustering.CLOSERS_PER_TASK
    ids = slices * closers + shards * edges
    assert ids < edges * clustering.colours_for(edges, 12) / 4 or ids <= 5 * edges


def test_a_key_is_one_row_of_the_filter(spark):
    """Neither building nor asking makes several rows of a key, which is all that is shuffled."""
    stored = spark.range(8_000).select(F.when(F.col("id") > 0, F.col("id") * 2).alias("k"), F.lit(0).alias("in_bucket"))
    cells = filter_cells(stored, ["k"], 12 * 8_000)
    asked = spark.range(8_000).select((F.col("id") * 2 + 1).alias("k"), F.lit(0).alias("in_bucket"))
    for keyed, least, most in ((stored, 8_000, 8_000), (asked, 0, 240)):
        told = possible_keys(keyed, ["k"], 12 * 8_000, cells)
        assert told.count() == 8_000 and least <= told.where("`filter maybe`").count() <= most
        assert "Generate" not in told._jdf.queryExecution().executedPlan().toString()
    assert possible_keys(asked, ["k"], 12 * 8_000, cells.where("false")).where("`filter maybe`").isEmpty()


def test_a_block_is_summed_in_slices(monkeypatch):
    draw = np.random.default_rng(3)
    src, dst = draw.integers(-50, 50, 5_000), draw.integers(-40, 40, 5_000)
    node = np.arange(-50, 30)
    values = pa.table({"node": node, "value": node * 0.5})
    want = {t: src[(dst == t) & (src < 30)].sum() * 0.5 for t in set(dst[src < 30].tolist())}
    sizes = []
    summed = blocks._summed
    monkeypatch.setattr(blocks, "EDGES_AT_ONCE", 100)
    monkeypatch.setattr(blocks, "_summed", lambda t, v: sizes.append(len(t)) or summed(t, v))
    out = blocks._sums_of_block(pa.table({"block": src * 0, "src": src, "dst": dst}), values)
    assert dict(zip(out["node"].to_pylist(), out["value"].to_pylist())) == pytest.approx(want)
    assert max(sizes) <= 100 + 9 * 80


def test_stored_order_shuffles_runs_only(spark, tmp_path):
    """Rows in disorder inside a file, at its nulls and at seams of batches and splits."""
    draw = random.Random(8)
    rows = [(draw.choice([None, 1, 2, 3]), draw.choice([None, 5, 6])) for _ in range(400)]
    edges = spark.createDataFrame(rows, "src bigint, dst bigint").repartition(3)
    edges.withColumn("src_bucket", F.spark_partition_id()).write.partitionBy("src_bucket").parquet(f"{tmp_path}/e")
    stored = spark.read.parquet(f"{tmp_path}/e")
    kept = stored.select("src_bucket", "src", "dst", F.col("_metadata.row_index").alias("i")).orderBy("src_bucket", "i").collect()
    rank = lambda r: tuple((v is not None, v or 0) for v in (r.src, r.dst))
    want = {b: [0, 0] for b in range(3)}
    for i, row in enumerate(kept):
        want[row.src_bucket][0] += 1
        if i and kept[i - 1].src_bucket == row.src_bucket:
            want[row.src_bucket][1] += rank(kept[i - 1]) > rank(row)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        found = tables.stored_order(stored)
        assert {r.src_bucket: [r.n_edges, r.out_of_order] for r in found.collect()} == want
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.index("MapInArrow") > plan.index("Exchange hashpartitioning(file")


def test_cut_frames_are_compressed_columns(spark):
    """Checkpoints of rows took three times the disk of the same edges stored once each."""
    frame = spark.range(200_000).select((F.col("id") % 1_000).alias("src"), F.col("id").alias("dst"))
    cut, seen = materialize(frame, F.max("dst").alias("most"))
    assert (seen["rows"], seen["most"], cut.count()) == (200_000, 199_999, 200_000)
    files = [f.removeprefix("file:") for f in cut.inputFiles()]
    assert files and sum(os.path.getsize(f) for f in files) < 8 * 200_000
    nothing, seen = materialize(frame.where("false"))
    assert seen["rows"] == 0 and nothing.schema.names == ["src", "dst"] and nothing.isEmpty()


def test_stored_edges_come_back_in_both_directions(spark):
    edges, _ = random_graph(spark, 40, 200)
    back = both_ways(undirected(edges))
    assert back.dtypes == edges.dtypes and back.count() == edges.count()
    assert back.exceptAll(edges).isEmpty()


def test_metrics_keep_triangles_per_vertex_only(micro, monkeypatch):
    """Closed edges with their corners are many times larger than a count for each vertex."""
    widths = []
    kept = metrics.materialize
    monkeypatch.setattr(metrics, "materialize", lambda df, *m: widths.append(df.columns) or kept(df, *m))
    found = {(r.metric, r.field): r.value for r in metrics.run_metrics(micro, sources=5).collect()}
    assert widths[0] == ["id", "triangles"]
    assert found["clustering", "triangles"] == found["local_clustering", "triangles"] == 1
    assert found["clustering", "transitivity"] == 3 / found["clustering", "wedges"]


def test_an_append_groups_both_sides_in_one_shuffle(spark):
    stored = spark.createDataFrame([(1, 7), (None, 7)], "src bigint, dst bigint")
    batch = spark.createDataFrame([(1, 7), (1, 8), (1, 8), (None, 7), (None, 8), (None, None)], "src bigint, dst bigint")
    new = tables._absent_from_files(stored, batch, ["src", "dst"])
    assert new.dtypes == batch.dtypes
    assert sorted(map(tuple, new.collect()), key=str) == sorted([(1, 8), (None, 8), (None, None)], key=str)
    plan = new._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan
    rows = spark.createDataFrame([(2, "b", 1), (2, "a", 2), (1, "c", 3)], "dst bigint, v string, n int")
    (row,) = tables._absent_from_files(stored.where("src = 1").selectExpr("src as dst"), rows, ["dst"]).collect()
    assert row.dst == 2 and (row.v, row.n) in (("b", 1), ("a", 2))


def test_load_counts_derives_its_edges_once(spark, monkeypatch):
    """They are counted and then written, and were joined and de-duplicated for each."""
    given = []
    monkeypatch.setattr(tables, "write_graph", lambda vertices, edges, *path, **options: given.append(edges))
    queries.load_counts(spark, SMALL)
    assert "Join" not in given[0]._jdf.queryExecution().executedPlan().toString()
