"""What is kept on disk and in memory on the way: packed blocks, strips, dropped shuffles and discarded cuts."""

from __future__ import annotations

import os
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from weftgraph.operators import blocks, clustering, pagerank, paths
from weftgraph.operators.blocks import BlockLayout
from weftgraph.operators.edges import symmetrize
from weftgraph.operators.layout import EdgeLayout
from weftgraph.plans import metrics
from weftgraph.session import cut, discard, materialize
from weftgraph.sources import keyed, tables
from weftgraph.sources.keyed import KeyedTable


def shuffle_files(spark) -> set[str]:
    held = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {f.getName() for f in (held.apply(i) for i in range(held.size())) if f.getName().endswith(".data")}


def test_shuffles_go_once_their_result_is_stored(spark):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, set_before = shuffle_files(spark), spark.conf.get(key, None)
    counts = spark.range(5_000).groupBy((F.col("id") % 97).alias("k")).count()
    kept, seen = materialize(counts)
    assert not shuffle_files(spark) - before and seen["rows"] == 97
    # A plan that was stored can be run once more, and the session is as it was.
    assert counts.agg(F.sum("count")).first()[0] == kept.agg(F.sum("count")).first()[0] == 5_000
    assert spark.conf.get(key, None) == set_before


def test_discarded_cuts_are_deleted(spark):
    kept, seen, path = cut(spark.range(9))
    assert kept.count() == seen["rows"] == 9 and os.path.isdir(path.removeprefix("file:"))
    discard(spark, path)
    assert not os.path.exists(path.removeprefix("file:"))


def test_packed_edges_come_back_in_few_bytes():
    draw = np.random.default_rng(7)
    src = np.append(draw.integers(0, 200_000, 60_000), [-(2**63), 2**63 - 1, 5, 5])
    dst = np.append(draw.integers(0, 200_000, 60_000), [2**63 - 1, -(2**63), -5, -5])
    block = np.arange(len(src)) % 3
    batch = pa.RecordBatch.from_arrays([pa.array(x) for x in (block, src, dst)], ["block", "src", "dst"])
    rows = pa.Table.from_batches(list(blocks._packed(iter([batch.slice(0, 0), batch.slice(0, 10), batch.slice(10)]))))
    assert rows["block"].to_pylist() == [0, 1, 2]
    found = [(p.srcs[p.source], np.repeat(p.dsts, np.diff(p.starts, append=len(p.source)))) for p in blocks._pieces_of(rows)]
    for key, (s, d) in enumerate(found):
        assert sorted(zip(s.tolist(), d.tolist())) == sorted(zip(src[block == key].tolist(), dst[block == key].tolist()))
    assert rows["edges"].nbytes < 7 * len(src)
    assert list(blocks._packed(iter([]))) == []


def test_a_block_holds_one_row_of_sums_per_target():
    """Eight slices of rows of sums, once more when they were joined, took an executor's memory."""
    draw = np.random.default_rng(8)
    edges = pa.table({"block": np.zeros(3_000_000, np.int64), "src": draw.integers(0, 150_000, 3_000_000), "dst": draw.integers(0, 150_000, 3_000_000)})
    names = [f"s{i}" for i in range(16)]
    rows = pa.table({"node": np.arange(150_000), "batch": np.zeros(150_000, np.int32), **{n: np.ones(150_000) for n in names}})
    packed = pa.Table.from_batches(list(blocks._packed(iter(edges.to_batches()))))
    sums = []
    for table in (edges, packed):
        tracemalloc.start()
        out = blocks._gathered_in_block(table, rows, names, np.add)
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        sums.append(out.sort_by("node"))
        assert peak < 260_000_000
    assert sums[0].equals(sums[1]) and sum(sums[0]["s7"].to_pylist()) == 3_000_000


def test_strips_and_shares_give_the_same(spark, monkeypatch):
    """What ships much is done part by part, whose files go; nothing is left out."""
    ids = spark.range(40)
    links = ids.selectExpr("id as a", "id * 7 % 40 as b").unionAll(ids.selectExpr("id", "(id + 1) % 40"))
    edges = symmetrize(links.unionAll(ids.where("id < 30").selectExpr("0L", "id"))).checkpoint()
    chosen, build, cuts = ids.where("id in (0, 9, 33)"), BlockLayout.build, []
    monkeypatch.setattr(BlockLayout, "build", staticmethod(lambda e: build(e, 4)))

    def run() -> list:
        scores = paths.betweenness(ids, edges, chosen, 2, 2)
        ranks = pagerank.pagerank(ids, edges, 2, checkpoint_every=3)
        return [{r[0]: r[1] for r in frame.collect()} for frame in (scores, ranks)] + [
            sorted(map(tuple, paths.bfs_distances(edges, chosen, lanes=2, together=2).collect()))
        ]

    want = run()
    for name, value in {"GATHERED_BYTES": 500, "SHIPPED_LEAST": 200, "SHIPPED_PER_EDGE": 0}.items():
        monkeypatch.setattr(blocks, name, value)
    kept = blocks.cut
    monkeypatch.setattr(blocks, "cut", lambda df: cuts.append(kept(df)) or cuts[-1])
    got = run()
    assert got == [pytest.approx(want[0]), pytest.approx(want[1]), want[2]]
    assert len(cuts) > 8 and not any(os.path.exists(path.removeprefix("file:")) for _, _, path in cuts)


def test_metrics_walk_over_blocks(micro, monkeypatch):
    """Target arrays send a row per edge and batch of sources, and a second copy of the edges is stored for them."""
    layouts, walked = [], metrics.betweenness
    monkeypatch.setattr(metrics, "betweenness", lambda *a, layout, **k: layouts.append(layout) or walked(*a, layout=layout, **k))
    monkeypatch.setattr(EdgeLayout, "step", None)
    found = {(r.metric, r.field): r.value for r in metrics.run_metrics(micro, sources=5, iterations=2).collect()}
    assert [type(x) for x in layouts] == [BlockLayout] and not layouts[0].edges.is_cached
    assert found["betweenness", "3"] == 4.0


def test_keyed_writes_go_some_buckets_at_a_time(spark, tmp_path, monkeypatch):
    writes, write = [], KeyedTable._write
    monkeypatch.setattr(KeyedTable, "_write", lambda self, *a: writes.append(write(self, *a)) or writes[-1])
    monkeypatch.setattr(keyed, "BUCKETS_AT_ONCE", 3)
    before = shuffle_files(spark)
    stored = KeyedTable.create(spark.range(50).selectExpr("id as k", "'old' as v"), str(tmp_path / "t"), ["k"], 8)
    assert [len(touched) for *_, touched in writes] == [3, 3, 2] and stored.version().number == 1
    batch = spark.range(40, 90).selectExpr("if(id = 89, null, id) as k", "'new' as v")
    told = stored.append_absent(batch.unionAll(batch))
    assert told["rows"] == 40 and told["buckets"] == 8 and len(writes) == 6
    # Once more adds nothing, and no version.
    assert stored.append_absent(batch)["rows"] == 0 and len(writes) == 6 and stored.version().number == 2
    want = {(i, "old") for i in range(50)} | {(i, "new") for i in range(50, 89)} | {(None, "new")}
    assert stored.read().count() == 90 and {tuple(r) for r in stored.read().collect()} == want
    assert stored.lookup(88).first().v == "new" and len(shuffle_files(spark) - before) < 60


def test_appended_edges_are_grouped_part_by_part(spark, tmp_path, monkeypatch):
    cuts, kept, path = [], tables.cut, str(tmp_path / "g")
    vertices = spark.range(30).withColumn("attr", F.lit("x"))
    old = symmetrize(spark.range(29).selectExpr("id as a", "id + 1 as b"))
    new = symmetrize(spark.range(28).selectExpr("id as a", "id + 2 as b").unionAll(spark.range(9).selectExpr("id", "id + 1")))
    tables.write_graph(vertices, old, path, 4, "attr")
    monkeypatch.setattr(tables, "EDGES_AT_ONCE", 30)
    monkeypatch.setattr(tables, "cut", lambda df, *m: cuts.append(kept(df, *m)) or cuts[-1])
    assert tables.append_to_graph(spark, path, edges=new)["edges"] == 56 and len(cuts) == 1 + 3
    assert tables.append_to_graph(spark, path, edges=new, from_files=True)["edges"] == 0 and len(cuts) == 4 + 3
    assert not any(os.path.exists(p.removeprefix("file:")) for *_, p in cuts)
    edges = tables.open_graph(spark, path).graph.edges.select("src", "dst")
    assert sorted(map(tuple, edges.collect())) == sorted(map(tuple, old.unionAll(new).distinct().collect()))


def test_lists_are_sent_to_some_shards_at_a_time(spark, monkeypatch):
    ids = spark.range(24)
    edges = symmetrize(ids.selectExpr("id as a").crossJoin(ids.selectExpr("id as b")).where("a < b")).checkpoint()
    for name, value in {"MOST_COLOURS": 0, "CLOSERS_PER_TASK": 60, "SENT_LEAST": 1, "SENT_PER_EDGE": 1}.items():
        monkeypatch.setattr(clustering, name, value)
    parts = clustering.closed_parts(edges)
    assert len(parts) > 2 and all(part.count() for part in parts)
    stored, kept = [], clustering.materialize
    monkeypatch.setattr(clustering, "materialize", lambda df, *m: stored.append(df.columns) or kept(df, *m))
    assert clustering.triangle_count(edges).first().triangles == 24 * 23 * 22 // 6
    assert stored.count(["triangles"]) == len(parts)
    assert {tuple(r) for r in clustering.vertex_triangles(edges).collect()} == {(i, 23 * 22 // 2) for i in range(24)}
    assert clustering.triangle_list(edges).distinct().count() == 24 * 23 * 22 // 6
