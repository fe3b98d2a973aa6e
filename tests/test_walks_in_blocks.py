"""Walks over the block grid: what a step sends, nulls, other kinds of ids, adjacency lists."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from weftgraph.operators import blocks, clustering, paths
from weftgraph.operators.blocks import BlockLayout
from weftgraph.operators.edges import _blocks, adjacency_list, symmetrize
from weftgraph.operators.layout import EdgeLayout


def dense(spark, n: int):
    ids = spark.range(n).select(F.col("id").alias("a"))
    pairs = ids.join(spark.range(n).select(F.col("id").alias("b")), F.col("a") < F.col("b"))
    return symmetrize(pairs).checkpoint()


def test_a_level_sends_two_root_p_rows_per_vertex_for_all_batches(spark, monkeypatch):
    """A row per vertex, batch and block, where there was one for nearly every edge and batch."""
    n, partitions = 300, 16
    build, sent = BlockLayout.build, []
    gathered = BlockLayout.gathered
    monkeypatch.setattr(BlockLayout, "build", staticmethod(lambda e: build(e, partitions)))

    def counted(self, rows, columns, combine):
        out = gathered(self, rows, columns, combine)
        sent.append((rows.count(), out.count()))
        return out

    monkeypatch.setattr(BlockLayout, "gathered", counted)
    sources = spark.range(100)
    found = paths.bfs_distances(dense(spark, n), sources)
    assert found.groupBy("dist").count().orderBy("dist").collect() == [(0, 100), (1, 100 * (n - 1))]
    # Two batches of lanes in two levels, after which nothing is fresh.
    assert len(sent) == 2 and all(out <= 2 * n * 4 for _, out in sent)


def test_combined_in_a_block(monkeypatch):
    draw = np.random.default_rng(4)
    src, dst = draw.integers(0, 30, 900), draw.integers(0, 20, 900)
    node, batch = np.repeat(np.arange(5, 30), 2), np.tile([0, 3], 25)
    bits = draw.integers(0, 1 << 40, 50)
    monkeypatch.setattr(blocks, "EDGES_AT_ONCE", 40)
    rows = pa.table({"node": node, "batch": pa.array(batch, pa.int32()), "x": pa.array(bits, mask=bits % 5 == 0)})
    out = blocks._gathered_in_block(
        pa.table({"block": src * 0, "src": src, "dst": dst}), rows, ["x"], np.bitwise_or
    ).to_pylist()
    want: dict = {}
    for s, d in zip(src, dst):
        for i in np.flatnonzero(node == s):
            key = (int(d), int(batch[i]))
            want[key] = want.get(key, 0) | (int(bits[i]) if bits[i] % 5 else 0)
    assert len(out) == len(want) and {(r["node"], r["batch"]): r["x"] for r in out} == want


@pytest.mark.parametrize("kind", ["bigint", "int", "string"])
def test_ids_of_any_kind_and_null_ends(spark, kind):
    links = [(1, 2), (2, 1), (2, 3), (3, 2), (2, None), (None, 3)]
    edges = spark.createDataFrame(links, "src int, dst int").selectExpr(*[f"cast({c} as {kind}) as {c}" for c in ("src", "dst")])
    sources = spark.createDataFrame([(1,)], "id int").selectExpr(f"cast(id as {kind}) as id")
    found = paths.bfs_distances(edges, sources)
    assert dict(found.dtypes)["node"] == kind
    cast = {"string": str}.get(kind, int)
    assert {(r.node, r.dist) for r in found.collect()} == {(cast(1), 0), (cast(2), 1), (cast(3), 2)}


def test_betweenness_is_that_of_the_edge_layout(spark):
    edges = symmetrize(spark.range(60).selectExpr("id as a", "id * 7 % 60 as b").unionAll(spark.range(60).selectExpr("id", "(id + 1) % 60")))
    ids = spark.range(60)
    laid = EdgeLayout.build(edges)
    try:
        want = {r.id: r.score for r in paths.betweenness(ids, edges, ids.where("id < 20"), 4, 3, laid).collect()}
    finally:
        laid.release()
    got = {r.id: r.score for r in paths.betweenness(ids, edges, ids.where("id < 20"), 4, 3).collect()}
    assert got == pytest.approx(want) and any(want.values())


def test_adjacency_shuffles_rows_and_collects_sorted_runs(spark):
    rows = [(s, d) for s in (1, 2, None) for d in (5, 5, 9, 14, -3, None)] + [(4, None)]
    edges = spark.createDataFrame(rows, "src bigint, dst bigint")
    got = sorted(tuple(r) for r in adjacency_list(edges, 10).where("src = 1 or src = 4").collect() if r[1] is not None)
    assert got == [(1, 0, [-3, 5, 9]), (1, 1, [14])]
    empty = adjacency_list(edges, 10).where("block is null").collect()
    assert len(empty) == 4 and all(r.neighbors == [] for r in empty)
    assert adjacency_list(edges, 10).where("src is null").count() == 3
    assert adjacency_list(edges.where("false"), 10).count() == 0
    plan = adjacency_list(edges, 10)._jdf.queryExecution().executedPlan().toString()
    assert "ObjectHashAggregate" not in plan and plan.count("Exchange") == 1


@pytest.mark.parametrize("size", [1, 2, 3, 7])
def test_runs_cut_by_batches(size):
    rows = [(1, 0, 1), (1, 0, 1), (1, 0, 2), (1, 0, 3), (1, 1, 12), (2, 0, 3), (2, 0, 3), (2, 0, 4), (3, None, None)]
    table = pa.table(dict(zip(("src", "block", "dst"), map(list, zip(*rows)))))
    out = [tuple(r.values()) for b in _blocks(iter(table.to_batches(max_chunksize=size))) for r in b.to_pylist()]
    assert out == [(1, 0, [1, 2, 3]), (1, 1, [12]), (2, 0, [3, 4]), (3, None, [])]


def test_transitivity_counts_degrees_once(spark, monkeypatch):
    counted, degree = [], clustering.out_degree
    monkeypatch.setattr(clustering, "out_degree", lambda e: counted.append(1) or degree(e))
    found = clustering.transitivity(dense(spark, 20)).first()
    assert (found.triangles, found.wedges, found.transitivity) == (1140, 3420, 1.0)
    assert counted == [1]


def test_lists_are_sent_as_gaps():
    """Ids of any size come back, and near ones take far less than the eight bytes they were sent in."""
    draw = np.random.default_rng(6)
    lists = [sorted(set(draw.integers(0, 300 * n, n).tolist())) for n in range(1, 400)]
    lists += [[-(2**63), 2**63 - 1], [-5, -5, 0, 1 << 40], [7]]
    batch = pa.RecordBatch.from_pydict(
        {"a": list(range(len(lists))), "degree": [1] * len(lists), "heads": pa.array(lists, pa.list_(pa.int64()))}
    )
    parts = [batch.slice(0, 11), batch.slice(11), batch.slice(0, 0)]
    packed = list(clustering._packed(iter(parts)))
    for part, made in zip(parts, packed):
        assert clustering._unpacked(made).column("heads").to_pylist() == part.column("heads").to_pylist()
    tail = clustering._unpacked(packed[1].slice(5, 300))
    assert tail.column("heads").to_pylist() == lists[16:316]
    assert packed[1].column("gaps").nbytes < 2.2 * sum(map(len, lists))
