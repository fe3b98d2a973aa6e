"""Values of a five-vertex graph worked out by hand."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from weftgraph.functions import top_k
from weftgraph.graph import Graph
from weftgraph.operators import clustering, degree, edges, mixing, pagerank, paths, sample


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0].asDict()


def test_symmetrize_collapses_repeats_and_loops(spark):
    raw = spark.createDataFrame([(1, 2), (1, 2), (2, 1), (3, 3), (2, 3)], "a bigint, b bigint")
    got = sorted(tuple(r) for r in edges.symmetrize(raw).collect())
    assert got == [(1, 2), (2, 1), (2, 3), (3, 2)]
    kept = sorted(tuple(r) for r in edges.symmetrize(raw, keep_self_loops=True).collect())
    assert kept == [(1, 2), (2, 1), (2, 3), (3, 2), (3, 3)]


def test_degrees(micro, as_dict):
    assert as_dict(degree.out_degree(micro.edges), "src", "degree") == {1: 2, 2: 2, 3: 3, 4: 1}
    full = as_dict(degree.vertex_degree(micro.vertices, micro.edges), "id", "degree")
    assert full == {1: 2, 2: 2, 3: 3, 4: 1, 5: 0}
    assert one(degree.degree_stats(micro.edges)) == {
        "n_vertices": 4, "avg_degree": 2.0, "std_degree": pytest.approx(0.5**0.5), "max_degree": 3,
    }
    both = one(degree.degree_stats(micro.edges, micro.vertices, include_isolated=True))
    assert (both["n_vertices"], both["avg_degree"]) == (5, 1.6)
    assert both["std_degree"] == pytest.approx(1.04**0.5)
    with pytest.raises(ValueError):
        degree.degree_stats(micro.edges, include_isolated=True)


def test_degree_local_and_neighbors(micro):
    assert one(degree.degree_local(micro.edges, 3)) == {"node_id": 3, "degree": 3}
    assert one(degree.degree_local(micro.edges)) == {"node_id": 1, "degree": 2}
    assert one(degree.degree_local(micro.edges, 5)) == {"node_id": 5, "degree": 0}
    assert [r.dst for r in edges.neighbors(micro.edges, 3).collect()] == [1, 2, 4]


def test_histogram_and_counts(micro):
    rows = sorted(tuple(r) for r in degree.degree_histogram(micro.edges).collect())
    assert rows == [(0, 1, 1, 1), (1, 2, 3, 3)]
    assert one(degree.graph_counts(micro.vertices, micro.edges)) == {
        "n_vertices": 5, "n_edges": 4, "mean_degree": 1.6,
    }


def test_adjacency_blocks_hold_bounded_ranges(micro):
    rows = edges.adjacency_list(micro.edges, block=2).collect()
    got = {(r.src, r.block): r.neighbors for r in rows}
    assert got[(3, 0)] == [1] and got[(3, 1)] == [2] and got[(3, 2)] == [4]
    assert got[(4, 1)] == [3]


def test_endpoint_checks(spark, micro):
    links = spark.createDataFrame([(1, 2), (1, 9), (8, 2), (8, 9)], "src bigint, dst bigint")
    assert [tuple(r) for r in edges.edges_valid(links, micro.vertices).collect()] == [(1, 2)]
    bad = {tuple(r) for r in edges.edges_orphan(links, micro.vertices).collect()}
    assert bad == {(1, 9, False, True), (8, 2, True, False), (8, 9, True, True)}
    pairs = spark.createDataFrame([(1, 2), (1, 4)], "src bigint, dst bigint")
    assert [tuple(r) for r in edges.edge_exists(pairs, micro.edges).collect()] == [(1, 2)]


def test_clustering(micro, as_dict):
    assert [tuple(r) for r in clustering.triangle_list(micro.edges).collect()] == [(1, 2, 3)]
    assert one(clustering.transitivity(micro.edges)) == {
        "triangles": 1, "wedges": 5, "transitivity": pytest.approx(0.6),
    }
    local = as_dict(clustering.local_cc(micro.vertices, micro.edges), "id", "coefficient")
    assert local == pytest.approx({1: 1.0, 2: 1.0, 3: 1 / 3, 4: 0.0, 5: 0.0})
    assert one(clustering.avg_local_cc(micro.vertices, micro.edges)) == {
        "avg_local_cc": pytest.approx(7 / 15), "triangles": 1,
    }


def test_clustering_without_wedges(spark, micro):
    none = micro.edges.where("false")
    assert one(clustering.transitivity(none))["transitivity"] is None
    pair = micro.edges.where("src + dst = 3")
    assert one(clustering.transitivity(pair)) == {
        "triangles": 0, "wedges": 0, "transitivity": None,
    }


def test_mixing(micro, make_graph):
    matrix = mixing.mixing_matrix(micro.edges, micro.vertices, "language")
    assert {tuple(r) for r in matrix.collect()} == {
        ("EN", "EN", 2), ("EN", "DE", 2), ("DE", "EN", 2), ("DE", "DE", 2),
    }
    assert one(mixing.assortativity(micro.edges, micro.vertices, "language")) == {
        "edges": 8, "on_diagonal": 4, "assortativity": 0.0,
    }
    single = make_graph({1: "EN", 2: "EN"}, [(1, 2)])
    assert math.isnan(one(mixing.assortativity(single.edges, single.vertices, "language"))["assortativity"])
    empty = micro.edges.where("false")
    assert math.isnan(one(mixing.assortativity(empty, micro.vertices, "language"))["assortativity"])


def test_mixing_counts_a_self_loop_once(spark):
    loops = edges.symmetrize(
        spark.createDataFrame([(1, 1), (1, 2)], "a bigint, b bigint"), keep_self_loops=True
    )
    labels = spark.createDataFrame([(1, "x"), (2, "y")], "id bigint, language string")
    matrix = mixing.mixing_matrix(loops, labels, "language")
    assert {tuple(r) for r in matrix.collect()} == {("x", "x", 1), ("x", "y", 1), ("y", "x", 1)}


def test_attribute_lookup(micro, as_dict):
    assert as_dict(mixing.attr_counts(micro.vertices, "language"), "language", "n_vertices") == {
        "EN": 2, "DE": 2, "FR": 1,
    }
    found = mixing.vertices_with_attr(micro.vertices, "language", "DE").collect()
    assert sorted(r.id for r in found) == [3, 4]


def test_bfs(spark, micro):
    sources = spark.createDataFrame([(1,), (5,)], "id bigint")
    got = {tuple(r) for r in paths.bfs_distances(micro.edges, sources).collect()}
    assert got == {(1, 1, 0), (1, 2, 1), (1, 3, 1), (1, 4, 2), (5, 5, 0)}
    summary = {r.source: (r.reached, r.avg_dist) for r in paths.bfs_summary(
        paths.bfs_distances(micro.edges, sources)).collect()}
    assert summary == {1: (4, 1.0), 5: (1, 0.0)}


def test_bfs_depth_bound_is_inclusive(spark, make_graph):
    path = make_graph({i: "x" for i in range(9)}, [(i, i + 1) for i in range(8)])
    start = spark.createDataFrame([(0,)], "id bigint")
    bounded = paths.bfs_distances(path.edges, start, max_depth=6)
    assert sorted(r.dist for r in bounded.collect()) == list(range(7))
    unbounded = paths.bfs_distances(path.edges, start)
    assert sorted(r.dist for r in unbounded.collect()) == list(range(9))


def test_betweenness(micro, as_dict):
    scores = paths.betweenness(micro.vertices, micro.edges, micro.vertices.select("id"))
    assert as_dict(scores, "id", "score") == {1: 0.0, 2: 0.0, 3: 4.0, 4: 0.0, 5: 0.0}
    top = paths.betweenness_top(micro.vertices, micro.edges, micro.vertices.select("id"), k=2, batch=2)
    assert [tuple(r) for r in top.collect()] == [(3, 4.0), (1, 0.0)]


@pytest.mark.parametrize("lanes", [0, 65])
def test_lanes_are_checked_on_entry(micro, lanes):
    ids = micro.vertices.select("id")
    with pytest.raises(ValueError, match="1 to 64"):
        paths.bfs_distances(micro.edges, ids, lanes=lanes)
    with pytest.raises(ValueError, match="1 to 64"):
        paths.betweenness(micro.vertices, micro.edges, ids, batch=lanes)


def test_top_of_tiny_scores(spark):
    scores = [1.45e-10, 0.9e-10, 1.0e-10, 0.5e-10, 1.4500000000000001e-10, 0.0]
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(scores)], "id bigint, score double")
    assert [r.id for r in top_k(rows, "score", 6).collect()] == [0, 4, 2, 1, 3, 5]


def test_wedges_of_huge_hubs(spark, micro, monkeypatch):
    degrees = spark.createDataFrame([(i, 3_000_000_000) for i in range(4)], "src bigint, degree bigint")
    monkeypatch.setattr(clustering, "out_degree", lambda edges: degrees)
    wedges = clustering.wedge_count(micro.edges).first().wedges
    assert int(wedges) == 4 * (3_000_000_000 * 2_999_999_999 // 2)


def test_numbering_counts_on_over_partitions(spark):
    ids = spark.range(5000).select((F.col("id") * 7 % 5000).alias("id")).repartition(8)
    got = paths.numbered(ids.unionAll(ids)).collect()
    assert sorted((r.id, r.number) for r in got) == [(i, i) for i in range(5000)]


def test_betweenness_without_edges(micro):
    none = micro.edges.where("false")
    scores = paths.betweenness(micro.vertices, none, micro.vertices.select("id")).collect()
    assert {r.id: r.score for r in scores} == dict.fromkeys(range(1, 6), 0.0)


def test_pagerank(micro, as_dict):
    ranks = pagerank.uniform_ranks(micro.vertices)
    want = {1: 0.171667, 2: 0.171667, 3: 0.37, 4: 0.086667, 5: 0.03}
    step = as_dict(pagerank.pagerank_step(micro.vertices, micro.edges, ranks), "id", "rank")
    assert step == pytest.approx(want, abs=1e-6)
    loop = as_dict(pagerank.pagerank(micro.vertices, micro.edges, iterations=1), "id", "rank")
    assert loop == pytest.approx(want, abs=1e-6)
    assert sum(loop.values()) == pytest.approx(0.83)


def test_pagerank_steps_and_loop_agree(micro, as_dict):
    ranks = pagerank.uniform_ranks(micro.vertices)
    for _ in range(3):
        ranks = pagerank.pagerank_step(micro.vertices, micro.edges, ranks)
    stepped = as_dict(ranks, "id", "rank")
    for every in (1, 2, 5):
        looped = pagerank.pagerank(micro.vertices, micro.edges, 3, checkpoint_every=every)
        assert as_dict(looped, "id", "rank") == pytest.approx(stepped)


def test_pagerank_of_nothing(micro):
    assert pagerank.pagerank(micro.vertices.where("false"), micro.edges.where("false")).count() == 0
    start = pagerank.pagerank(micro.vertices, micro.edges, iterations=0).collect()
    assert {r.rank for r in start} == {0.2}


def test_pagerank_drops_rank_sent_to_missing_vertices(spark, as_dict):
    """As a left join from the vertices does: vertex 9 takes its share and is gone."""
    vertices = spark.createDataFrame([(1,), (2,)], "id bigint")
    links = spark.createDataFrame([(1, 2), (2, 1), (1, 9), (9, 1)], "src bigint, dst bigint")
    got = as_dict(pagerank.pagerank(vertices, links, iterations=1), "id", "rank")
    assert got == pytest.approx({1: 0.075 + 0.85 * 0.5, 2: 0.075 + 0.85 * 0.25})


def test_samples(micro):
    kept = sample.induced_subgraph(micro, 3)
    assert sorted(tuple(r) for r in kept.edges.collect()) == [
        (1, 2), (1, 3), (2, 1), (2, 3), (3, 1), (3, 2),
    ]
    assert sorted(r.id for r in kept.vertices.collect()) == [1, 2, 3]
    for whole in (0, None):
        assert sample.induced_subgraph(micro, whole) == Graph(micro.vertices, micro.edges)
    picked = [r.id for r in sample.sample_sources(micro.vertices, 2).collect()]
    again = [r.id for r in sample.sample_sources(micro.vertices.repartition(3), 2).collect()]
    assert len(picked) == 2 and picked == again
