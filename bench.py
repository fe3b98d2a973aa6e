"""Times the headline metrics and prints one JSON line.

The trade graph is derived and written (``load``); every metric then reads the
written graph. Each time is the median of the runs after one that does not count.
"""

from __future__ import annotations

import json
import os
import sys

from weftgraph.operators import clustering, degree, mixing, pagerank, paths, sample
from weftgraph.plans.graphs import trade_graph
from weftgraph.plans.metrics import median_seconds, timed
from weftgraph.session import local_session, scratch_path
from weftgraph.sources import tables

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "2"))
SOURCES = 128


def main() -> None:
    memory = {"spark.driver.memory": "16g"}
    spark = local_session("bench", CPUS, int(CPUS) if CPUS.isdigit() else 8, **memory)
    paths_written = []

    def load() -> None:
        path = scratch_path(spark, "bench-graph")
        trade = trade_graph(spark, SF_DIR)
        counts = tables.write_graph(trade.vertices, trade.edges, path, attr="attr").collect()
        paths_written.append((path, {row["table"]: row["n_rows"] for row in counts}))

    seconds = {"load": timed(load, 1)}
    path, loaded = paths_written[-1]
    stored = tables.open_graph(spark, path)
    v, e = stored.graph.vertices, stored.graph.edges
    sources = sample.sample_sources(v, SOURCES)
    queries = {
        "degree": lambda: degree.degree_stats(e).collect(),
        "degree_local": lambda: degree.degree_local(stored.edges_of(0), 0).collect(),
        "clustering": lambda: clustering.transitivity(e).collect(),
        "local_clustering": lambda: clustering.avg_local_cc(v, e).collect(),
        "betweenness": lambda: paths.betweenness_top(v, e, sources).collect(),
        "bfs": lambda: paths.bfs_summary(paths.bfs_distances(e, sources)).collect(),
        "pagerank": lambda: pagerank.pagerank_top(v, e).collect(),
        "assortativity": lambda: mixing.assortativity(e, v, "attr").collect(),
    }
    for name, action in queries.items():
        seconds[name] = timed(action, RUNS)
        print(name, [round(s, 2) for s in seconds[name]], file=sys.stderr, flush=True)
    result = {name: round(sec, 3) for name, sec in median_seconds(seconds).items()}
    line = {
        "metric": "graph_metrics_total",
        "value": round(sum(result.values()), 3),
        "unit": "sec",
        "queries": result,
        "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
        "rows": loaded,
        "sources": SOURCES,
        "betweenness_sec_per_source_and_edge": result["betweenness"] / SOURCES / loaded["edges"],
    }
    print(json.dumps(line))


if __name__ == "__main__":
    main()
