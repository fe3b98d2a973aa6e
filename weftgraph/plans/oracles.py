"""The registered queries as SQL for an independent engine."""

from __future__ import annotations

from weftgraph.plans.queries import ADJACENCY_BLOCK, MAX_DEPTH, SOURCES

SALES = "lineitem JOIN orders ON l_orderkey = o_orderkey"


def _links(condition: str) -> str:
    return f"""
        SELECT l_partkey * 4 AS a, l_suppkey * 4 + 1 AS b FROM {SALES} WHERE {condition}
        UNION ALL SELECT l_partkey * 4, o_custkey * 4 + 2 FROM {SALES} WHERE {condition}
        UNION ALL SELECT l_suppkey * 4 + 1, o_custkey * 4 + 2 FROM {SALES} WHERE {condition}"""


def _both_ways(links: str, prefix: str = "") -> str:
    """CTEs ``el`` and ``e``: distinct undirected edges, and both directions of them."""
    return f"""
        {prefix}el AS MATERIALIZED (SELECT DISTINCT least(a, b) AS a, greatest(a, b) AS b FROM ({links}) WHERE a <> b),
        {prefix}e AS MATERIALIZED (SELECT a AS src, b AS dst FROM {prefix}el UNION ALL SELECT b, a FROM {prefix}el)"""


PARTS = "SELECT p_partkey * 4 AS id, p_type AS attr FROM part"
TRADE_VERTICES = f"""
    v AS MATERIALIZED ({PARTS}
        UNION ALL SELECT s_suppkey * 4 + 1, n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey
        UNION ALL SELECT c_custkey * 4 + 2, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey)"""
TRADE = f"{TRADE_VERTICES}, {_both_ways(_links('true'))}"

ORDER_LINKS = f"""SELECT o_orderkey * 4 + 3 AS a, unnest([o_custkey * 4 + 2, l_partkey * 4, l_suppkey * 4 + 1]) AS b FROM {SALES}"""
ORDERS = f"""v AS MATERIALIZED ({PARTS} UNION ALL SELECT c_custkey * 4 + 2, c_mktsegment FROM customer
        UNION ALL SELECT s_suppkey * 4 + 1, 'supplier' FROM supplier UNION ALL SELECT o_orderkey * 4 + 3, o_orderpriority FROM orders),
    {_both_ways(ORDER_LINKS)}"""

SEGMENT = "(('0x' || substr(md5(c_mktsegment), 1, 7))::BIGINT % 1048576) * 4"
HUB_LINKS = f"""SELECT c_custkey * 4 + 2 AS a, c_nationkey * 4 + 1 AS b FROM customer
    UNION ALL SELECT c_custkey * 4 + 2, {SEGMENT} FROM customer
    UNION ALL SELECT c_nationkey * 4 + 1, {SEGMENT} FROM customer"""
HUBS = f"""{_both_ways(HUB_LINKS)}, v AS MATERIALIZED (SELECT DISTINCT src AS id FROM e)"""

GEO_LINKS = """SELECT c_nationkey * 4 + 1 AS a, c_custkey * 4 + 3 AS b FROM customer
    UNION ALL SELECT s_nationkey * 4 + 1, s_suppkey * 4 + 2 FROM supplier
    UNION ALL SELECT n_regionkey * 4, n_nationkey * 4 + 1 FROM nation"""
GEO = f"""v AS MATERIALIZED (SELECT c_custkey * 4 + 3 AS id, n_regionkey::VARCHAR AS attr FROM customer JOIN nation ON n_nationkey = c_nationkey
        UNION ALL SELECT s_suppkey * 4 + 2, n_regionkey::VARCHAR FROM supplier JOIN nation ON n_nationkey = s_nationkey
        UNION ALL SELECT n_nationkey * 4 + 1, n_regionkey::VARCHAR FROM nation
        UNION ALL SELECT r_regionkey * 4, r_regionkey::VARCHAR FROM region),
    {_both_ways(GEO_LINKS)}"""

DEGREES = "deg AS MATERIALIZED (SELECT src, count(*) AS d FROM e GROUP BY src)"
# The higher neighbours of both ends of an edge, intersected as lists.
TRIANGLES = """above AS MATERIALIZED (SELECT a, list(b) AS bs FROM el GROUP BY a),
    tri AS MATERIALIZED (SELECT el.a AS a, el.b AS b, unnest(list_intersect(x.bs, y.bs)) AS c
        FROM el JOIN above x ON x.a = el.a JOIN above y ON y.a = el.b)"""
LOCAL = f"""{DEGREES}, {TRIANGLES},
    corner AS (SELECT id, count(*) AS t FROM (SELECT a AS id FROM tri UNION ALL SELECT b FROM tri UNION ALL SELECT c FROM tri) GROUP BY id),
    cc AS (SELECT v.id, coalesce(d, 0) AS degree, coalesce(t, 0) AS triangles,
        CASE WHEN coalesce(d, 0) < 2 THEN 0.0::DOUBLE ELSE 2.0::DOUBLE * coalesce(t, 0) / (d * (d - 1)) END AS coefficient
        FROM v LEFT JOIN deg ON deg.src = v.id LEFT JOIN corner ON corner.id = v.id)"""
ATTR_JOIN = """SELECT src, dst, va.attr AS la, vb.attr AS lb FROM e
    JOIN v va ON va.id = src JOIN v vb ON vb.id = dst"""


def _assortativity(graph: str) -> str:
    return f"""WITH {graph}, m AS (SELECT la, lb, count(*) AS cnt FROM ({ATTR_JOIN}) GROUP BY la, lb),
        total AS (SELECT sum(cnt)::DOUBLE AS n FROM m),
        ai AS (SELECT la AS l, sum(cnt) / any_value(n) AS s FROM m, total GROUP BY la),
        bi AS (SELECT lb AS l, sum(cnt) / any_value(n) AS s FROM m, total GROUP BY lb),
        ab AS (SELECT sum(ai.s * bi.s) AS s FROM ai JOIN bi ON ai.l = bi.l),
        tr AS (SELECT sum(cnt) AS t FROM m WHERE la = lb)
        SELECT n::BIGINT AS edges, t::BIGINT AS on_diagonal, round((t / n - s) / (1 - s), 6) AS assortativity
        FROM total, ab, tr"""


def _ranks(graph: str, iterations: int) -> str:
    """CTEs up to ``r<iterations>``: the rank vector after each step."""
    steps = [f"{graph}, {DEGREES}, r0 AS MATERIALIZED (SELECT id, 1.0::DOUBLE / (SELECT count(*) FROM v) AS rank FROM v)"]
    for i in range(iterations):
        steps.append(
            f"""r{i + 1} AS MATERIALIZED (
            SELECT v.id, 0.15::DOUBLE / (SELECT count(*) FROM v) + 0.85::DOUBLE * coalesce(s.x, 0) AS rank
            FROM v LEFT JOIN (SELECT dst, sum(r.rank / d) AS x FROM e JOIN r{i} r ON r.id = e.src
                JOIN deg ON deg.src = e.src GROUP BY dst) s ON s.dst = v.id)"""
        )
    return ", ".join(steps)


PAGERANK = "SELECT id, round(rank, 10) AS rank FROM r{}"
SAMPLE = f"SELECT id FROM v ORDER BY md5(concat(id::VARCHAR, ':42')), id LIMIT {SOURCES}"


def levels(depth: int) -> list[str]:
    """CTEs ``l0`` to ``l<depth>``: the vertices ``n`` at each distance from the sources ``s``.

    A neighbour of a vertex at distance k is at distance k - 1, k or k + 1.
    """
    ctes = ["l0 AS MATERIALIZED (SELECT id AS s, id AS n FROM srcs)"]
    for k in range(1, depth + 1):
        unseen = " AND ".join(
            f"NOT EXISTS (SELECT 1 FROM l{j} p WHERE p.s = x.s AND p.n = x.n)"
            for j in range(max(0, k - 2), k)
        )
        ctes.append(
            f"""l{k} AS MATERIALIZED (SELECT s, n FROM (
            SELECT DISTINCT l.s AS s, e.dst AS n FROM l{k - 1} l JOIN e ON e.src = l.n) x WHERE {unseen})"""
        )
    return ctes


def bfs(graph: str, depth: int) -> str:
    found = " UNION ALL ".join(f"SELECT s, n, {k} AS d FROM l{k}" for k in range(depth + 1))
    return f"""WITH {graph}, srcs AS MATERIALIZED ({SAMPLE}), {", ".join(levels(depth))},
        bfs AS (SELECT s AS source, n AS node, d::INTEGER AS dist FROM ({found}))"""


# Farther than any vertex of the order graph; a test checks that the last level is empty.
FAR = 14
SUMMARY = "SELECT source, count(*) AS reached, round(avg(dist), 6) AS avg_dist FROM bfs GROUP BY source"


def _betweenness(depth: int) -> str:
    """Brandes written out for distances up to ``depth``.

    ``l<k>`` holds the vertices at distance k with their path counts and ``d<k>``
    their dependencies. Sources of the sample reach nothing farther than
    ``depth`` - 1, so that the last level is empty, as a test checks.
    """
    ctes = [TRADE, f"srcs AS MATERIALIZED ({SAMPLE})"]
    ctes.append("l0 AS MATERIALIZED (SELECT id AS s, id AS n, 1.0::DOUBLE AS sigma FROM srcs)")
    for k in range(1, depth + 1):
        near = [k - 1] if k == 1 else [k - 1, k - 2]
        unseen = " AND ".join(
            f"NOT EXISTS (SELECT 1 FROM l{j} p WHERE p.s = x.s AND p.n = x.n)" for j in near
        )
        ctes.append(
            f"""l{k} AS MATERIALIZED (SELECT s, n, sigma FROM (
            SELECT l.s AS s, e.dst AS n, sum(l.sigma) AS sigma FROM l{k - 1} l JOIN e ON e.src = l.n GROUP BY 1, 2) x WHERE {unseen})"""
        )
    ctes.append(f"d{depth} AS MATERIALIZED (SELECT s, n, sigma, 0.0::DOUBLE AS delta FROM l{depth})")
    for k in range(depth - 1, 0, -1):
        ctes.append(
            f"""d{k} AS MATERIALIZED (SELECT l.s, l.n, any_value(l.sigma) AS sigma,
            coalesce(sum(l.sigma / f.sigma * (1 + f.delta)), 0) AS delta
            FROM l{k} l JOIN e ON e.src = l.n LEFT JOIN d{k + 1} f ON f.s = l.s AND f.n = e.dst GROUP BY l.s, l.n)"""
        )
    deltas = " UNION ALL ".join(f"SELECT n, delta FROM d{k}" for k in range(1, depth + 1))
    return f"""WITH {", ".join(ctes)}, b AS (
        SELECT v.id, round(coalesce(sum(delta), 0), 6) AS score FROM v LEFT JOIN ({deltas}) ON n = v.id GROUP BY v.id)"""


DEEP = 6
BETWEENNESS = _betweenness(DEEP)

GAP = "p_partkey % 7 = 0"
FLAGS = f"""(CASE WHEN {GAP} THEN FALSE ELSE p_size % 2 = 1 END) AS mature,
    (p_size % 3 = 0) AS dead_account, (p_size % 2 = 0) AS affiliate"""
LIFE = f"CASE WHEN {GAP} THEN 0 ELSE p_size END::INTEGER AS life_time"
LANGUAGE = f"CASE WHEN {GAP} THEN 'UNK' ELSE p_type END AS language"
KNOWN = f"""{TRADE}, k AS MATERIALIZED (SELECT id FROM v
    WHERE id NOT IN (SELECT p_partkey * 4 FROM part WHERE p_brand = 'Brand#1'))"""
CHECKED = """SELECT src, dst, NOT EXISTS (SELECT 1 FROM k WHERE k.id = src) AS src_missing,
    NOT EXISTS (SELECT 1 FROM k WHERE k.id = dst) AS dst_missing FROM e"""
TOTALS = "SELECT event_type, sum(round(value * 100)::BIGINT)::BIGINT AS total FROM events GROUP BY event_type"
STATS = """count(*) AS n_vertices, round(avg(degree), 6) AS avg_degree,
    round(stddev_pop(degree), 6) AS std_degree, max(degree)::BIGINT AS max_degree"""
CENTS = "round(value * 100)::BIGINT"



def _bucket(buckets: int) -> str:
    return f"(('0x' || substr(md5(src::VARCHAR), 1, 8))::BIGINT % {buckets})::INTEGER"


ORACLES: dict[str, str] = {
    "read_vertices": f"""SELECT p_partkey AS id, p_size::BIGINT AS views, {LIFE}, {LANGUAGE}, {FLAGS} FROM part""",
    "read_edges": f"WITH {TRADE} SELECT a, b FROM el",
    "normalize_flags": f"SELECT p_partkey AS id, {FLAGS} FROM part",
    "normalize_ints": f"SELECT p_partkey AS id, p_size::BIGINT AS views, {LIFE} FROM part",
    "normalize_attr": f"SELECT p_partkey AS id, {LANGUAGE} FROM part",
    "symmetrize_edges": f"WITH {TRADE} SELECT src, dst FROM e",
    "load_counts": f"""WITH {TRADE} SELECT 'vertices' AS "table", count(*) AS n_rows FROM v
        UNION ALL SELECT 'edges', count(*) FROM e UNION ALL SELECT 'vertices_by_attr', count(*) FROM v""",
    "edges_per_bucket": f"WITH {TRADE} SELECT (src % 8)::INTEGER AS src_bucket, count(*) AS n_edges FROM e GROUP BY 1",
    "insert_if_absent": f"""WITH {TRADE}, {_both_ways(_links("o_orderstatus = 'F'"), "old_")}
        SELECT src, dst FROM e EXCEPT SELECT src, dst FROM old_e""",
    "upsert_latest": """SELECT user_id, ts, event_id, event_type FROM (SELECT *, row_number() OVER (
        PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""",
    "duplicate_keys": "SELECT l_orderkey, count(*) AS n_rows FROM lineitem GROUP BY l_orderkey HAVING count(*) > 1",
    "edges_valid": f"WITH {KNOWN} SELECT src, dst FROM ({CHECKED}) WHERE NOT src_missing AND NOT dst_missing",
    "edges_orphan": f"WITH {KNOWN} SELECT * FROM ({CHECKED}) WHERE src_missing OR dst_missing",
    "graph_counts": f"""WITH {TRADE}, nv AS (SELECT count(*) AS n FROM v), ne AS (SELECT count(*) AS m FROM el)
        SELECT n AS n_vertices, m AS n_edges, round(2.0::DOUBLE * m / n, 6) AS mean_degree FROM nv, ne""",
    "induced_subgraph": f"""WITH {TRADE}, kept AS MATERIALIZED (SELECT id FROM v ORDER BY id LIMIT 200)
        SELECT src, dst FROM e WHERE src IN (SELECT id FROM kept) AND dst IN (SELECT id FROM kept)""",
    "neighbors": f"WITH {TRADE} SELECT src, dst FROM e WHERE src = 0",
    "edge_exists": f"""WITH {TRADE}, pairs AS (SELECT DISTINCT l_suppkey * 4 + 1 AS src, l_partkey * 4 + 2 AS dst FROM lineitem)
        SELECT src, dst FROM pairs SEMI JOIN e USING (src, dst)""",
    "vertices_with_attr": f"SELECT id FROM ({PARTS}) WHERE attr = 'ECONOMY'",
    "vertices_by_attr": f"WITH {TRADE_VERTICES} SELECT attr, id FROM v",
    "attr_counts": f"WITH {TRADE_VERTICES} SELECT attr, count(*) AS n_vertices FROM v GROUP BY attr",
    "out_degree": f"WITH {TRADE} SELECT src, count(*) AS degree FROM e GROUP BY src",
    "degree_stats": f"WITH {ORDERS} SELECT {STATS} FROM (SELECT count(*) AS degree FROM e GROUP BY src)",
    "degree_stats_all": f"""WITH {ORDERS} SELECT {STATS} FROM (
        SELECT v.id, count(e.src) AS degree FROM v LEFT JOIN e ON e.src = v.id GROUP BY v.id)""",
    "degree_local": f"""WITH {TRADE} SELECT src AS node_id, count(*) AS degree FROM e
        WHERE src = (SELECT min(src) FROM e) GROUP BY src""",
    "degree_histogram": f"""WITH {TRADE}, {DEGREES} SELECT bin::INTEGER AS bin, (1::BIGINT << bin::BIGINT) AS low,
        (1::BIGINT << (bin + 1)::BIGINT) - 1 AS high, count(*) AS n_vertices
        FROM (SELECT length(bin(d)) - 1 AS bin FROM deg) GROUP BY 1, 2, 3""",
    "adjacency_list": f"""WITH {TRADE} SELECT src, dst // {ADJACENCY_BLOCK} AS block, count(*) AS n,
        string_agg(dst::VARCHAR, ',' ORDER BY dst) AS neighbors FROM e GROUP BY 1, 2""",
    "wedge_count": f"WITH {TRADE}, {DEGREES} SELECT sum(d * (d - 1) // 2)::BIGINT AS wedges FROM deg",
    "triangle_list": f"WITH {TRADE}, {TRIANGLES} SELECT a, b, c FROM tri",
    "triangle_count": f"WITH {TRADE}, {TRIANGLES} SELECT count(*) AS triangles FROM tri",
    "transitivity": f"""WITH {TRADE}, {DEGREES}, {TRIANGLES}, t AS (SELECT count(*) AS triangles FROM tri),
        w AS (SELECT sum(d * (d - 1) // 2)::BIGINT AS wedges FROM deg)
        SELECT triangles, wedges, round(3.0::DOUBLE * triangles / nullif(wedges, 0), 6) AS transitivity FROM t, w""",
    "local_cc": f"WITH {TRADE}, {LOCAL} SELECT id, degree, triangles, round(coefficient, 6) AS coefficient FROM cc",
    "avg_local_cc": f"""WITH {TRADE}, {LOCAL} SELECT round(avg(coefficient), 6) AS avg_local_cc,
        (sum(triangles) // 3)::BIGINT AS triangles FROM cc""",
    "edge_attr_join": f"WITH {TRADE} {ATTR_JOIN}",
    "mixing_matrix": f"WITH {TRADE} SELECT la, lb, count(*) AS cnt FROM ({ATTR_JOIN}) GROUP BY la, lb",
    "assortativity": _assortativity(TRADE),
    "assortativity_geo": _assortativity(GEO),
    "pagerank_step": f"WITH {_ranks(TRADE, 1)} {PAGERANK.format(1)}",
    "pagerank": f"WITH {_ranks(TRADE, 10)} {PAGERANK.format(10)}",
    "pagerank_isolated": f"WITH {_ranks(ORDERS, 10)} {PAGERANK.format(10)}",
    "pagerank_top10": f"WITH {_ranks(TRADE, 10)} SELECT * FROM ({PAGERANK.format(10)}) ORDER BY rank DESC, id LIMIT 10",
    "bfs_distances": f"{bfs(TRADE, MAX_DEPTH)} SELECT source, node, dist FROM bfs",
    "bfs_summary": f"{bfs(ORDERS, MAX_DEPTH)} {SUMMARY}",
    "bfs_summary_unbounded": f"{bfs(ORDERS, FAR)} {SUMMARY}",
    "sample_sources": f"WITH {TRADE_VERTICES} {SAMPLE}",
    "betweenness": f"{BETWEENNESS} SELECT id, score FROM b",
    "betweenness_top10": f"{BETWEENNESS} SELECT id, score FROM b ORDER BY score DESC, id LIMIT 10",
    "grouped_median": """SELECT event_type, count(value) AS n, round(median(value), 6) AS median
        FROM events WHERE value IS NOT NULL GROUP BY event_type""",
    "timing_pivot": """SELECT event_type AS metric,
        round(median(value) FILTER (WHERE user_id % 2 = 0), 6) AS system_0,
        round(median(value) FILTER (WHERE user_id % 2 = 1), 6) AS system_1 FROM events GROUP BY event_type""",
    "merge_results": f"""SELECT event_type, (CASE WHEN event_type IN ('click', 'view') THEN total * 2 ELSE total END)::BIGINT AS total
        FROM ({TOTALS})""",
    "ledger_reconcile": f"""WITH m AS (SELECT user_id AS id, sum({CENTS})::BIGINT AS moved FROM events GROUP BY user_id)
        SELECT id, 1000 + moved + (CASE WHEN id % 10 = 0 THEN 1 ELSE 0 END) AS final_balance,
        1000 + moved AS expected_balance, id % 10 <> 0 AS consistent FROM m""",
    "neighbors_stored": f"WITH {TRADE} SELECT src, dst FROM e WHERE src = 0",
    "degree_local_stored": f"WITH {TRADE} SELECT src AS node_id, count(*) AS degree FROM e WHERE src = 0 GROUP BY src",
    "vertices_with_attr_stored": f"SELECT id FROM ({PARTS}) WHERE attr = 'ECONOMY'",
    "stored_edge_order": f"""WITH {TRADE} SELECT {_bucket(16)} AS src_bucket, count(*) AS n_edges, 0::BIGINT AS out_of_order
        FROM e GROUP BY 1""",
    "append_absent_edges": f"WITH {TRADE} SELECT src, dst FROM e",
    "append_filtered_edges": f"WITH {TRADE} SELECT src, dst FROM e",
    "upsert_stored": """SELECT user_id, ts, event_id, event_type FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
    "edges_per_bucket_hash": f"WITH {TRADE} SELECT {_bucket(8)} AS src_bucket, count(*) AS n_edges FROM e GROUP BY 1",
    "results_json": f"WITH {TRADE} SELECT src, count(*) AS degree, TRUE AS stamped FROM e GROUP BY src",
    "triangles_of_a_hub": f"""WITH {HUBS}, {TRIANGLES} SELECT id, count(*) AS triangles
        FROM (SELECT unnest([a, b, c]) AS id FROM tri) GROUP BY id""",
    "pagerank_of_a_hub": f"WITH {_ranks(HUBS, 10)} {PAGERANK.format(10)}",
    "metric_diff": f"""WITH {_both_ways(_links('true'))}, {_both_ways(ORDER_LINKS, 'r_')},
        x AS (SELECT src AS metric, count(*)::DOUBLE AS value FROM e GROUP BY src),
        y AS (SELECT src AS metric, count(*)::DOUBLE AS value FROM r_e GROUP BY src)
        SELECT coalesce(x.metric, y.metric) AS metric, x.value AS left_value, y.value AS right_value,
        coalesce(x.value = y.value, FALSE) AS same FROM x FULL JOIN y ON x.metric = y.metric""",
}


def _fields(metric: str, key: str, *names: str) -> str:
    listed = ", ".join(f"struct_pack(f := '{n}', x := {n}::DOUBLE)" for n in names)
    return f"""SELECT '{metric}' AS metric, unnest([{listed}]) AS r FROM ({ORACLES[key]})"""


def _ranking(metric: str, key: str, score: str) -> str:
    return f"""SELECT '{metric}' AS metric, struct_pack(f := id::VARCHAR, x := {score}) AS r FROM ({ORACLES[key]})"""


_STATS_OF_TRADE = ORACLES["degree_stats"].replace(ORDERS, TRADE)
ORACLES["run_metrics"] = f"""SELECT metric, r.f AS field, round(r.x, 6) AS value FROM (
    SELECT 'degree' AS metric, unnest([struct_pack(f := 'n_vertices', x := n_vertices::DOUBLE),
        struct_pack(f := 'avg_degree', x := avg_degree), struct_pack(f := 'std_degree', x := std_degree),
        struct_pack(f := 'max_degree', x := max_degree::DOUBLE)]) AS r FROM ({_STATS_OF_TRADE})
    UNION ALL {_fields("clustering", "transitivity", "triangles", "wedges", "transitivity")}
    UNION ALL {_fields("local_clustering", "avg_local_cc", "avg_local_cc", "triangles")}
    UNION ALL {_ranking("betweenness", "betweenness_top10", "score")}
    UNION ALL {_ranking("pagerank", "pagerank_top10", "rank")}
    UNION ALL {_fields("assortativity", "assortativity", "edges", "on_diagonal", "assortativity")})"""
