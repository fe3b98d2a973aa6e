"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import pytest
from conftest import SMALL
from oracle_check import compare, connect

from __spark_entry__ import entry
from weftgraph.plans import oracles
from weftgraph.plans.oracles import ORACLES
from weftgraph.plans.queries import QUERIES


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, con, name):
    result = compare(spark, con, name, SMALL)
    plan = result.pop("plan")
    assert result["same"], result
    for keyless in ("CartesianProduct", "BroadcastNestedLoopJoin"):
        assert keyless not in plan
    assert result["rows"] > 0


def test_entry(spark):
    rows = entry(spark).collect()
    assert len(rows) == 10 and rows[0].rank >= rows[-1].rank


@pytest.mark.parametrize("sf", ["0.001", "0.01", "0.1"])
def test_sql_walks_are_deep_enough(sf):
    """The SQL writes out a fixed number of levels; the last must be empty at every scale."""
    con = connect(f"/root/testdata/sf{sf}")
    for graph, depth in ((oracles.ORDERS, oracles.FAR), (oracles.TRADE, oracles.DEEP)):
        sources = oracles.SAMPLE.replace(f"LIMIT {oracles.SOURCES}", f"LIMIT {20 if sf == '0.1' else 100}")
        ctes = ", ".join([graph, f"srcs AS MATERIALIZED ({sources})", *oracles.levels(depth)])
        assert con.execute(f"WITH {ctes} SELECT count(*) FROM l{depth}").fetchall() == [(0,)]
