from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from weftgraph.graph import Graph  # noqa: E402
from weftgraph.operators.edges import symmetrize  # noqa: E402
from weftgraph.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", "8", 4, **{"spark.driver.memory": "8g"})
    yield session
    session.stop()


@pytest.fixture(scope="session")
def make_graph(spark):
    def build(labels: dict[int, str], links: list[tuple[int, int]]) -> Graph:
        vertices = spark.createDataFrame(list(labels.items()), "id bigint, language string")
        edge_list = spark.createDataFrame(links, "a bigint, b bigint")
        return Graph(vertices, symmetrize(edge_list))

    return build


@pytest.fixture(scope="session")
def micro(make_graph):
    """Two EN, two DE and an isolated FR vertex; a triangle with a tail."""
    labels = {1: "EN", 2: "EN", 3: "DE", 4: "DE", 5: "FR"}
    return make_graph(labels, [(1, 2), (1, 3), (2, 3), (3, 4)])


@pytest.fixture
def as_dict():
    def convert(df, key, value):
        return {row[key]: row[value] for row in df.collect()}

    return convert
