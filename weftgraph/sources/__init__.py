from weftgraph.sources.csv import read_csv_graph, read_edges, read_vertices
from weftgraph.sources.keyed import KeyedTable
from weftgraph.sources.tables import append_to_graph, open_graph, read_graph, write_graph

__all__ = [
    "KeyedTable", "append_to_graph", "open_graph", "read_csv_graph", "read_edges", "read_graph", "read_vertices",
    "write_graph",
]
