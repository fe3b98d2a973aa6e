"""CSV scans of vertices and edges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weftgraph.functions.normalize import to_attribute, to_flag, to_integer, to_key
from weftgraph.graph import Graph
from weftgraph.operators.edges import symmetrize

# The columns of a raw vertex file that become attributes. All
# others, such as creation and update dates, are dropped.
INTEGER_COLUMNS = {"views": "bigint", "life_time": "int"}
FLAG_COLUMNS = ("mature", "dead_account", "affiliate")
KEY_COLUMN = "numeric_id"
VERTEX_COLUMNS = ("id", "views", "mature", "life_time", "dead_account", "language", "affiliate")


def normalize_vertices(raw: DataFrame) -> DataFrame:
    """Typed vertices from text columns; an absent column counts as empty."""

    def text(name: str) -> Column:
        return F.col(name) if name in raw.columns else F.lit(None).cast("string")

    columns = {"id": to_key(text(KEY_COLUMN), KEY_COLUMN), "language": to_attribute(text("language"))}
    columns |= {name: to_integer(text(name), kind) for name, kind in INTEGER_COLUMNS.items()}
    columns |= {name: to_flag(text(name)) for name in FLAG_COLUMNS}
    return raw.select(*[columns[name].alias(name) for name in VERTEX_COLUMNS])


def read_vertices(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Vertices from CSV files with a header; columns are found by name.

    Nothing is inferred: all columns are read as text and then typed, and a bad
    integer fails the query. A doubled quote inside quotes is one quote. With
    ``multi_line`` quoted line breaks belong to the value; a file is then read by one task.
    """
    return normalize_vertices(
        spark.read.csv(path, header=True, quote='"', escape='"', multiLine=multi_line)
    )


def read_edges(spark: SparkSession, path: str) -> DataFrame:
    """``(a, b)`` from two-column CSV files whose header line is skipped.

    A line without exactly two integers fails the query.
    """
    return spark.read.schema("a bigint, b bigint").csv(
        path,
        header=True,
        mode="FAILFAST",
        ignoreLeadingWhiteSpace=True,
        ignoreTrailingWhiteSpace=True,
    )


def read_csv_graph(spark: SparkSession, vertex_path: str, edge_path: str) -> Graph:
    """The graph of a raw vertex file and a raw edge file."""
    return Graph(read_vertices(spark, vertex_path), symmetrize(read_edges(spark, edge_path)))
