"""Building, checking and looking up edges."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ADJACENCY_BLOCK = 65_536


def symmetrize(edge_list: DataFrame, keep_self_loops: bool = False) -> DataFrame:
    """Both directions of every undirected edge ``(a, b)``, each once.

    Repeated and reversed input edges collapse. The de-duplication hashes the
    whole pair, so a vertex with very many edges does not make a hot partition.
    """
    low, high = F.least("a", "b"), F.greatest("a", "b")
    pairs = edge_list.select(low.alias("a"), high.alias("b"))
    if not keep_self_loops:
        pairs = pairs.where("a < b")
    forth, back = _directions("a", "b")
    both = F.when(F.col("a") == F.col("b"), F.array(forth)).otherwise(F.array(forth, back))
    return pairs.distinct().select(F.inline(both if keep_self_loops else F.array(forth, back)))


def _directions(a: str, b: str) -> tuple[Column, Column]:
    """An edge as ``(src, dst)`` there and back."""
    return tuple(F.struct(F.col(x).alias("src"), F.col(y).alias("dst")) for x, y in ((a, b), (b, a)))


def undirected(edges: DataFrame) -> DataFrame:
    """Each undirected edge once, as ``src < dst``."""
    return edges.where("src < dst")


def both_ways(once: DataFrame) -> DataFrame:
    """The edges of which ``once`` is ``undirected``, in both directions."""
    return once.select(F.inline(F.array(*_directions("src", "dst"))))


def endpoint_check(edges: DataFrame, vertices: DataFrame) -> DataFrame:
    """Edges with the flags ``src_missing`` and ``dst_missing``."""
    source = vertices.select(F.col("id").alias("src"), F.lit(True).alias("src_known"))
    target = vertices.select(F.col("id").alias("dst"), F.lit(True).alias("dst_known"))
    return (
        edges.join(source, "src", "left")
        .join(target, "dst", "left")
        .select(
            "src",
            "dst",
            F.col("src_known").isNull().alias("src_missing"),
            F.col("dst_known").isNull().alias("dst_missing"),
        )
    )


def edges_valid(edges: DataFrame, vertices: DataFrame) -> DataFrame:
    """Edges whose two endpoints are both vertices."""
    ids = vertices.select("id")
    return (
        edges.join(ids, edges.src == ids.id, "left_semi")
        .join(ids, F.col("dst") == ids.id, "left_semi")
        .select("src", "dst")
    )


def edges_orphan(edges: DataFrame, vertices: DataFrame) -> DataFrame:
    """Edges with at least one endpoint that is no vertex, and which one it is."""
    return endpoint_check(edges, vertices).where("src_missing or dst_missing")


def edge_exists(pairs: DataFrame, edges: DataFrame) -> DataFrame:
    """Those ``(src, dst)`` pairs that are edges."""
    return pairs.join(edges.select("src", "dst"), ["src", "dst"], "left_semi")


def neighbors(edges: DataFrame, vertex: int, bucket: Column | None = None) -> DataFrame:
    """The ordered neighbours of one vertex.

    ``bucket`` is a condition on the layout's partition column; with it only one
    folder of a written graph is read.
    """
    found = edges.where(F.col("src") == F.lit(vertex))
    if bucket is not None:
        found = found.where(bucket)
    return found.select("src", "dst").orderBy("dst")


def adjacency_list(edges: DataFrame, block: int = ADJACENCY_BLOCK) -> DataFrame:
    """Sorted neighbour arrays, as ``(src, block, neighbors)``.

    A row holds the neighbours whose ids lie in one range of ``block`` ids, so no
    array exceeds ``block`` entries whatever the degree. The blocks of a vertex,
    read in order, are its whole ordered adjacency.
    """
    kinds = dict(edges.dtypes)
    number = f"dst div {block}"
    # Rows are shuffled and sorted as they are: collected before or in a hash map, they spill.
    placed = (
        edges.repartition("src", F.expr(number))
        .select("src", F.expr(number).alias("block"), "dst")
        .sortWithinPartitions("src", "block", "dst")
    )
    return placed.mapInArrow(_blocks, f"src {kinds['src']}, block bigint, neighbors array<{kinds['dst']}>")


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(src, block, neighbors)`` from rows in this order; a run that a batch may cut waits for the next."""
    rest: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        starts = np.flatnonzero(_differs(batch, ["src", "block"]))
        if len(starts) == 0 and (not rest or _same_run(rest[-1], batch)):
            rest.append(batch)
            continue
        cut = int(starts[-1]) + 1 if len(starts) else 0
        yield from _lists([*rest, batch.slice(0, cut)])
        rest = [batch.slice(cut)]
    yield from _lists(rest)


def _differs(rows: pa.RecordBatch, names: list[str]) -> np.ndarray:
    """For each row but the first, whether it differs from the one before; null equals null."""
    differ = np.zeros(max(0, rows.num_rows - 1), bool)
    for name in names:
        column = rows.column(name)
        other = pc.not_equal(column.slice(1), column.slice(0, len(differ))).fill_null(False)
        missing = column.is_null().to_numpy(zero_copy_only=False)
        differ |= other.to_numpy(zero_copy_only=False) | (missing[1:] != missing[:-1])
    return differ


def _same_run(before: pa.RecordBatch, after: pa.RecordBatch) -> bool:
    return all(before.column(c)[-1].as_py() == after.column(c)[0].as_py() for c in ("src", "block"))


def _lists(pieces: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in pa.Table.from_batches(pieces).combine_chunks().to_batches() if pieces else []:
        rows = rows.take(pa.array(np.flatnonzero(np.append(True, _differs(rows, ["src", "block", "dst"])))))
        starts = np.flatnonzero(np.append(True, _differs(rows, ["src", "block"])))
        heads = rows.column("dst")
        known = heads.is_valid().to_numpy(zero_copy_only=False)
        ends = np.append(0, np.cumsum(known))[np.append(starts, len(heads))]
        lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), heads.drop_null())
        first = rows.take(pa.array(starts))
        yield pa.RecordBatch.from_arrays(
            [first.column("src"), first.column("block"), lists], ["src", "block", "neighbors"]
        )
