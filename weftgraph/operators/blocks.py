"""Edges in a grid of source rows and target columns, for sums over incoming edges.

Block (r, c) has the edges from the sources of row r to the targets of column c. In a step the
value of a vertex goes to the blocks of its row only, and a block sends one partial sum for each
target of its column, so a step ships about V (rows + columns) values, however many edges
there are. Kept by source alone, sums would go out for nearly every edge.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field, replace
from functools import reduce
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weftgraph.operators.degree import out_degree
from weftgraph.operators.layout import BROADCAST_ROWS, HOT_SHARE
from weftgraph.session import cut, discard, materialize, partitions_for

_VALUES = "node bigint, value double"
_SENT_BYTES = 16  # of a shuffled value with its node, about
# Ways to combine what arrives at a vertex, with the type of the columns.
COMBINED = {"sum": (np.add, "double"), "bit_or": (np.bitwise_or, "bigint")}
# Fewer and larger blocks ship less; so many packed edges take some 40 MB.
EDGES_PER_BLOCK = 8_000_000
EDGES_AT_ONCE = 200_000  # edges of a block that are summed at once
EDGES_PACKED = 1_000_000  # edges that a task packs at once, for all blocks
# Values that a task gathers from at once, about.
GATHERED_BYTES = 64_000_000
# What a step ships per edge of the graph at most before it goes strip by strip, and what any step may.
SHIPPED_PER_EDGE, SHIPPED_LEAST = 4, 256_000_000


def partition_keys(spark: SparkSession, partitions: int) -> list[int]:
    """For each of ``partitions`` hash partitions a number that is dealt to it.

    Blocks named by these numbers have a partition each, where consecutive numbers would leave a
    third of the partitions empty.
    """
    tried = spark.range(40 * partitions).select(
        F.pmod(F.hash("id"), F.lit(partitions)).alias("at"), "id"
    )
    first = tried.groupBy("at").agg(F.min("id").alias("id"))
    held = first.agg(F.sort_array(F.collect_list(F.struct("at", "id"))).alias("keys")).first()["keys"]
    found = {row["at"]: row["id"] for row in held}
    # Should some partition have no number among those tried, its block shares another's.
    return [found.get(i, i) for i in range(partitions)]


@dataclass(frozen=True)
class BlockLayout:
    """Edges persisted in blocks, one hash partition each, packed into a few bytes an edge.

    The edges of a hot vertex, and those into it, are dealt over all blocks of the grid by
    their other end, and its value is sent to all of them; there are at most
    ``HOT_SHARE`` such vertices per block. ``degrees`` is ``(src, degree)``.
    """

    edges: DataFrame
    degrees: DataFrame
    hot: DataFrame
    rows: int
    columns: int
    keys: list[int]
    nodes: int = 0
    total: int = 0
    spare: list[str] = field(default_factory=list)

    @staticmethod
    def build(
        edges: DataFrame, partitions: int | None = None, degrees: DataFrame | None = None
    ) -> BlockLayout:
        """``degrees`` may hold ``out_degree(edges)``, stored."""
        spark = edges.sparkSession
        if degrees is None:
            degrees, seen = materialize(out_degree(edges), F.sum("degree").alias("edges"))
        else:
            seen = degrees.agg(F.count(F.lit(1)).alias("rows"), F.sum("degree").alias("edges")).first()
        total = seen["edges"] or 0
        partitions = partitions or partitions_for(spark, total, EDGES_PER_BLOCK)
        rows = isqrt(partitions)
        columns = partitions // rows
        keys = partition_keys(spark, rows * columns)
        limit = max(1, -(-total // (HOT_SHARE * partitions)))
        hot, found = materialize(degrees.where(F.col("degree") > limit).select(F.col("src").alias("hot_id")))
        # At most HOT_SHARE x partitions rows, and broadcast only while that is few.
        hot = F.broadcast(hot) if found["rows"] <= BROADCAST_ROWS else hot
        layout = BlockLayout(edges, degrees, hot, rows, columns, keys, seen["rows"], total)
        ends = (
            edges.where("src is not null and dst is not null")
            .select(*[F.col(c).cast("bigint").alias(c) for c in ("src", "dst")])
            .join(hot.withColumnRenamed("hot_id", "hot_src"), F.col("src") == F.col("hot_src"), "left")
            .join(hot.withColumnRenamed("hot_id", "hot_dst"), F.col("dst") == F.col("hot_dst"), "left")
        )
        row = F.when(F.col("hot_src").isNotNull(), _spread("dst", rows, 1)).otherwise(_spread("src", rows))
        column = F.when(F.col("hot_dst").isNotNull(), _spread("src", columns, 1)).otherwise(
            _spread("dst", columns)
        )
        laid = (
            ends.select(layout._key(row, column).alias("block"), "src", "dst")
            .mapInArrow(_packed, "block bigint, edges binary")
            .repartition(layout.partitions, "block")
            .sortWithinPartitions("block")
            .persist(StorageLevel.MEMORY_AND_DISK_DESER)
        )
        laid.count()  # Plans made from here on see how the rows are partitioned and sorted.
        return replace(layout, edges=laid)

    @property
    def partitions(self) -> int:
        return self.rows * self.columns

    def _key(self, row: Column, column: Column) -> Column:
        keys = F.array(*[F.lit(k).cast("bigint") for k in self.keys])
        return F.get(keys, row * self.columns + column)

    def shipped(self, values: DataFrame) -> DataFrame:
        """``values`` (node, value) once for each block that may have edges from the node."""
        return self._sent(values.select("node", F.col("value").cast("double").alias("value")))

    def _sent(self, rows: DataFrame, strip: range | None = None) -> DataFrame:
        """``rows`` once for each block of the row of the node, or for those of a strip of columns."""
        strip = strip or range(self.columns)
        width = F.lit(self.columns)
        row = _spread("node", self.rows)
        own = F.sequence(row * width + strip.start, row * width + strip.stop - 1)
        every = F.array(*[F.lit(r * self.columns + c) for r in range(self.rows) for c in strip])
        keys = F.array(*[F.lit(k).cast("bigint") for k in self.keys])
        return (
            rows.withColumn("node", F.col("node").cast("bigint"))
            .join(self.hot, F.col("node") == F.col("hot_id"), "left")
            .select(
                F.explode(F.when(F.col("hot_id").isNotNull(), every).otherwise(own)).alias("at"), *rows.columns
            )
            .select(F.get(keys, F.col("at")).alias("block"), *rows.columns)
        )

    def _edges_of(self, strip: range | None) -> DataFrame:
        if strip is None or len(strip) == self.columns:
            return self.edges
        return self.edges.where(F.col("block").isin([self.keys[r * self.columns + c] for r in range(self.rows) for c in strip]))

    def strips(self, rows: int, width: int = _SENT_BYTES) -> list[range]:
        """Strips of columns of the grid, one unless so many rows of so many bytes ship very much.

        A strip is shipped, and its shuffle files go, before the next one is.
        """
        most = max(SHIPPED_LEAST, SHIPPED_PER_EDGE * self.total)
        n = min(self.columns, -(-rows * width * (self.rows + self.columns) // most) or 1)
        ends = [self.columns * i // n for i in range(n + 1)]
        return [range(a, b) for a, b in zip(ends, ends[1:])]

    def steps_at_once(self, rows: int, width: int = _SENT_BYTES) -> int:
        """Steps, one at least, that a plan may chain up before they ship very much."""
        most = max(SHIPPED_LEAST, SHIPPED_PER_EDGE * self.total)
        return max(1, most // max(1, rows * width * (self.rows + self.columns)))

    def _kept(self, part: DataFrame) -> DataFrame:
        kept, _, path = cut(part)
        self.spare.append(path)
        return kept

    def drop_spare(self) -> None:
        """Deletes what a step has stored strip by strip, once its result is stored."""
        while self.spare:
            discard(self.degrees.sparkSession, self.spare.pop())

    def partial_sums(self, values: DataFrame, strip: range | None = None) -> DataFrame:
        """``(node, value)``: per block and target, the sum over its edges of the source's value.

        A source without a value adds nothing.
        """
        sent = self._sent(values.select("node", F.col("value").cast("double").alias("value")), strip)
        return (
            self._edges_of(strip)
            .groupBy("block")
            .cogroup(sent.repartition(self.partitions, "block").groupBy("block"))
            .applyInArrow(_sums_of_block, _VALUES)
        )

    def incoming(self, values: DataFrame, rows: int | None = None) -> DataFrame:
        """``(node, value)``: per vertex the sum of ``values`` over its incoming edges.

        Comes in hash partitions of the node, as many as there are blocks. With the number of
        ``rows`` in ``values`` given, goes strip by strip where that is much.
        """
        strips = self.strips(rows or 0)
        parts = [self.partial_sums(values, strip) for strip in strips]
        if len(parts) > 1:
            parts = [self._kept(self._added(part)) for part in parts]
        return self._added(reduce(DataFrame.unionByName, parts))

    def _added(self, parts: DataFrame) -> DataFrame:
        return parts.repartition(self.partitions, "node").groupBy("node").agg(F.sum("value").alias("value"))

    def gathered(self, rows: DataFrame, columns: list[str], combine: str) -> DataFrame:
        """``(node, batch, *columns)``: per block, target and batch, what its sources' rows combine to.

        ``rows`` has the same columns, one row at most per node and batch; a null counts as 0.
        A task gets as many batches, and of a batch as many columns, as it has memory for. Where
        much is shipped it is done strip by strip, and each stored.
        """
        kind = COMBINED[combine][1]
        cast = [F.col(c).cast(kind).alias(c) for c in columns]
        keyed = rows.where("node is not null").select("node", F.col("batch").cast("int").alias("batch"), *cast)
        width, in_row = 12 + 8 * len(columns), -(-self.nodes // self.rows)
        if self.nodes * width * 16 <= min(GATHERED_BYTES, SHIPPED_LEAST):  # of a few batches
            return self._gathered(keyed, columns, combine)
        seen = keyed.agg(F.count(F.lit(1)).alias("n"), F.sort_array(F.collect_set("batch")).alias("batches")).first()
        lanes = max(1, min(len(columns), (GATHERED_BYTES // in_row - 12) // 8))
        batches = max(1, GATHERED_BYTES // (in_row * (12 + 8 * lanes)))
        shares = [
            (seen["batches"][i : i + batches], columns[j : j + lanes])
            for i in range(0, len(seen["batches"]), batches)
            for j in range(0, len(columns), lanes)
        ]
        parts = []
        for some, names in shares:
            own = keyed if len(shares) == 1 else keyed.where(F.col("batch").isin(some)).select("node", "batch", *names)
            if len(names) < len(columns):
                own = own.where(F.coalesce(*names).isNotNull())
            for strip in self.strips(seen["n"] * len(some) // max(1, len(seen["batches"])), 12 + 8 * len(names)):
                parts.append(self._gathered(own, names, combine, strip))
        if not parts:
            return keyed.where("false")
        if len(parts) > 1:
            parts = [self._kept(part) for part in parts]
        found = reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), parts)
        return found.select("node", "batch", *columns)

    def _gathered(self, keyed: DataFrame, columns: list[str], combine: str, strip: range | None = None) -> DataFrame:
        how, kind = COMBINED[combine]
        sent = self._sent(keyed, strip).repartition(self.partitions, "block")
        schema = ", ".join(["node bigint", "batch int", *[f"{c} {kind}" for c in columns]])
        return (
            self._edges_of(strip)
            .groupBy("block")
            .cogroup(sent.groupBy("block"))
            .applyInArrow(lambda edges, values: _gathered_in_block(edges, values, columns, how), schema)
        )

    def release(self) -> None:
        self.edges.unpersist()
        self.drop_spare()


def _spread(column: str, n: int, seed: int = 0) -> Column:
    return F.pmod(F.xxhash64(column, F.lit(seed)), F.lit(n)).cast("int")


# --- packed edges


@dataclass(frozen=True)
class _Piece:
    """Edges sorted by target: places of their sources in ``srcs``, and where each of ``dsts`` begins."""

    srcs: np.ndarray
    dsts: np.ndarray
    source: np.ndarray
    starts: np.ndarray


def _piece(src: np.ndarray, dst: np.ndarray) -> _Piece:
    srcs, source = np.unique(src, return_inverse=True)
    dsts, target = np.unique(dst, return_inverse=True)
    narrow = np.uint16 if len(dsts) < 1 << 16 else np.uint32
    order = np.argsort(target.astype(narrow), kind="stable")
    starts = np.append(0, np.cumsum(np.bincount(target, minlength=len(dsts))))[:-1]
    return _Piece(srcs, dsts, source[order].astype(np.int32), starts)


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(block, edges)`` from ``(block, src, dst)``: so many edges at a time, those of a block in a few rows."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= EDGES_PACKED:
            yield from _packed_by_block(held)
            held = []
    yield from _packed_by_block(held)
    pa.default_memory_pool().release_unused()


def _packed_by_block(batches: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    block, src, dst = (
        np.concatenate([b.column(c).to_numpy() for b in batches] or [np.zeros(0, np.int64)])
        for c in ("block", "src", "dst")
    )
    blocks, at = np.unique(block, return_inverse=True)
    order = np.argsort(at.astype(np.uint16 if len(blocks) < 1 << 16 else np.uint32), kind="stable")
    ends = np.append(0, np.cumsum(np.bincount(at, minlength=len(blocks))))
    for i, key in enumerate(blocks):
        for begin in range(ends[i], ends[i + 1], EDGES_AT_ONCE):
            own = order[begin : min(begin + EDGES_AT_ONCE, ends[i + 1])]
            edges = pa.array([_as_bytes(_piece(src[own], dst[own]))], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array([key], pa.int64()), edges], ["block", "edges"])


def _as_bytes(piece: _Piece) -> bytes:
    """Ids as gaps, all numbers in as few bytes as the largest needs, the lowest bytes of all first; compressed."""
    n, held = len(piece.source), []
    head = [n, len(piece.srcs), len(piece.dsts), piece.srcs[0], piece.dsts[0]]
    counts = np.diff(piece.starts, append=n)
    for x in (np.diff(piece.srcs), np.diff(piece.dsts), piece.source, counts):
        wide = np.ascontiguousarray(x.astype(np.int64)).view(np.uint64)
        width = (int(wide.max(initial=0)).bit_length() + 7) // 8
        head.append(width)
        held.append(np.ascontiguousarray(wide.view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes())
    raw = b"".join(held)
    head = np.array([*head, len(raw)], np.int64).tobytes()
    return head + pa.compress(raw, codec="zstd", asbytes=True)


def _from_bytes(data: bytes) -> _Piece:
    n, n_srcs, n_dsts, first_src, first_dst, *widths, size = np.frombuffer(data, np.int64, 10).tolist()
    raw = np.frombuffer(pa.decompress(memoryview(data)[80:], decompressed_size=size, codec="zstd"), np.uint8)
    found, at = [], 0
    for count, width in zip((n_srcs - 1, n_dsts - 1, n, n_dsts), widths):
        wide = np.zeros((count, 8), np.uint8)
        wide[:, :width] = raw[at : at + count * width].reshape(width, count).T
        found.append(wide.view(np.int64).reshape(count))
        at += count * width
    srcs, dsts = (np.cumsum(np.append(first, gaps)) for first, gaps in zip((first_src, first_dst), found))
    return _Piece(srcs, dsts, found[2].astype(np.int32), np.cumsum(found[3]) - found[3])


def _pieces_of(edges: pa.Table) -> list[_Piece]:
    """The edges of a block, packed or as ``(src, dst)``."""
    if "edges" in edges.column_names:
        return [_from_bytes(data.as_buffer()) for data in edges["edges"]]
    slices = edges.select(["src", "dst"]).to_batches(max_chunksize=EDGES_AT_ONCE)
    return [_piece(part.column("src").to_numpy(), part.column("dst").to_numpy()) for part in slices if part.num_rows]


# --- sums in a block


def _sums_of_block(edges: pa.Table, values: pa.Table) -> pa.Table:
    """``(node, value)`` of one block, whose edges are taken in slices of ``EDGES_AT_ONCE``."""
    schema = pa.schema([("node", pa.int64()), ("value", pa.float64())])
    if not edges.num_rows or not values.num_rows:
        return schema.empty_table()
    pieces = _pieces_of(edges)
    targets = _targets(pieces)
    sums, met = _combined(pieces, targets, values["node"].to_numpy(), values["value"].to_numpy(), np.add)
    return pa.table([targets[met], sums[met]], schema=schema)


def _gathered_in_block(edges: pa.Table, rows: pa.Table, columns: list[str], how: np.ufunc) -> pa.Table:
    """``(node, batch, *columns)`` of one block, whose edges are taken as in ``_sums_of_block``."""
    kind = np.float64 if how is np.add else np.int64
    schema = pa.schema(
        [("node", pa.int64()), ("batch", pa.int32()), *[(c, pa.from_numpy_dtype(kind)) for c in columns]]
    )
    if not edges.num_rows or not rows.num_rows:
        return schema.empty_table()
    pieces, tables = _pieces_of(edges), []
    targets = _targets(pieces)
    of = rows["batch"].to_numpy()
    for batch in np.unique(of):
        own = np.flatnonzero(of == batch)
        node = rows["node"].to_numpy()[own]
        values = np.empty((len(own), len(columns)), kind)
        for i, c in enumerate(columns):
            values[:, i] = rows[c].fill_null(0).to_numpy()[own]
        found, met = _combined(pieces, targets, node, values, how)
        tables.append(
            pa.table([targets[met], np.full(len(met), batch, np.int32), *[found[met, i] for i in range(len(columns))]], schema=schema)
        )
    return pa.concat_tables(tables)


def _targets(pieces: list[_Piece]) -> np.ndarray:
    """The distinct targets of a block."""
    found = np.zeros(0, np.int64)
    for at in range(0, len(pieces), 16):
        found = np.unique(np.concatenate([found, *[p.dsts for p in pieces[at : at + 16]]]))
    return found


def _combined(
    pieces: list[_Piece], targets: np.ndarray, node: np.ndarray, values: np.ndarray, how: np.ufunc
) -> tuple[np.ndarray, np.ndarray]:
    """What the values of the nodes combine to per target, and the places of targets that got any."""
    order = np.argsort(node)
    node, values = node[order], values[order]
    found, met = np.zeros((len(targets), *values.shape[1:]), values.dtype), np.zeros(len(targets), bool)
    for piece in pieces:
        at = np.minimum(np.searchsorted(node, piece.srcs), len(node) - 1)
        known = node[at] == piece.srcs
        if not known.any():
            continue
        source, starts, place = piece.source, piece.starts, np.searchsorted(targets, piece.dsts)
        if not known.all():
            kept = np.flatnonzero(known[source])
            of = np.searchsorted(starts, kept, "right") - 1
            starts = np.flatnonzero(np.diff(of, prepend=-1))
            source, place = source[kept], place[of[starts]]
        sent = values[at[source]]
        found[place] = how(found[place], _summed(starts, sent) if how is np.add else how.reduceat(sent, starts, axis=0))
        met[place] = True
    return found, np.flatnonzero(met)


def _summed(starts: np.ndarray, values: np.ndarray) -> np.ndarray:
    """The sums of runs of ``values``."""
    return np.add.reduceat(values, starts, axis=0)


@contextmanager
def blocked(edges: DataFrame, layout: BlockLayout | None = None) -> Iterator[BlockLayout]:
    """A layout of ``edges`` that is released at the end, unless ``layout`` is given."""
    laid = layout or BlockLayout.build(edges)
    try:
        yield laid
    finally:
        if layout is None:
            laid.release()
