"""Exact top-k inner products with a vector-approximation file.

Vectors of integers are approximated by one byte per component, the number of its cell.
A scan of the cells gives for each query and vector a lower and an upper bound of the
score. Only vectors whose upper bound reaches the k-th best lower bound are candidates,
and exact vectors are read for them alone, in order of the bound and in two waves: once
the first wave has fixed a k-th score, the second reads only what could still beat it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftgraph.llm.common import stored

CELLS = 256
QUERY_BLOCK = 4_096
VECTOR_BLOCK = 1_024
STEP = 256  # queries scored at a time within a block


def integer_vectors(
    vectors: DataFrame, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """``(id, v)`` with floor(scale * x) per component, x as double.

    Vectors that are null or hold a null or non-finite component take no part, nor do null
    ids. An empty vector takes part as zeros, and every row does, also those that share an
    id. A component or score beyond 64 bits raises Spark's overflow error.
    """
    x = F.col(vector_col).cast("array<double>")
    usable = F.forall(
        x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))
    )
    return (
        vectors.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull())
        .where(usable)
        .select(
            F.col(id_col).alias("id"),
            F.transform(x, lambda c: F.floor(c * scale)).alias("v"),
        )
    )


def _cell_bounds(vectors: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Lowest value and cell width per component; shorter vectors count as filled with zeros."""
    rows = (
        vectors.select(F.posexplode("v").alias("at", "x"))
        .groupBy("at")
        .agg(F.min("x").alias("low"), F.max("x").alias("high"))
        .orderBy("at")
        .collect()
    )
    low = np.array([min(0, r["low"]) for r in rows], np.int64)
    high = np.array([max(0, r["high"]) for r in rows], np.int64)
    return low, -(-(high - low + 1) // CELLS)


def _padded(vectors, dims: int) -> np.ndarray:
    out = np.zeros((len(vectors), dims), np.int64)
    for row, v in zip(out, vectors):
        row[: len(v)] = v
    return out


def _cells(vectors: DataFrame, low: np.ndarray, width: np.ndarray) -> DataFrame:
    """``(row, cells)``: the approximation file, a byte per component."""

    def packed(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            cells = ((_padded(part["v"], len(low)) - low) // width).astype(np.uint8)
            yield pd.DataFrame({"row": part["row"], "cells": [c.tobytes() for c in cells]})

    return vectors.mapInPandas(packed, "row long, cells binary")


def _scan(
    queries: pd.DataFrame, cells: pd.DataFrame, low: np.ndarray, width: np.ndarray, k: int
) -> pd.DataFrame:
    """Candidates of one block of queries in one block of cells, with their bounds.

    A vector lies between the low corner of its cells and the high one, ``width - 1`` above.
    So the score of the low corner is off by at most the sum of the query's positive (up)
    or negative (down) components times that. ``slack`` covers the rounding of floats.
    """
    ids = cells["row"].to_numpy()
    corners = np.frombuffer(b"".join(cells["cells"]), np.uint8).reshape(len(cells), len(low))
    corners = (corners * width + low).astype(float)
    most = np.abs(corners).max(initial=0)
    found = []
    for start in range(0, len(queries), STEP):
        part = queries.iloc[start : start + STEP]
        q = _padded(part["v"], len(low)).astype(float)
        own = part["row"].to_numpy()
        score = q @ corners.T
        slack = np.floor(np.abs(q).sum(1) * most * 2.0**-49)
        down = np.minimum(q, 0) @ (width - 1) - slack
        up = np.maximum(q, 0) @ (width - 1) + slack
        score[own[:, None] == ids[None, :]] = -np.inf
        if len(ids) > k:
            kth = np.partition(score, len(ids) - k, axis=1)[:, len(ids) - k]
        else:
            kth = np.full(len(part), -np.inf)
        rows, columns = np.nonzero(
            np.isfinite(score) & (score + up[:, None] >= (kth + down)[:, None])
        )
        found.append(
            pd.DataFrame(
                {
                    "query": own[rows],
                    "row": ids[columns],
                    "lower": (score[rows, columns] + down[rows]).astype(np.int64),
                    "upper": (score[rows, columns] + up[rows]).astype(np.int64),
                }
            )
        )
    return pd.concat(found, ignore_index=True)


def _blocks(n: int, size: int) -> int:
    return max(1, -(-n // size))


def _candidates(
    queries: DataFrame, cells: DataFrame, low: np.ndarray, width: np.ndarray, k: int
) -> DataFrame:
    """Candidates of all queries, block by block.

    Both sides are dealt to blocks of bounded size; a task sees one block of queries and one
    of cells. Every block of queries meets every block of cells, as exact search needs.
    """
    q_blocks = _blocks(queries.count(), QUERY_BLOCK)
    c_blocks = _blocks(cells.count(), VECTOR_BLOCK)
    key = F.xxhash64("row")
    q = queries.withColumn("qb", F.pmod(key, F.lit(q_blocks)).cast("int")).withColumn(
        "cb", F.explode(F.sequence(F.lit(0), F.lit(c_blocks - 1)))
    )
    c = cells.withColumn("cb", F.pmod(key, F.lit(c_blocks)).cast("int")).withColumn(
        "qb", F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1)))
    )
    schema = "query long, row long, lower long, upper long"

    def scan(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame({n: [] for n in ("query", "row", "lower", "upper")})
        return _scan(left, right, low, width, k)

    return q.groupBy("qb", "cb").cogroup(c.groupBy("qb", "cb")).applyInPandas(scan, schema)


def _top(rows: DataFrame, k: int, *order: Column) -> DataFrame:
    place = F.row_number().over(Window.partitionBy("query").orderBy(*order))
    return rows.withColumn("rank", place).where(F.col("rank") <= k)


def _exact(pairs: DataFrame, queries: DataFrame, vectors: DataFrame) -> DataFrame:
    """``(query, query_id, row, id, score)`` from the exact vectors of the pairs."""
    product = F.aggregate(
        F.zip_with("q", "v", lambda a, b: F.coalesce(a * b, F.lit(0).cast("long"))),
        F.lit(0).cast("long"),
        lambda total, x: total + x,
    )
    asked = queries.select(
        F.col("row").alias("query"), F.col("id").alias("query_id"), F.col("v").alias("q")
    )
    return (
        pairs.join(vectors, "row")
        .join(asked, "query")
        .select("query", "query_id", "row", "id", product.alias("score"))
    )


def top_k(vectors: DataFrame, is_query: Column | str, k: int = 5) -> DataFrame:
    """``(query_id, rank, id, score)``: the ``k`` highest inner products of each query.

    ``vectors`` is ``(id, v)`` as ``integer_vectors`` gives them; ``is_query`` is a condition
    on ``id``. Every row is a vector of its own: a query row does not meet itself, but other
    rows of its id, and query rows that share an id have a list each. Ties go to the smaller
    id; with fewer other vectors than ``k`` all are returned. Vectors of different lengths
    meet as if the shorter were filled with zeros.

    Equal vectors tie in every score, so the cells hold the ``k + 1`` lowest ids of each
    distinct vector only: no other copy can be among the ``k`` best of any query, itself
    left out.
    """
    # Rows are numbered as they are stored, so the numbers stay the same.
    vectors = stored(vectors, "vectors").withColumn("row", F.monotonically_increasing_id())
    vectors = stored(vectors, "numbered")
    queries = stored(vectors.where(is_query), "queries")
    if queries.isEmpty():
        return vectors.select(
            F.col("id").alias("query_id"), F.lit(0).alias("rank"), "id", F.lit(0).cast("long").alias("score")
        ).limit(0)
    low, width = _cell_bounds(vectors)
    copy = F.row_number().over(Window.partitionBy("v").orderBy("id", "row"))
    distinct = stored(
        vectors.withColumn("copy", copy).where(F.col("copy") <= k + 1).drop("copy"), "distinct"
    )
    cells = stored(_cells(distinct.select("row", "v"), low, width), "cells")
    asked = queries.select("row", "v")
    found = stored(_candidates(asked, cells, low, width, k), "candidates")
    # The k-th best lower bound over all blocks: what is bounded below it is out.
    floor = (
        _top(found, k, F.desc("lower"), F.asc("row"))
        .groupBy("query")
        .agg(F.min("lower").alias("floor"), F.count(F.lit(1)).alias("n"))
        .select("query", F.when(F.col("n") >= k, F.col("floor")).alias("floor"))
    )
    left = stored(
        found.join(floor, "query").where("floor is null or upper >= floor"), "survivors"
    )
    best = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("upper"), F.asc("row")))
    ordered = stored(left.withColumn("place", best), "ordered")
    first = stored(_exact(ordered.where(F.col("place") <= 2 * k), queries, distinct), "first-wave")
    in_order = [F.desc("score"), F.asc("id"), F.asc("row")]
    certain = (
        _top(first, k, *in_order)
        .groupBy("query")
        .agg(F.min("score").alias("kth"), F.count(F.lit(1)).alias("n"))
        .select("query", F.when(F.col("n") >= k, F.col("kth")).alias("kth"))
    )
    more = (
        ordered.where(F.col("place") > 2 * k)
        .join(certain, "query")
        .where("kth is null or upper >= kth")
    )
    second = _exact(more, queries, distinct)
    return _top(first.unionByName(second), k, *in_order).select("query_id", "rank", "id", "score")
