"""Packing documents into sequences by the sum-of-squares rule.

Sequences are bins of ``capacity`` tokens. The rule looks at how many open bins have
each residual gap, and places a piece where the sum of the squares of those counts
becomes smallest; that keeps all gaps about equally common, so that a later piece
finds one that it fills.
"""

from __future__ import annotations

import json
import os
import zlib
from array import array
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftgraph.llm.common import at_end_of_task, map_rows, stored, utf8

CAPACITY = 2048
BLOCK = 60_000  # pieces packed by one task, about
CHUNKS = 200_000  # tokenised chunks of at most 64 characters that a task remembers

# Fixed value: how byte-level BPE cuts a text before merging.
PATTERN = (
    r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
)

# Texts on which the fast tokenizer must agree with the file's own; another cut or merge order shows.
SAMPLES = (
    "It's 12,345 o'clock -- don't   wait\n\n  for\tus!", "naïve Größe ñandú \u4f60\u597d \U0001f600 _x1 %%% e.g.",
    " leading and trailing \n", "CamelCase snake_case 3.14159 http://a.b/c?d=e&f",
)


class _Irregular(Exception):
    """A chunk that white space or a special token ties to its neighbours."""


class _Chunks(dict):
    """Space-delimited chunk to the token ids (32-bit) of a space and the chunk.

    A token never holds a space but as its first character, so a text with single
    spaces between chunks that neither begin nor end with white space is tokenised
    chunk by chunk. Any other text raises and is tokenised as a whole.
    """

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, chunk: str) -> bytes:
        if not chunk or chunk[0].isspace() or chunk[-1].isspace() or "<|" in chunk:
            raise _Irregular
        ids = self.encode(" " + chunk)
        if len(self) < CHUNKS and len(chunk) < 64:
            self[chunk] = ids
        return ids


def _byte_ranks(path: str) -> dict[bytes, int]:
    """The vocabulary of a byte-level tokenizer file as bytes to id.

    Such files write each byte as one printable character: those that are printable as
    themselves, the rest counted up from 256.
    """
    with open(path, encoding="utf-8") as file:
        vocab = json.load(file)["model"]["vocab"]
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    letters = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}
    return {bytes(letters[c] for c in word): i for word, i in vocab.items() if "<|" not in word}


@cache
def tokenizer(path: str):
    """Text to its token ids as 32-bit little-endian bytes, by the byte-level BPE file at ``path``.

    The ids are those of ``tokenizers`` with ``add_special_tokens=False``. Ordinary text is
    merged by ``tiktoken`` from the same vocabulary, which is several times faster; a text
    that may spell a special token goes to ``tokenizers`` itself.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    import tiktoken
    from tokenizers import Tokenizer

    loaded = Tokenizer.from_file(path)
    plain = tiktoken.Encoding(
        "byte-bpe", pat_str=PATTERN, mergeable_ranks=_byte_ranks(path), special_tokens={}
    )

    def encode(text: str) -> bytes:
        return array("I", plain.encode_ordinary(text)).tobytes()

    for sample in SAMPLES:
        if plain.encode_ordinary(sample) != loaded.encode(sample, add_special_tokens=False).ids:
            raise ValueError(f"{path} is not a byte-level BPE file of the known layout")
    chunks = _Chunks(encode)
    at_end_of_task(chunks.clear)

    def ids(text: str) -> bytes:
        first, *rest = text.split(" ")
        try:
            if not first or first[-1].isspace() or "<|" in first:
                raise _Irregular
            return encode(first) + b"".join(map(chunks.__getitem__, rest))
        except _Irregular:
            if "<|" in text:
                found = loaded.encode(text, add_special_tokens=False).ids
                return array("I", found).tobytes()
            return encode(text)

    return ids


def pieces(
    docs: DataFrame,
    tokenizer_path: str,
    capacity: int = CAPACITY,
    end_id: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """``(id, row, piece, start, length, ids_crc32[, ids])`` per piece of a document.

    A document is its tokens and ``end_id``. One that is longer than ``capacity`` is cut
    into full pieces; only its first piece may be shorter. ``row`` tells rows of one id
    apart. A null text is an empty one and makes a piece of one token.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    end = np.array([end_id], "<u4").tobytes()

    def cut(batch: dict) -> list[tuple]:
        encode = tokenizer(tokenizer_path)
        out = []
        for i, row, text in zip(batch["id"], batch["row"], batch["text"]):
            ids = encode(text.decode("utf-8", "replace")) + end
            size = len(ids) // 4
            start, number = 0, 0
            while start < size:
                stop = start + ((size - start) % capacity or capacity)
                part = ids[4 * start : 4 * stop]
                made = (i, row, number, start, stop - start, zlib.crc32(part))
                out.append((*made, part) if with_ids else made)
                start, number = stop, number + 1
        return out

    schema = f"id {id_type}, row long, piece int, start long, length long, ids_crc32 long"
    rows = docs.select(
        F.col(id_col).alias("id"),
        F.monotonically_increasing_id().alias("row"),
        utf8(text_col).alias("text"),
    )
    return map_rows(rows, cut, schema + (", ids binary" if with_ids else ""))


def sum_of_squares(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin number and offset of each size, in the order given.

    Placing size s into a bin of gap g turns one bin of gap g into one of gap g - s, so
    the sum of squares changes by 2 (n[g-s] - n[g]) + 2. A new bin counts as gap
    ``capacity``, of which none is open. Full bins do not count. Ties go to the
    smallest gap.
    """
    counts = np.zeros(capacity + 1, np.int64)
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    bins = np.empty(len(sizes), np.int64)
    offsets = np.empty(len(sizes), np.int64)
    never = np.int64(1) << 60
    made = 0
    for i, size in enumerate(sizes.tolist()):
        before = counts[size:]
        change = 2 * (counts[: capacity + 1 - size] - before) + 2
        change[before == 0] = never
        if before[0]:
            change[0] = 1 - 2 * before[0]  # a bin that is filled leaves no gap
        change[-1] = 2 * counts[capacity - size] + 1
        gap = size + int(np.argmin(change))
        if gap < capacity:
            number = stacks[gap].pop()
            counts[gap] -= 1
        else:
            number = made
            made += 1
        bins[i], offsets[i] = number, capacity - gap
        if gap > size:
            stacks[gap - size].append(number)
            counts[gap - size] += 1
    return bins, offsets


def _packed(rows: pd.DataFrame, capacity: int) -> pd.DataFrame:
    """Places the rows of one block, longest first; equal rows in the order of their keys."""
    rows = rows.sort_values(["length", "row", "piece"], ascending=[False, True, True])
    bins, offsets = sum_of_squares(rows["length"].to_numpy(), capacity)
    return rows.assign(bin=bins, offset=offsets)


def pack(parts: DataFrame, capacity: int = CAPACITY, block: int = BLOCK) -> DataFrame:
    """``parts`` (stored, from ``pieces``) with ``sequence_id`` and ``offset``.

    Pieces are dealt to blocks of about ``block`` rows by a hash of their row, so no task
    holds more, whatever the lengths are. Bins that a block leaves with a gap are dealt
    to fewer blocks and packed again as pieces of their own; the second round joins
    what the blocks could not fill alone.
    """

    def packed(rows: DataFrame, name: str) -> DataFrame:
        rows = stored(rows, f"{name}-in")
        blocks = max(1, -(-rows.count() // block))
        return stored(
            rows.withColumn("block", F.pmod(F.xxhash64("row", "piece"), F.lit(blocks)))
            .groupBy("block")
            .applyInPandas(
                lambda one: _packed(one, capacity),
                "row long, piece long, length long, block long, bin long, offset long",
            ),
            name,
        )

    first = packed(parts.select("row", F.col("piece").cast("long"), "length"), "packed")
    bins = first.groupBy("block", "bin").agg(F.sum("length").alias("length"))
    gaps = bins.where(F.col("length") < capacity)
    again = packed(gaps.select(F.col("block").alias("row"), F.col("bin").alias("piece"), "length"), "repacked")
    moved = again.select(
        F.col("row").alias("block"),
        F.col("piece").alias("bin"),
        (F.lit(1 << 62) + F.shiftleft("block", 32) + F.col("bin")).alias("joined"),
        F.col("offset").alias("base"),
    )
    own = F.shiftleft("block", 32) + F.col("bin")
    placed = first.join(moved, ["block", "bin"], "left").select(
        "row",
        F.col("piece").cast("int"),
        F.coalesce("joined", own).alias("sequence_id"),
        (F.col("offset") + F.coalesce("base", F.lit(0))).alias("offset"),
    )
    return parts.join(placed, ["row", "piece"])


def filled(placed: DataFrame) -> DataFrame:
    """``(sequence_id, n_tokens, ids)``: the token ids of each packed sequence of ``pieces`` with ids."""
    in_order = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return (
        placed.groupBy("sequence_id")
        .agg(F.sum("length").alias("n_tokens"), in_order.alias("parts"))
        .select(
            "sequence_id",
            "n_tokens",
            F.aggregate(
                "parts", F.lit(b""), lambda whole, part: F.concat(whole, part["ids"])
            ).alias("ids"),
        )
    )
