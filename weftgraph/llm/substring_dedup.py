"""Removal of lines and passages that other documents, or the same one, have had before.

Texts are cut into units, which are normalised (ASCII lower case, white space collapsed) and
hashed. The first kind of unit is a line, so a paragraph goes line by line, with exact
borders. A passage inside longer lines is seen by units of the second kind, whose
borders depend on the words around them only: the same passage is cut in the same places
wherever it stands. Digests are grouped globally, the earliest ranked occurrence stays, and
all later ones are removed with their offsets in the original text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import ArrayType, StructType

from weftgraph.llm.collocations import BITS, mark, marked, put_together
from weftgraph.llm.common import (
    at_end_of_task,
    fresh,
    in_batches,
    map_rows,
    mixed,
    slices,
    stored,
    utf8,
    word_hashes,
)

LINE_WORDS = 5  # shorter lines stay, as headings and list marks repeat by right
WINDOW = 12  # a border inside lines falls in any so many neighbouring words
MIN_WORDS = 20  # shorter runs of units inside lines stay

_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True


_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """The first ``n`` powers of ``base``; they are kept up to the longest text of a task."""
    held = _POWERS.get(base)
    if held is None or len(held) < n:
        at_end_of_task(_POWERS.clear)
        factors = np.full(max(n, 4_096), base, np.uint64)
        factors[0] = 1
        held = _POWERS[base] = np.cumprod(factors, dtype=np.uint64)
    return held[:n]


class _Sums:
    """128-bit digests of word ranges of one text, from two independent hashes per word."""

    def __init__(self, words: list[bytes]):
        n = len(words)
        self.hashes = [word_hashes(words, seed) for seed in range(2)]
        self.sums = [
            np.concatenate([np.zeros(1, np.uint64), np.cumsum(h * _powers(base, n), dtype=np.uint64)])
            for h, base in zip(self.hashes, _BASES)
        ]
        self.back = [_powers(pow(base, -1, 1 << 64), n + 1) for base in _BASES]

    def digests(self, first: np.ndarray, end: np.ndarray, kind: int) -> list[np.ndarray]:
        length = (end - first).astype(np.uint64) * np.uint64(2) + np.uint64(kind)
        return [
            mixed((sums[end] - sums[first]) * back[first] + length).view(np.int64)
            for sums, back in zip(self.sums, self.back)
        ]


def _sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) over every ``width`` neighbours, by doubling."""
    done = 1
    while done < width:
        step = min(done, width - done)
        values = pick(values[:-step], values[step:])
        done += step
    return values


def borders(hashes: np.ndarray, window: int) -> np.ndarray:
    """Word numbers at which a text is cut: its ends and, of every ``window`` neighbouring
    word pairs, the one with the smallest hash."""
    n = len(hashes)
    if n <= window:
        return np.array([0, n] if n else [0])
    pairs = mixed(hashes[:-1] * np.uint64(3) + hashes[1:])
    width = min(window, len(pairs))
    least = _sliding(pairs, width, np.minimum)
    pad = np.zeros(width - 1, np.uint64)
    reached = _sliding(np.concatenate([pad, least, pad]), width, np.maximum)
    inner = np.flatnonzero(pairs == reached)
    return np.concatenate([[0], inner[inner > 0], [n]])


def units(text: bytes, line_words: int = LINE_WORDS, window: int = WINDOW) -> dict[str, np.ndarray]:
    """The units of a text: ``start`` and ``stop`` in characters, ``first`` and ``last`` in words,
    ``d1`` and ``d2``, and ``line`` (1 for a line, 0 for a unit inside lines).

    A line reaches up to the next line's start, a unit inside lines up to the next word's. Inner
    units reach over two gaps between borders and overlap by one, so a unit is specific and
    none is lost at a seam.
    """
    raw = np.frombuffer(text, np.uint8)
    space = np.concatenate([[True], _SPACE[raw], [True]])
    starts = np.flatnonzero(space[:-1] & ~space[1:])
    words = text.lower().split()
    n = len(words)
    if text.isascii():
        chars = np.arange(len(raw) + 1)
    else:
        chars = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
    at = np.append(chars[starts], chars[-1])
    sums = _Sums(words)
    # Lines: words between line breaks, and the text from the line's start to the next one's.
    begin = np.concatenate([[0], np.flatnonzero(raw == 10) + 1, [len(raw)]])
    word = np.searchsorted(starts, begin)
    long = np.diff(word) >= line_words
    first, last = word[:-1][long], word[1:][long]
    parts = [(chars[begin[:-1][long]], chars[begin[1:][long]], first, last, 1)]
    cut = borders(sums.hashes[0], window)
    first, last = (cut[:-1], cut[1:]) if len(cut) <= 2 else (cut[:-2], cut[2:])
    parts.append((at[first] if n else first[:0], at[last] if n else last[:0], first[:n], last[:n], 0))
    found = []
    for start, stop, first, last, kind in parts:
        d1, d2 = sums.digests(first, last, kind)
        found.append((start, stop, first, last, d1, d2, np.full(len(first), kind)))
    names = ("start", "stop", "first", "last", "d1", "d2", "line")
    return {name: np.concatenate(column) for name, column in zip(names, zip(*found))}


_UNIT = ("start int, stop int, first int, last int, d1 long, d2 long, line int")


def _cut_up(rows: DataFrame, line_words: int, window: int) -> DataFrame:
    """``(id, row, units)`` of ``rows`` (id, row, text)."""
    id_type = rows.schema["id"].dataType
    kind = to_arrow_type(id_type)
    struct = [(c.split()[0], pa.int64() if "long" in c else pa.int32()) for c in _UNIT.split(", ")]

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                found = [units(text.as_py(), line_words, window) for text in part.column(2)]
                offsets = np.cumsum([0, *(len(u["start"]) for u in found)]).astype(np.int32)
                flat = [
                    pa.array(np.concatenate([u[name] for u in found])).cast(t) for name, t in struct
                ]
                held = pa.StructArray.from_arrays(flat, names=[name for name, _ in struct])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).cast(kind), part.column(1), pa.ListArray.from_arrays(pa.array(offsets), held)],
                    ["id", "row", "units"],
                )

    fields = ", ".join(": ".join(c.split()) for c in _UNIT.split(", "))
    return in_batches(
        rows.select("id", "row", "text"), run,
        f"id {id_type.simpleString()}, row long, units array<struct<{fields}>>",
    )


def _perhaps_in(units_of: DataFrame, repeated: DataFrame) -> DataFrame:
    """``units_of`` with those units only whose digest may be in ``repeated``.

    A bitmap of fixed size tells; most units are unlike any other and need not be shuffled again
    to find that out. What it lets through is joined exactly.
    """

    def placed(batches):
        cells = np.zeros(1 << (BITS - 6), np.uint64)
        for batch in batches:
            mark(cells, batch.column(0).to_numpy().view(np.uint64))
        yield from marked(cells)

    known = put_together(repeated.select("d1").mapInArrow(placed, "cell long, bits long"))
    at = units_of.schema.names.index("units")

    def narrowed(batches):
        for batch in batches:
            for part in slices(batch):
                held = part.column(at)
                flat = held.flatten()
                use = known.has(flat.field("d1").to_numpy(zero_copy_only=False).view(np.uint64))
                sizes = np.diff(held.offsets.to_numpy())
                text = np.repeat(np.arange(len(sizes)), sizes)[use]
                ends = np.append(0, np.cumsum(np.bincount(text, minlength=len(sizes)))).astype(np.int32)
                kept = pa.ListArray.from_arrays(pa.array(ends), flat.filter(pa.array(use)))
                columns = [kept if i == at else c for i, c in enumerate(part.columns)]
                yield pa.RecordBatch.from_arrays(columns, part.schema.names)

    return in_batches(units_of, narrowed, units_of.schema)


def _repeated(units_of: DataFrame, min_words: int) -> DataFrame:
    """``(id, row, spans, origins, n_words)`` of documents with something to remove.

    Later occurrences of a unit are marked and marks that touch joined. A joined span is
    removed if it has a line in it or is long enough.
    """
    each = units_of.select("id", "row", F.inline("units"))
    place = F.struct(F.col("id").isNull().alias("nameless"), "id", "row", "start")
    earliest = stored(
        each.groupBy("d1", "d2")
        .agg(F.min(place).alias("origin"), F.count(F.lit(1)).alias("n"))
        .where("n > 1 and not origin.nameless")
        .drop("n"),
        "earliest",
    )
    marks = (
        _perhaps_in(units_of, earliest)
        .select("id", "row", F.inline("units"))
        .join(earliest, ["d1", "d2"])
        .where(~(place.eqNullSafe(F.col("origin"))))
        .select("id", "row", "start", "stop", "first", "last", "line", F.col("origin.id").alias("origin"))
    )
    text = Window.partitionBy("id", "row").orderBy("start", "stop")
    before = F.max("stop").over(text.rowsBetween(Window.unboundedPreceding, -1))
    apart = F.when(F.col("start") <= before, 0).otherwise(1)
    spans = (
        marks.withColumn("apart", apart)
        .withColumn("span", F.sum("apart").over(text.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy("id", "row", "span")
        .agg(
            F.min("start").alias("start"), F.max("stop").alias("stop"), F.max("line").alias("line"),
            (F.max("last") - F.min("first")).alias("words"), F.collect_set("origin").alias("origins"),
        )
        .where((F.col("line") == 1) | (F.col("words") >= min_words))
    )
    return spans.groupBy("id", "row").agg(
        F.sort_array(
            F.collect_list(
                F.struct(
                    F.col("start").cast("long").alias("start"),
                    (F.col("stop") - F.col("start")).cast("long").alias("length"),
                )
            )
        ).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("origins")))).alias("origins"),
        F.sum("words").cast("long").alias("n_words"),
    )


def remove_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    line_words: int = LINE_WORDS,
    window: int = WINDOW,
    min_words: int = MIN_WORDS,
) -> DataFrame:
    """``docs`` without repeated lines and passages, and ``removed``, ``removed_words``, ``repeats_of``.

    The earliest occurrence is that in the document of the lowest id, and within a document
    the first. ``removed`` holds start and length of each removed span in characters of the
    original text, in order; ``repeats_of`` the ids of the documents that had it first. Every
    repeated line of ``line_words`` words or more goes as a whole, with its line break.
    Inside lines, and across lines that are broken differently, any passage of
    2 * ``window`` + ``min_words`` words or more is found; up to ``window`` words at either end of
    it may stay, as their unit reaches into the surroundings. Shorter lines and runs stay.

    A null text stays null, an empty one empty; both have nothing removed. What only rows with
    null ids have stays, as they rank last and not among each other. Rows of one id with
    different texts are ranked by a hash of the text; rows equal in id and text are
    one document and lose the same. Columns of ``docs`` named ``removed``, ``removed_words``
    or ``repeats_of`` are replaced. Equality is that of 128-bit digests.
    """
    out = docs.drop("removed", "removed_words", "repeats_of")
    names = out.columns
    row_key, spans, origins, later_id, later_row, n_words = fresh(
        out, "row_key", "spans", "origins", "later_id", "later_row", "n_words"
    )
    spread = out.withColumn(row_key, F.xxhash64(F.col(id_col), F.col(text_col)))
    id_type = docs.schema[id_col].dataType
    pieces = stored(
        _cut_up(
            spread.select(
                F.col(id_col).alias("id"), F.col(row_key).alias("row"), utf8(text_col).alias("text")
            ),
            line_words,
            window,
        ),
        "units",
    )
    later = _repeated(pieces, min_words).select(
        F.col("id").alias(later_id), F.col("row").alias(later_row), F.col("spans").alias(spans),
        F.col("origins").alias(origins), F.col("n_words").alias(n_words),
    )

    def cut(batch: dict) -> list[tuple]:
        rows = []
        for k, (found, text) in enumerate(zip(batch[spans], batch[text_col])):
            row = {n: batch[n][k] for n in names}
            if found:
                kept, at = [], 0
                for span in found:
                    kept.append(text[at : span["start"]])
                    at = span["start"] + span["length"]
                row[text_col] = "".join([*kept, text[at:]])
            rows.append((*row.values(), found or [], batch[n_words][k] or 0, batch[origins][k] or []))
        return rows

    more = StructType.fromDDL(
        "removed array<struct<start: long, length: long>>, removed_words long"
    ).add("repeats_of", ArrayType(id_type))
    same = (F.col(row_key) == F.col(later_row)) & F.col(id_col).eqNullSafe(F.col(later_id))
    return map_rows(
        spread.join(later, same, "left").select(*names, spans, origins, n_words),
        cut,
        StructType(out.schema.fields + more.fields),
    )
