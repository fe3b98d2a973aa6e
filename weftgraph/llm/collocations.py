"""Phrases whose words belong together, found best first.

A phrase grows from its first words. What its prefix is counted bounds its score: no
extension can be more frequent than the prefix, so a branch whose bound is below the scores
still wanted need not be grown. Word pairs are the branches. The best of a language by bound are
opened together, all longer phrases that contain an open pair are counted in one pass over
the texts, and the frontier moves on until enough phrases survive with a score that no
unopened branch can reach, ties included.

Pairs and longer phrases are counted only where all their parts are frequent. Tasks know that
from bitmaps of fixed size, which may let some more through; exact counts decide afterwards.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from weftgraph.llm.common import mixed, stored, utf8

WORDS = 4  # of the longest phrase
BITS = 25  # the bitmap of a filter has 2^BITS bits
BLOCK = 1_000_000  # words counted in memory before their counts are passed on
FIRST = 8_000  # branches per language in the first round
GROWTH = 8  # and so many times more in each later one

# What ends a piece of text; A-Z are lower-cased.
_ENDS = b".,;:!?\n\x0b\x0c\r"
_TEXT = bytes(46 if c in _ENDS else c + 32 if 65 <= c <= 90 else c for c in range(256))

_COUNT = pa.schema([("lang", pa.string()), ("size", pa.int32()), ("phrase", pa.string()), ("n", pa.int64())])
_COUNT_DDL = "lang string, size int, phrase string, n long"


def tokens_of(text: bytes) -> list[bytes]:
    """The words of a text, with ``.`` between pieces; no word contains one."""
    return text.translate(_TEXT).replace(b".", b" . ").split()


class _Numbers(dict):
    """Numbers for the words of one language, given out from a list that all share."""

    def __init__(self, lang: str, words: list[bytes], langs: list[str]):
        self.lang, self.words, self.langs = lang, words, langs
        self[b"."] = 0

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self.words)
        self.words.append(word)
        self.langs.append(self.lang)
        return number


class Filter:
    """A set of hashes as a bitmap; knows every member and a few others."""

    def __init__(self, cells: np.ndarray):
        self.cells = cells

    def has(self, hashes: np.ndarray) -> np.ndarray:
        found = np.ones(len(hashes), bool)
        for at in _positions(hashes):
            found &= (self.cells[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1
        return found


def _positions(hashes: np.ndarray) -> list[np.ndarray]:
    mask = np.uint64((1 << BITS) - 1)
    return [(hashes & mask).astype(np.int64), ((hashes >> np.uint64(32)) & mask).astype(np.int64)]


def _word_hash(lang: str, word: bytes) -> int:
    return xxh64_intdigest(lang.encode() + b"\x00" + word)


def _pair_hashes(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return mixed(first * np.uint64(3) + mixed(second))


def _filter(phrases: DataFrame) -> Filter:
    """The bitmap of stored ``(lang, phrase)`` of one or two words.

    Tasks and an aggregation put it together; the driver gets 2^BITS bits at any size.
    """

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(1 << (BITS - 6), np.uint64)
        for batch in batches:
            hashes = []
            for lang, phrase in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                parts = np.array([_word_hash(lang, w) for w in phrase.encode().split(b" ")], np.uint64)
                hashes.append(parts[0] if len(parts) == 1 else _pair_hashes(parts[:1], parts[1:])[0])
            mark(cells, np.array(hashes, np.uint64))
        yield from marked(cells)

    return put_together(phrases.select("lang", "phrase").mapInArrow(placed, "cell long, bits long"))


def mark(cells: np.ndarray, hashes: np.ndarray) -> None:
    """Puts hashes into the bitmap of a task."""
    for at in _positions(hashes):
        np.bitwise_or.at(cells, at >> 6, np.uint64(1) << (at & 63).astype(np.uint64))


def marked(cells: np.ndarray) -> Iterator[pa.RecordBatch]:
    used = np.flatnonzero(cells)
    if len(used):
        yield pa.RecordBatch.from_arrays(
            [pa.array(used), pa.array(cells[used].view(np.int64))], ["cell", "bits"]
        )


def put_together(parts: DataFrame) -> Filter:
    """The filter from the ``(cell, bits)`` of all tasks."""
    found = parts.groupBy("cell").agg(F.bit_or("bits").alias("bits")).toArrow()
    cells = np.zeros(1 << (BITS - 6), np.uint64)
    cells[found["cell"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    return Filter(cells)


class _Block:
    """Words of some texts as numbers, with what is needed to name and hash them."""

    def __init__(self):
        self.words: list[bytes] = [b"."]
        self.langs: list[str] = [""]
        self.numbers: dict[str, _Numbers] = {}
        self.parts: list[np.ndarray] = []
        self.size = 0

    def add(self, lang: str, tokens: list[bytes]) -> None:
        known = self.numbers.get(lang)
        if known is None:
            known = self.numbers[lang] = _Numbers(lang, self.words, self.langs)
        ids = np.fromiter(map(known.__getitem__, tokens), np.int64, len(tokens))
        self.parts += [ids, np.zeros(1, np.int64)]
        self.size += len(ids) + 1

    def ids(self) -> np.ndarray:
        return np.concatenate(self.parts) if self.parts else np.empty(0, np.int64)

    def hashes(self) -> np.ndarray:
        return np.fromiter(map(_word_hash, self.langs, self.words), np.uint64, len(self.words))

    def counted(self, size: int, columns: list[np.ndarray], n: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Rows for phrases given as one column of word numbers per word."""
        words = pa.array(self.words, pa.binary()).cast(pa.string())
        langs = pa.array(self.langs, pa.string())
        for at in range(0, len(n), 50_000):
            taken = [words.take(pa.array(c[at : at + 50_000])) for c in columns]
            phrase = taken[0] if size == 1 else pc.binary_join_element_wise(*taken, " ")
            rows = len(taken[0])
            yield pa.RecordBatch.from_arrays(
                [langs.take(pa.array(columns[0][at : at + 50_000])), pa.array(np.full(rows, size, np.int32)),
                 phrase, pa.array(n[at : at + 50_000])],
                schema=_COUNT,
            )


def _words(block: _Block) -> Iterator[pa.RecordBatch]:
    n = np.bincount(block.ids(), minlength=len(block.words))
    used = np.flatnonzero(n[1:]) + 1
    yield from block.counted(1, [used], n[used].astype(np.int64))


def _pairs(block: _Block, frequent: Filter) -> Iterator[pa.RecordBatch]:
    ids = block.ids()
    good = frequent.has(block.hashes())
    good[0] = False
    both = good[ids[:-1]] & good[ids[1:]]
    keys, n = np.unique((ids[:-1][both] << 32) | ids[1:][both], return_counts=True)
    yield from block.counted(2, [keys >> 32, keys & 0xFFFFFFFF], n)


def _longer(block: _Block, frequent: Filter, opened: Filter) -> Iterator[pa.RecordBatch]:
    """Phrases of 3 and 4 words whose pairs are all frequent and of which one is open."""
    ids = block.ids()
    if len(ids) < 3:
        return
    keys, at = np.unique((ids[:-1] << 32) | ids[1:], return_inverse=True)
    hashes = block.hashes()
    pairs = _pair_hashes(hashes[keys >> 32], hashes[keys & 0xFFFFFFFF])
    inside = (keys >> 32 != 0) & (keys & 0xFFFFFFFF != 0)
    good = inside & frequent.has(pairs)
    wanted = (good & opened.has(pairs))[at]
    good = good[at]
    three = good[:-1] & good[1:] & (wanted[:-1] | wanted[1:])
    found, n = np.unique((at[:-1][three] << 32) | ids[2:][three], return_counts=True)
    first = keys[found >> 32]
    yield from block.counted(3, [first >> 32, first & 0xFFFFFFFF, found & 0xFFFFFFFF], n)
    four = good[:-2] & good[1:-1] & good[2:] & (wanted[:-2] | wanted[1:-1] | wanted[2:])
    found, n = np.unique((at[:-2][four] << 32) | at[2:][four], return_counts=True)
    first, last = keys[found >> 32], keys[found & 0xFFFFFFFF]
    yield from block.counted(
        4, [first >> 32, first & 0xFFFFFFFF, last >> 32, last & 0xFFFFFFFF], n
    )


def _counted(docs: DataFrame, per_block, least: int, block_words: int, *filters: Filter) -> DataFrame:
    """``(lang, size, phrase, n)`` over all texts, of phrases with at least ``least`` places."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = _Block()
        for batch in batches:
            lang, text = batch.column(0), batch.column(1)
            for i in range(batch.num_rows):
                block.add(lang[i].as_py(), tokens_of(text[i].as_py()))
                if block.size >= block_words:
                    yield from per_block(block, *filters)
                    block = _Block()
        yield from per_block(block, *filters)

    return (
        docs.mapInArrow(run, _COUNT_DDL)
        .groupBy("lang", "size", "phrase")
        .agg(F.sum("n").alias("n"))
        .where(F.col("n") >= least)
    )


_SHARE = "cast((2000000 * cast({a} as decimal(20,0))) div cast({l} + {r} as decimal(20,0)) as long)"


def _branches(pairs: DataFrame, words: DataFrame) -> DataFrame:
    """Pairs with the best score that a phrase with this prefix, or this end, can have.

    Such a phrase is at most as frequent as the pair, and what is cut off together with
    it at least as frequent as the phrase, so a / (f + a) with a of the pair and f of its
    rarer word is a bound for both.
    """
    counts = words.select("lang", F.col("phrase").alias("word"), F.col("n").alias("f"))
    split = pairs.withColumns(
        {"w1": F.substring_index("phrase", " ", 1), "w2": F.substring_index("phrase", " ", -1)}
    )
    for name in ("w1", "w2"):
        split = split.join(
            counts.select("lang", F.col("word").alias(name), F.col("f").alias(f"f_{name}")), ["lang", name]
        )
    rarer = F.least("f_w1", "f_w2")
    return split.withColumn("rarer", rarer).select(
        "lang", "phrase", "n", F.expr(_SHARE.format(a="n", l="rarer", r="n")).alias("bound")
    )


def _frontier(branches: DataFrame, wanted: int) -> DataFrame:
    """``(lang, floor)``: the bound down to which each language's branches are open.

    At least ``wanted`` are, all ties included; 0 opens all. Bounds are whole numbers
    up to 1,000,000, so the table of their counts is small at any size.
    """
    levels = branches.groupBy("lang", "bound").agg(F.count(F.lit(1)).alias("n"))
    better = F.sum("n").over(Window.partitionBy("lang").orderBy(F.desc("bound")))
    return (
        levels.withColumn("reached", better)
        .groupBy("lang")
        .agg(F.coalesce(F.max(F.when(F.col("reached") >= wanted, F.col("bound"))), F.lit(0).cast("long")).alias("floor"))
    )


def _scored(candidates: DataFrame, counts: DataFrame) -> DataFrame:
    """Phrases with their lowest-scoring cut ``(l, r, score)``; those with an uncounted part go."""
    words = F.split("phrase", " ")
    cuts = candidates.select(
        "lang", "phrase", "size", F.col("n").alias("a"), words.alias("words"),
        F.explode(F.expr("sequence(1, size - 1)")).alias("k"),
    ).select(
        "lang", "phrase", "size", "a", "k",
        F.array_join(F.slice("words", F.lit(1), F.col("k")), " ").alias("first"),
        F.array_join(F.slice("words", F.col("k") + 1, F.col("size") - F.col("k")), " ").alias("rest"),
    )
    for name, side in (("l", "first"), ("r", "rest")):
        cuts = cuts.join(
            counts.select("lang", F.col("phrase").alias(side), F.col("n").alias(name)), ["lang", side]
        )
    cut = F.struct(F.expr(_SHARE.format(a="a", l="l", r="r")).alias("score"), "k", "l", "r")
    return (
        cuts.groupBy("lang", "phrase", "size", "a")
        .agg(F.min(cut).alias("cut"), F.count(F.lit(1)).alias("cuts"))
        .where("cuts = size - 1")
        .select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    )


def _surviving(scored: DataFrame, longer: DataFrame, share: int) -> DataFrame:
    """Phrases that are not mostly a part of one longer phrase."""
    words = F.split("phrase", " ")
    parts = longer.select("lang", "size", "n", words.alias("words")).select(
        "lang",
        "n",
        F.explode(
            F.expr(
                "flatten(transform(sequence(2, size - 1), s -> transform(sequence(1, size - s + 1), "
                "i -> array_join(slice(words, i, s), ' '))))"
            )
        ).alias("phrase"),
    )
    within = parts.groupBy("lang", "phrase").agg(F.max("n").alias("longest"))
    mostly = F.expr(f"100 * cast(longest as decimal(20,0)) >= {share} * cast(a as decimal(20,0))")
    return (
        scored.join(within, ["lang", "phrase"], "left")
        .where(F.col("longest").isNull() | ~mostly)
        .drop("longest")
    )


def collocations(
    docs: DataFrame,
    top: int = 2_000,
    least: int = 30,
    share: int = 80,
    lang_col: str = "lang",
    text_col: str = "text",
    first: int = FIRST,
    block_words: int = BLOCK,
) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: each language's ``top`` phrases.

    A phrase has 2 to 4 words inside a piece and at least ``least`` places (``a``). It is
    scored by its lowest-scoring cut into parts with ``l`` and ``r`` places,
    floor(2000000 a / (l + r)); equal scores go to the earliest cut. It is dropped if a longer
    phrase that contains it has ``share`` percent of its places. Ranks go by score and places
    descending, then by the phrase in byte order. ``n`` counts the words of the language.

    A null text is empty, a null language ``und``. Repeated rows count again. A language
    without such phrases has no rows, nor has an empty table. Other columns are not
    read. Memory in a task is bounded by ``block_words`` plus the longest text.
    """
    texts = docs.select(
        F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"), utf8(text_col).alias("content")
    )
    every = stored(_counted(texts, _words, 1, block_words), "words")
    totals = every.groupBy("lang").agg(F.sum("n").alias("total"))
    words = every.where(F.col("n") >= least)
    pairs = stored(_counted(texts, _pairs, least, block_words, _filter(words)), "pairs")
    branches = stored(_branches(pairs, words), "branches")
    frequent = _filter(pairs)
    done, todo, wanted = None, branches, first
    while not todo.isEmpty():
        floors = stored(_frontier(todo, wanted), "floors")
        opened = stored(
            todo.join(floors, "lang").where("bound >= floor").select("lang", "phrase"), "opened"
        )
        inside = texts.join(floors.select("lang"), "lang", "left_semi")
        longer = stored(
            _counted(inside, _longer, least, block_words, frequent, _filter(opened)), "longer"
        )
        candidates = pairs.join(floors.select("lang"), "lang", "left_semi").unionByName(longer)
        counts = words.unionByName(pairs).unionByName(longer)
        # Below the floor some phrase may be uncounted; at and above it, all are exact.
        scored = _scored(candidates, counts).join(floors, "lang").where("score >= floor")
        found = stored(_surviving(scored, longer, share), "surviving")
        settled = stored(
            floors.join(found.groupBy("lang").agg(F.count(F.lit(1)).alias("n")), "lang", "left")
            .where((F.col("floor") == 0) | (F.col("n") >= top))
            .select("lang"),
            "settled",
        )
        now = found.join(settled, "lang", "left_semi").drop("floor")
        done = now if done is None else done.unionByName(now)
        todo = stored(todo.join(settled, "lang", "left_anti"), "branches")
        wanted *= GROWTH
    if done is None:
        done = docs.sparkSession.createDataFrame(
            [], "lang string, phrase string, a long, l long, r long, score long"
        )
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (
        done.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= top)
        .join(totals, "lang")
        .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r",
                F.col("total").alias("n"), "score")
    )
