"""How far the sources of a language differ in their use of terms.

Single-pass in-memory indexing: a task builds postings (term, source, count) block by block.
A full block is spilled as a run of pages, sorted by term and dealt to hash shards of the
terms. In a shard the runs are merged through a heap, page after page, into the frequencies
of each term. The divergence of a pair of sources starts from the value that terms found in
neither would give and is then corrected: for the terms of one side through the histogram of
its counts, for terms of both sides by streaming the terms once more.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from weftgraph.llm.common import stored, utf8

BLOCK = 1_000_000  # terms in memory before their postings are spilled
PAGE = 1_000  # different terms of a page, at most
FLUSH = 20_000  # merged terms that are added up at once
CHUNKS = 64  # parts of the histogram of one source
TILE = 256  # sources along one side of a block of pair sums
TILES = 64  # blocks of pair sums that a task holds
SCALE = 1_000_000_000

# A term is a run of ASCII letters and of characters beyond ASCII.
_TERM_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 else 32 for c in range(256)
)


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(_TERM_BYTES).split()


# --- runs

_PAGE = pa.schema(
    [
        ("shard", pa.int32()),
        ("lang", pa.string()),
        ("first", pa.binary()),
        ("terms", pa.list_(pa.binary())),
        ("docs", pa.list_(pa.int64())),
        ("ends", pa.list_(pa.int32())),
        ("names", pa.list_(pa.string())),
        ("sources", pa.list_(pa.int32())),
        ("counts", pa.list_(pa.int64())),
    ]
)
# ``ends`` cuts ``sources`` (places in ``names``) and ``counts`` into the postings of each term.
_PAGE_DDL = (
    "shard int, lang string, first binary, terms array<binary>, docs array<long>, ends array<int>, "
    "names array<string>, sources array<int>, counts array<long>"
)


class _Numbers(dict):
    """Numbers for the terms of one language, given out from a list that all share."""

    def __init__(self, lang: str, terms: list[tuple[str, bytes]]):
        self.lang, self.terms = lang, terms

    def __missing__(self, term: bytes) -> int:
        number = self[term] = len(self.terms)
        self.terms.append((self.lang, term))
        return number


class Block:
    """Texts in memory as numbers of their terms, with the source of each."""

    def __init__(self):
        self.terms: list[tuple[str, bytes]] = []
        self.numbers: dict[str, _Numbers] = {}
        self.sources: dict[str, int] = {}
        self.texts: list[np.ndarray] = []
        self.text_source: list[int] = []
        self.size = 0

    def add(self, lang: str, source: str, terms: list[bytes]) -> None:
        known = self.numbers.get(lang)
        if known is None:
            known = self.numbers[lang] = _Numbers(lang, self.terms)
        ids = np.fromiter(map(known.__getitem__, terms), np.int64, len(terms))
        self.texts.append(ids)
        self.text_source.append(self.sources.setdefault(source, len(self.sources)))
        self.size += len(ids) + 1

    def pages(self, shards: int) -> Iterator[tuple]:
        """The block as a run: per shard and language its terms in order, cut into pages."""
        if not self.terms:
            return
        ids = np.concatenate(self.texts)
        lengths = [len(t) for t in self.texts]
        text = np.repeat(np.arange(len(lengths)), lengths)
        once = np.sort(text * len(self.terms) + ids)
        once = once[np.diff(once, prepend=-1) != 0]
        docs = np.bincount(once % len(self.terms))
        width = len(self.sources)
        source = np.repeat(np.array(self.text_source, np.int64), lengths)
        placed = np.sort(ids * width + source)
        starts = np.flatnonzero(np.diff(placed, prepend=-1))
        postings, counts = placed[starts], np.diff(np.append(starts, len(placed)))
        begin = np.searchsorted(postings, np.arange(len(self.terms) + 1) * width)
        source = postings % width
        names = np.array([*self.sources], object)
        dealt: dict[tuple[int, str], list[tuple[bytes, int]]] = defaultdict(list)
        for number, (lang, term) in enumerate(self.terms):
            dealt[xxh64_intdigest(term) % shards, lang].append((term, number))
        for (at_shard, lang), held in dealt.items():
            held.sort()
            for at in range(0, len(held), PAGE):
                terms = [term for term, _ in held[at : at + PAGE]]
                page = np.array([number for _, number in held[at : at + PAGE]])
                sizes = begin[page + 1] - begin[page]
                ends = np.concatenate([[0], np.cumsum(sizes)])
                where = np.repeat(begin[page] - ends[:-1], sizes) + np.arange(ends[-1])
                used, places = np.unique(source[where], return_inverse=True)
                yield (
                    at_shard, lang, terms[0], terms, docs[page], ends.astype(np.int32),
                    names[used].tolist(), places.astype(np.int32), counts[where],
                )


def _batches(rows: Iterator[tuple], schema: pa.Schema, size: int) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, f.type) for v, f in zip(zip(*held), schema)], schema=schema
            )
            held = []
    if held:
        yield pa.RecordBatch.from_arrays(
            [pa.array(v, f.type) for v, f in zip(zip(*held), schema)], schema=schema
        )


def _runs(docs: DataFrame, shards: int, block_terms: int) -> DataFrame:
    def spilled(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        block = Block()
        for batch in batches:
            lang, source, text = (batch.column(i) for i in range(3))
            for i in range(batch.num_rows):
                block.add(lang[i].as_py(), source[i].as_py(), terms_of(text[i].as_py()))
                if block.size >= block_terms:
                    yield from block.pages(shards)
                    block = Block()
        yield from block.pages(shards)

    return docs.mapInArrow(lambda batches: _batches(spilled(batches), _PAGE, 64), _PAGE_DDL)


# --- merge

_FREQUENCY = pa.schema(
    [
        ("lang", pa.string()),
        ("term", pa.string()),
        ("n_docs", pa.int64()),
        ("total", pa.int64()),
        ("sources", pa.list_(pa.string())),
        ("counts", pa.list_(pa.int64())),
    ]
)
_FREQUENCY_DDL = (
    "lang string, term string, n_docs long, total long, sources array<string>, counts array<long>"
)


class _Page:
    """A page of a run, with its sources in the numbers of the merging task."""

    def __init__(self, batch: pa.RecordBatch, row: int, known: dict[str, int]):
        value = {name: batch.column(i)[row] for i, name in enumerate(batch.schema.names)}
        self.shard, self.lang, self.first = (value[c].as_py() for c in ("shard", "lang", "first"))
        self.terms = value["terms"].as_py()
        self.docs, self.ends, self.counts, places = (
            value[c].values.to_numpy() for c in ("docs", "ends", "counts", "sources")
        )
        codes = [known.setdefault(name, len(known)) for name in value["names"].as_py()]
        self.sources = np.array(codes, np.int64)[places]


def _merged(pages: Iterator[_Page]) -> Iterator[tuple[bytes, _Page, int]]:
    """``(term, page, place in it)`` in the order of terms, from pages ordered by first term.

    The next term of every open page is in a heap. A page is opened once no smaller term
    is left, so only pages that overlap are open.
    """
    heap: list[tuple] = []
    number = 0
    page = next(pages, None)
    while heap or page is not None:
        if page is not None and (not heap or page.first <= heap[0][0]):
            heapq.heappush(heap, (page.first, number, 0, page))
            number, page = number + 1, next(pages, None)
            continue
        term, n, at, held = heap[0]
        yield term, held, at
        if at + 1 < len(held.terms):
            heapq.heapreplace(heap, (held.terms[at + 1], n, at + 1, held))
        else:
            heapq.heappop(heap)


def _added_up(
    lang: str, terms: list[bytes], entries: list[tuple[int, _Page, int]], names: dict[str, int], least: int
) -> pa.RecordBatch:
    """The frequencies of merged ``terms`` from ``(number of the term, page, place)`` entries."""
    docs = np.zeros(len(terms), np.int64)
    by_page: dict[int, tuple[_Page, list[int], list[int]]] = {}
    for number, page, at in entries:
        held = by_page.setdefault(id(page), (page, [], []))
        held[1].append(number)
        held[2].append(at)
    keys, counts = [], []
    for page, numbers, places in by_page.values():
        number, at = np.array(numbers), np.array(places)
        np.add.at(docs, number, page.docs[at])
        sizes = page.ends[at + 1] - page.ends[at]
        before = np.cumsum(sizes) - sizes
        where = np.repeat(page.ends[at] - before, sizes) + np.arange(sizes.sum())
        keys.append(np.repeat(number, sizes) * len(names) + page.sources[where])
        counts.append(page.counts[where])
    key, count = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(key, kind="stable")
    key, count = key[order], count[order]
    starts = np.flatnonzero(np.diff(key, prepend=-1))
    count = np.add.reduceat(count, starts)
    number, source = key[starts] // len(names), key[starts] % len(names)
    use = docs >= least
    inside = use[number]
    number, source, count = number[inside], source[inside], count[inside]
    total = np.zeros(len(terms), np.int64)
    np.add.at(total, number, count)
    offsets = pa.array(np.append(0, np.cumsum(np.bincount(number, minlength=len(terms))[use])).astype(np.int32))
    return pa.RecordBatch.from_arrays(
        [
            pa.array([lang] * int(use.sum()), pa.string()),
            pa.array([t.decode() for t, u in zip(terms, use) if u], pa.string()),
            pa.array(docs[use]),
            pa.array(total[use]),
            pa.ListArray.from_arrays(offsets, pa.array([*names], pa.string()).take(pa.array(source))),
            pa.ListArray.from_arrays(offsets, pa.array(count)),
        ],
        schema=_FREQUENCY,
    )


def _frequencies(runs: DataFrame, shards: int, least_docs: int) -> DataFrame:
    """``(lang, term, n_docs, total, sources, counts)`` of terms in at least ``least_docs`` texts."""

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, int] = {}
        pages = (_Page(batch, i, known) for batch in batches for i in range(batch.num_rows))
        for (_, lang), group in groupby(pages, lambda p: (p.shard, p.lang)):
            terms: list[bytes] = []
            entries: list[tuple[int, _Page, int]] = []
            for term, page, at in _merged(group):
                if not terms or term != terms[-1]:
                    if len(terms) == FLUSH:
                        yield _added_up(lang, terms, entries, known, least_docs)
                        terms, entries = [], []
                    terms.append(term)
                entries.append((len(terms) - 1, page, at))
            yield _added_up(lang, terms, entries, known, least_docs)

    return (
        runs.repartition(shards, "shard")
        .sortWithinPartitions("shard", "lang", "first")
        .mapInArrow(merged, _FREQUENCY_DDL)
    )


# --- shares and pair sums


def _share(count: str, total: str) -> str:
    """1 + floor(SCALE (count + 2) / (total + 2 V)), in decimals, which do not overflow."""
    above = f"cast({SCALE} as decimal(20,0)) * cast({count} + 2 as decimal(18,0))"
    return f"1 + ({above} div cast({total} + 2 * n_terms as decimal(20,0)))"


def _apart(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """floor((p - q)^2 / (p + q)); shares are at most SCALE + 1, so 64 bits hold the square."""
    return (p - q) ** 2 // (p + q)


_SUM = pa.schema([("lang", pa.string()), ("a", pa.int64()), ("b", pa.int64()), ("value", pa.int64())])
_SUM_DDL = "lang string, a long, b long, value long"


def _sums(lang: str, a: np.ndarray, b: np.ndarray, value: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array([lang] * len(value), pa.string()),
            pa.array(np.minimum(a, b)),
            pa.array(np.maximum(a, b)),
            pa.array(value),
        ],
        schema=_SUM,
    )


def _one_sided(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What the terms of one source add against every other source of its language.

    The first chunk of a source also brings, once per pair, what ``n_terms`` terms that
    neither has would add up to.
    """
    for batch in batches:
        for row in batch.to_pylist():
            other = np.array([o["place"] for o in row["others"]], np.int64)
            rest = np.array([o["rest"] for o in row["others"]], np.int64)
            base = _apart(np.int64(row["rest"]), rest)
            value = np.zeros(len(other), np.int64)
            for bin_ in row["bins"]:
                value += bin_["n"] * (_apart(np.int64(bin_["p"]), rest) - base)
            if row["leads"]:
                value += np.where(other > row["place"], row["n_terms"] * base, 0)
            use = other != row["place"]
            if use.any():
                yield _sums(row["lang"], np.full(use.sum(), row["place"]), other[use], value[use])


def _two_sided(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Corrections for terms that both sources of a pair have, added up in square blocks."""
    tiles: dict[tuple[str, int, int], np.ndarray] = {}

    def flushed():
        for (lang, u, v), tile in tiles.items():
            a, b = np.nonzero(tile)
            if len(a):
                yield _sums(lang, a + u * TILE, b + v * TILE, tile[a, b])
        tiles.clear()

    for batch in batches:
        lang_column, held_column = batch.column(0), batch.column(1)
        for i in range(batch.num_rows):
            lang = lang_column[i].as_py()
            held = held_column[i].values.flatten()
            place, p, rest = (np.asarray(x, np.int64) for x in held)
            order = np.argsort(place)
            place, p, rest = place[order], p[order], rest[order]
            cuts = np.flatnonzero(np.diff(place // TILE)) + 1
            spans = list(zip([0, *cuts.tolist()], [*cuts.tolist(), len(place)]))
            for x, (s, t) in enumerate(spans):
                for s2, t2 in spans[x:]:
                    pa_, pb = p[s:t, None], p[None, s2:t2]
                    ra, rb = rest[s:t, None], rest[None, s2:t2]
                    more = _apart(pa_, pb) - _apart(pa_, rb) - _apart(ra, pb) + _apart(ra, rb)
                    key = (lang, int(place[s] // TILE), int(place[s2] // TILE))
                    if key not in tiles:
                        if len(tiles) == TILES:
                            yield from flushed()
                        tiles[key] = np.zeros((TILE, TILE), np.int64)
                    u, v = place[s:t] % TILE, place[s2:t2] % TILE
                    if s == s2:
                        more = np.triu(more, 1)
                    tiles[key][np.ix_(u, v)] += more
    yield from flushed()


def _groups(docs: DataFrame, terms: DataFrame, each: DataFrame) -> DataFrame:
    """Every (lang, source) with its place among those of the language, counts and ``rest``.

    ``rest`` is the share of a term that the source does not have; null without terms.
    """
    counted = each.groupBy("lang", "source").agg(F.sum("count").alias("n"))
    kept = terms.groupBy("lang").agg(F.count(F.lit(1)).alias("n_terms"))
    by_lang = Window.partitionBy("lang")
    zero = F.lit(0).cast("long")
    return (
        docs.select("lang", "source")
        .distinct()
        .join(counted, ["lang", "source"], "left")
        .join(kept, "lang", "left")
        .select(
            "lang", "source", F.coalesce("n", zero).alias("n"), F.coalesce("n_terms", zero).alias("n_terms")
        )
        .withColumn("lang_n", F.sum("n").over(by_lang))
        .withColumn("place", F.row_number().over(by_lang.orderBy("source")).cast("long") - 1)
        .withColumn("rest", F.when(F.col("n_terms") > 0, F.expr(_share("0", "n"))))
    )


def source_divergence(
    docs: DataFrame,
    least_docs: int = 10,
    best: int = 10,
    lang_col: str = "lang",
    source_col: str = "source",
    text_col: str = "text",
    block_terms: int = BLOCK,
) -> DataFrame:
    """``(lang, source, part, item, value, rank)``: pairs of sources, and each source's own terms.

    A language keeps the terms that at least ``least_docs`` of its documents have. Shares are
    smoothed and scaled to whole numbers, and two shares are f = (p - q)^2 / (p + q) apart,
    rounded down. Part ``pair`` has each other source of the language and the sum of f over
    all kept terms; part ``term`` the ``best`` terms that a source has more often than its
    language, by f. Ranks go by value descending, then by item in byte order.

    Null texts, languages and sources count as empty ones, which are names like any other.
    A repeated row counts again. A source without kept terms has pairs only, a language of
    one source terms only; an empty table gives no rows. Other columns are not read.
    Memory in a task is bounded by ``block_terms`` plus the longest text.
    """
    named = docs.select(
        *[F.coalesce(F.col(c), F.lit("")).alias(n) for c, n in ((lang_col, "lang"), (source_col, "source"))],
        utf8(text_col).alias("content"),
    )
    shards = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    runs = stored(_runs(named, shards, block_terms), "runs")
    terms = stored(_frequencies(runs, shards, least_docs), "term-frequencies")
    each = terms.select("lang", "term", "total", F.inline(F.arrays_zip("sources", "counts"))).toDF(
        "lang", "term", "total", "source", "count"
    )
    groups = stored(_groups(named, terms, each), "source-groups")
    priced = stored(
        each.join(groups, ["lang", "source"]).select(
            "lang", "term", "source", "place", "rest", F.expr(_share("count", "n")).alias("p"),
            F.expr(_share("total", "lang_n")).alias("q"),
        ),
        "shares",
    )
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    own = (
        priced.where("p > q")
        .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
                F.expr("((p - q) * (p - q)) div (p + q)").alias("value"))
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= best)
    )

    others = groups.groupBy("lang").agg(
        F.sort_array(F.collect_list(F.struct("place", "rest"))).alias("others")
    )
    histogram = (
        priced.groupBy("lang", "place", "p")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("lang", "place", F.pmod(F.xxhash64("p"), F.lit(CHUNKS)).alias("chunk"))
        .agg(F.collect_list(F.struct("p", "n")).alias("bins"))
    )
    lead = groups.where("n_terms > 0").select(
        "lang", "place", F.lit(-1).cast("long").alias("chunk"),
        F.expr("cast(array() as array<struct<p: long, n: long>>)").alias("bins"),
    )
    sides = (
        histogram.unionByName(lead)
        .join(groups.select("lang", "place", "rest", "n_terms"), ["lang", "place"])
        .join(others, "lang")
        .select("lang", "place", "rest", "n_terms", (F.col("chunk") < 0).alias("leads"), "bins", "others")
    )
    shared = (
        priced.groupBy("lang", "term")
        .agg(F.collect_list(F.struct("place", "p", "rest")).alias("held"))
        .where(F.size("held") > 1)
        .select("lang", "held")
    )
    sums = (
        sides.mapInArrow(_one_sided, _SUM_DDL)
        .unionByName(shared.mapInArrow(_two_sided, _SUM_DDL))
        .groupBy("lang", "a", "b")
        .agg(F.sum("value").alias("value"))
    )
    sums = stored(sums, "pair-sums")
    both_ways = sums.select("lang", "a", "b", "value").unionByName(
        sums.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value")
    )
    # A language without kept terms has no sums; its pairs are all 0 apart.
    bare = groups.where("n_terms = 0").select("lang", "place")
    blank = (
        bare.withColumnRenamed("place", "a")
        .join(others.select("lang", F.explode("others.place").alias("b")), "lang")
        .where("a <> b")
        .select("lang", "a", "b", F.lit(0).cast("long").alias("value"))
    )
    names = groups.select("lang", "source", "place")
    pairs = (
        both_ways.unionByName(blank)
        .join(names.withColumnRenamed("place", "a"), ["lang", "a"])
        .join(names.select("lang", F.col("source").alias("item"), F.col("place").alias("b")), ["lang", "b"])
        .select("lang", "source", F.lit("pair").alias("part"), "item", "value")
        .withColumn("rank", F.row_number().over(order))
    )
    return pairs.unionByName(own)
