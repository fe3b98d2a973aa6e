"""Contiguous shards whose largest is as small as it can be.

Equal texts form an atomic group. Groups are ordered by a hash of the text; a shard
is a run of groups. The smallest feasible capacity is found by binary search: a
capacity is feasible if filling shards greedily, group after group, needs no more
shards than asked for. The cuts then fall where what is left would be shared out evenly,
as far as the capacity allows, so no shard stays empty for the sake of the largest one.

The driver never holds a row per group. It sees the order as segments (ranges of the
hash, with their total size). A segment of one group is atomic; one of several is only
bounded: taken as atomic it gives a capacity that surely works, taken as divisible one
below which nothing works. Segments in which a cut may fall between the two are cut
finer, until both capacities are equal, and then the cuts are exact.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftgraph.llm.common import running_before, stored

HASH_BITS = 60
STEP_BITS = 12  # first segments: 4,096; the same number of parts for all that are refined


class _Order:
    """Segments in hash order as ``(low, high, bytes, one group only)``, both ends included."""

    def __init__(self, segments: list[tuple[int, int, int, bool]]):
        self.segments = segments
        self.ends = list(accumulate(s[2] for s in segments))
        self.total = self.ends[-1] if segments else 0

    def cuts(self, capacity: int, shards: int, divisible: bool) -> list[int] | None:
        """Bytes before each cut of a greedy filling, or None if it needs more shards."""
        at, cuts = 0, []
        while at + capacity < self.total:
            if len(cuts) == shards - 1:
                return None
            # Segments that end at or before at + capacity are inside the shard.
            k = bisect_right(self.ends, at + capacity)
            whole = self.ends[k - 1] if k else 0
            to = at + capacity if divisible and not self.segments[k][3] else max(whole, at)
            if to == at:
                return None
            cuts.append(at := to)
        return cuts

    def even_cuts(self, capacity: int, shards: int) -> tuple[list[int], list[int]]:
        """Bytes before each cut, and the segments that must be cut finer to be sure of them.

        Each shard ends as near as it can to an even share of what is left, but not above the
        capacity and not so early that the rest would not fit.
        """
        unsure: set[int] = set()
        # latest[m]: the first place from which m shards can hold the rest.
        latest = [self.total]
        for _ in range(shards - 1):
            k = bisect_left(self.ends, latest[-1] - capacity)
            start = self.ends[k - 1] if k else 0
            if latest[-1] - capacity <= start:
                latest.append(start)
                continue
            if not self.segments[k][3] and latest[-1] - capacity < self.ends[k]:
                unsure.add(k)
            latest.append(self.ends[k])
        at, cuts = 0, []
        for left in range(shards - 1, 0, -1):
            if at >= self.total:
                break
            low, high = latest[left], at + capacity
            wanted = max(low, min(high, at + self._share(at, left + 1)))
            k = min(bisect_right(self.ends, wanted), len(self.ends) - 1)
            before = self.ends[k - 1] if k else 0
            if before < wanted < self.ends[k] and not self.segments[k][3]:
                unsure.add(k)
            near = [b for b in (before, self.ends[k]) if at < b and low <= b <= high]
            if not near:
                break
            at = min(near, key=lambda b: (abs(b - wanted), b))
            if at < self.total:
                cuts.append(at)
        return cuts, sorted(unsure)

    def _share(self, at: int, shards: int) -> int:
        """An even share of what follows, where groups above it have a shard to themselves."""
        sizes = sorted(s[2] for s, end in zip(self.segments, self.ends) if end > at and s[3])
        rest = self.total - at
        while sizes and shards > 1 and sizes[-1] * shards > rest:
            rest, shards = rest - sizes.pop(), shards - 1
        return max(1, -(-rest // shards))

    def smallest(self, low: int, high: int, shards: int, divisible: bool) -> int:
        while low < high:
            middle = (low + high) // 2
            if self.cuts(middle, shards, divisible) is None:
                low = middle + 1
            else:
                high = middle
        return low

    def unsure(self, low: int, high: int, shards: int) -> list[int]:
        """Segments of several groups in which some cut of a capacity in low..high may fall."""
        first = self._reach(low, shards)
        last = self._far(high, shards)
        found = set()
        for a, b in zip(first, last):
            i = max(0, bisect_right(self.ends, a) - 1)
            j = min(len(self.segments) - 1, bisect_right(self.ends, b))
            found.update(k for k in range(i, j + 1) if not self.segments[k][3])
        return sorted(found)

    def _reach(self, capacity: int, shards: int) -> list[int]:
        """Lowest places that cuts of a capacity can have, feasible or not."""
        at, cuts = 0, []
        for _ in range(shards - 1):
            k = bisect_right(self.ends, min(at + capacity, self.total))
            at = max(at, self.ends[k - 1] if k else 0)
            cuts.append(at)
        return cuts

    def _far(self, capacity: int, shards: int) -> list[int]:
        """Highest places that cuts of a capacity can have."""
        return [min(self.total, capacity * (k + 1)) for k in range(shards - 1)]


def _segments(rows: DataFrame, low_high: list[tuple[int, int]], parts: int) -> list[tuple]:
    """Totals of equal parts of some hash ranges, from one aggregation."""
    widths = [max(1, -(-(high - low + 1) // parts)) for low, high in low_high]
    spark = rows.sparkSession
    ranges = spark.createDataFrame(
        [(i, low, high, width) for i, ((low, high), width) in enumerate(zip(low_high, widths))],
        "range int, low long, high long, width long",
    )
    # At most 2^STEP_BITS ranges, so the small side may be broadcast; the bucket of
    # the first level makes this an equi-join.
    shift = HASH_BITS - STEP_BITS
    spread = ranges.withColumn(
        "top", F.explode(F.expr(f"sequence(shiftright(low, {shift}), shiftright(high, {shift}))"))
    )
    inside = (
        rows.withColumn("top", F.shiftright("hash", shift))
        .join(F.broadcast(spread), "top")
        .where("hash between low and high")
    )
    found = (
        inside.groupBy("range", F.expr("(hash - low) div width").alias("part"))
        .agg(F.sum("size").alias("size"), F.min("hash").alias("a"), F.max("hash").alias("b"))
        .collect()
    )
    return sorted((r["range"], r["a"], r["b"], r["size"]) for r in found)


def _coarse(rows: DataFrame) -> list[tuple[int, int, int, bool]]:
    shift = HASH_BITS - STEP_BITS
    found = (
        rows.groupBy(F.shiftright("hash", shift).alias("top"))
        .agg(F.sum("size").alias("size"), F.min("hash").alias("a"), F.max("hash").alias("b"))
        .collect()
    )
    return sorted((r["a"], r["b"], r["size"], r["a"] == r["b"]) for r in found)


def cut_hashes(rows: DataFrame, shards: int) -> tuple[list[int], int]:
    """Lowest hash of each shard but the first, and the capacity.

    ``rows`` is ``(hash, size)`` with sizes above 0; equal hashes are one group. The driver
    holds segment totals only, a few times 2^STEP_BITS of them at any size.
    """
    order = _Order(_coarse(rows))
    if not order.segments:
        return [], 0
    while True:
        largest = max((s[2] for s in order.segments if s[3]), default=0)
        low = order.smallest(max(largest, -(-order.total // shards)), order.total, shards, True)
        high = order.smallest(low, order.total, shards, False)
        todo = order.unsure(low, high, shards) if low < high else []
        if not todo:
            break
        order = _finer(rows, order, todo)
    cuts, todo = order.even_cuts(high, shards)
    while todo:
        order = _finer(rows, order, todo)
        cuts, todo = order.even_cuts(high, shards)
    starts = dict(zip([0, *order.ends], [s[0] for s in order.segments]))
    return [starts[c] for c in cuts], high


def _finer(rows: DataFrame, order: _Order, todo: list[int]) -> _Order:
    """The order with the segments ``todo`` in parts."""
    asked = [(order.segments[k][0], order.segments[k][1]) for k in todo]
    finer: dict[int, list] = {}
    for i, a, b, size in _segments(rows, asked, max(2, (1 << STEP_BITS) // len(todo))):
        finer.setdefault(todo[i], []).append((a, b, size, a == b))
    return _Order([s for k, old in enumerate(order.segments) for s in finer.get(k, [old])])


def shard_documents(
    docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(id, size, text_crc32, hash, shard, slot)`` per document.

    ``size`` is the UTF-8 length plus 1, a null text counting as an empty one. Equal texts
    share a shard; shards are runs of the hash order, the largest as small as it can be and
    the others near an even share of the rest. Slots count from 0 in each shard, by hash and then id; rows
    equal in both take neighbouring slots in any order. Fewer groups than shards leave
    shards empty; an empty table gives no rows.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = stored(
        docs.select(
            F.col(id_col).alias("id"),
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.conv(F.substring(F.md5(text.cast("binary")), 1, HASH_BITS // 4), 16, 10)
            .cast("long")
            .alias("hash"),
        ),
        "shard-rows",
    )
    cuts, _ = cut_hashes(rows, shards)
    shard = F.lit(0)
    for cut in cuts:
        shard = shard + (F.col("hash") >= F.lit(cut)).cast("int")
    placed = rows.withColumn("shard", shard).withColumn("one", F.lit(1).cast("long"))
    return (
        running_before(placed, ["hash", "id"], "one", "slot", ["shard"])
        .drop("one")
        .withColumnRenamed("id", id_col)
    )


def write_shards(docs: DataFrame, path: str, shards: int = 16, key: str = "doc_id") -> None:
    """The documents in one folder per shard, ordered by slot inside each file.

    Needs a unique, non-null ``key``.
    """
    places = shard_documents(docs, shards, key).select(key, "shard", "slot")
    joined = docs.drop("shard", "slot").join(places, key)
    joined.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy(
        "shard"
    ).parquet(path)
