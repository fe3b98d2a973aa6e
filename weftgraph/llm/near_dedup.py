"""Near-duplicate documents from bottom-k sketches.

One hash function maps the distinct word shingles of a document to numbers; the k
smallest are its sketch. Documents that share retained values meet in inverted lists.
Of two similar sketches the rarest values already have one in common, so only those
are listed, which keeps boilerplate out of the lists. Pairs from a list pass an estimate
of their similarity on the sketch of their union, and then their full shingle sets are
compared exactly.

Texts that share listed values of their sketches go on to lists of their full sets. Shingles
are ranked from rare to common among these texts; of two sets at the threshold with n shingles
each, one is common to both among the n - ceil(threshold n) + 1 rarest of either, so only those
are listed, and the places where it stands bound what can follow it. What a group of copies
has in common thus makes no list.

No list is ever expanded into all its pairs. Equal sets are one node from the start. In each
round some members of a list, its pivots, are compared with those other members that are not
yet in their component and that size and place leave in reach; then components are merged and
the pivots leave the list. A list is done when its members are in one component or one of them
is left.
"""

from __future__ import annotations

from hashlib import blake2b
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from weftgraph.llm.common import in_batches, in_tasks, map_rows, mixed, slices, stored, utf8, word_hashes
from weftgraph.llm.components import components

SKETCH = 48
MISS = 1e-10  # accepted chance that a pair at the threshold shares too few values


def words_of(text: bytes) -> list[bytes]:
    return text.lower().split()


def shingle_set(words: list[bytes], width: int) -> set[tuple[bytes, ...]]:
    """The distinct shingles themselves; fewer words than ``width`` are one shingle."""
    if len(words) < width:
        return {tuple(words)} if words else set()
    return set(zip(*(words[i:] for i in range(width))))


def shingle_hashes(words: list[bytes], width: int) -> np.ndarray:
    """The sorted distinct hashes of the shingles."""
    if not words:
        return np.empty(0, np.int64)
    used = min(width, len(words))
    factors = mixed(np.arange(1, used + 1, dtype=np.uint64) + np.uint64(used << 32)) | np.uint64(1)
    hashes = word_hashes(words)
    size = len(words) - used + 1
    total = np.zeros(size, np.uint64)
    for i in range(used):
        total += hashes[i : i + size] * factors[i]
    return np.unique((mixed(total) >> np.uint64(1)).astype(np.int64))


def least_shared(percent: int, k: int = SKETCH, miss: float = MISS) -> int:
    """Values that two sketches at the threshold share but for a chance of ``miss``.

    Of the k smallest hashes of the union, each lies in both sets with the similarity as
    its probability.
    """
    p, tail = percent / 100, 0.0
    for shared in range(k + 1):
        tail += comb(k, shared) * p**shared * (1 - p) ** (k - shared)
        if tail > miss:
            return max(1, shared)
    return k


def _prefix_length(n: Column, percent: int, k: int) -> Column:
    """How many of the rarest values of a sketch must be listed."""
    shared = least_shared(percent, k)
    # With all of both sets in the sketches, the threshold itself bounds what is shared.
    complete = n * 100 <= F.lit(k * percent)
    needed = F.when(complete, F.ceil(n * percent / 100)).otherwise(F.lit(shared))
    return (F.least(n, F.lit(k)) - needed + 1).cast("int")


def _hashed(rows: DataFrame, width: int, k: int | None) -> DataFrame:
    """``(id, n, d1, d2, hashes)`` of ``rows`` (id, text): a digest of the shingle set and its hashes.

    Only the ``k`` smallest hashes are returned if ``k`` is given.
    """
    id_type = rows.schema["id"].dataType
    kind = to_arrow_type(id_type)

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                sizes, digests, held = [], [], []
                for text in part.column(1):
                    hashes = shingle_hashes(words_of(text.as_py()), width)
                    sizes.append(len(hashes))
                    digests.append(blake2b(hashes.tobytes(), digest_size=16).digest())
                    held.append(hashes[:k])
                offsets = np.cumsum([0, *map(len, held)]).astype(np.int32)
                halves = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).cast(kind),
                        pa.array(sizes, pa.int64()),
                        pa.array(halves[:, 0].copy()),
                        pa.array(halves[:, 1].copy()),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(held))),
                    ],
                    ["id", "n", "d1", "d2", "hashes"],
                )

    schema = f"id {id_type.simpleString()}, n long, d1 long, d2 long, hashes array<long>"
    return in_batches(rows.select("id", "text"), run, schema)


def _sketched(docs: DataFrame, width: int, k: int) -> DataFrame:
    found = _hashed(docs.select("id", utf8("text").alias("text")), width, k)
    return found.withColumnsRenamed({"n": "n_shingles", "hashes": "sketch"})


def _sharing(nodes: DataFrame, percent: int, k: int) -> DataFrame:
    """The nodes that share a listed value of their sketch; the rarest values are listed."""
    held = nodes.select("node", "d1", "n", F.explode("sketch").alias("value"))
    common = stored(
        held.groupBy("value").agg(F.count(F.lit(1)).alias("df")).where("df > 1"), "common-values"
    )
    shared = F.sort_array(F.collect_list(F.struct("df", "value")))
    alone = F.least("n", F.lit(k)) - F.size("values")
    listed = stored(
        held.join(common, "value")
        .groupBy("node", "d1", "n")
        .agg(shared.alias("values"))
        .withColumn("listed", F.greatest(F.lit(0), _prefix_length(F.col("n"), percent, k) - alone))
        .select("node", F.explode(F.slice("values", F.lit(1), F.col("listed").cast("int"))).alias("v"))
        .select(F.col("v.value").alias("value"), "node"),
        "listed-values",
    )
    several = (
        listed.groupBy("value")
        .agg(F.min("node").alias("low"), F.max("node").alias("high"))
        .where("low <> high")
    )
    return listed.join(several.select("value"), "value").select("node").distinct()


def _lists(texts: DataFrame, percent: int, width: int) -> DataFrame:
    """``(value, node, n, place, weight)``: the listed shingles of each text.

    Shingles are placed from rare to common among ``texts``, those of one text only first.
    ``weight`` adds up how common the shingles of a text are; among copies of one text it is
    highest for the least altered one.
    """
    hashed = _hashed(texts.withColumnRenamed("node", "id"), width, None)
    held = stored(hashed.withColumnRenamed("id", "node"), "shingles")
    each = held.select("node", "d1", "n", F.explode("hashes").alias("value"))
    common = stored(
        each.groupBy("value").agg(F.count(F.lit(1)).alias("df")).where("df > 1"), "common-shingles"
    )
    shared = F.sort_array(F.collect_list(F.struct("df", "value")))
    alone = (F.col("n") - F.size("values")).cast("int")
    prefix = (F.col("n") - F.ceil(F.col("n") * percent / 100) + 1).cast("int")
    return (
        each.join(common, "value")
        .groupBy("node", "d1", "n")
        .agg(shared.alias("values"), F.sum("df").alias("weight"))
        .withColumn("alone", alone)
        .withColumn("listed", F.slice("values", F.lit(1), F.greatest(F.lit(0), prefix - alone)))
        .select("node", "n", "weight", "alone", F.posexplode("listed").alias("at", "v"))
        .select(F.col("v.value").alias("value"), "node", "n", (F.col("alone") + F.col("at") + 1).alias("place"), "weight")
    )


def _open(lists: DataFrame) -> DataFrame:
    """The lists with members in more than one component, their size and largest component."""
    members = lists.groupBy("value", "component").agg(F.count(F.lit(1)).alias("size"))
    return (
        members.groupBy("value")
        .agg(
            F.max_by("component", F.struct("size", "component")).alias("main"),
            F.sum("size").alias("members"),
            F.count(F.lit(1)).alias("parts"),
        )
        .where("parts > 1")
        .drop("parts")
    )


def _pivots(lists: DataFrame, open_lists: DataFrame, round_number: int) -> DataFrame:
    """``(value, pivot, pivot_n, pivot_place, pivot_component)``: members to compare with the others.

    First the member of a list with the highest weight; later up to 8, 64, 512 ... members
    outside the largest component, dealt by hash, so that any list is done after few rounds.
    """
    member = F.struct(
        F.col("weight"),
        F.col("node").alias("pivot"),
        F.col("n").alias("pivot_n"),
        F.col("place").alias("pivot_place"),
        F.col("component").alias("pivot_component"),
    )
    here = lists.join(open_lists, "value")
    if round_number == 0:
        chosen = here.groupBy("value").agg(F.max(member).alias("p"))
    else:
        slot = F.pmod(F.xxhash64("node", F.lit(round_number)), F.lit(8**round_number))
        chosen = (
            here.where("component <> main")
            .groupBy("value", slot.alias("slot"))
            .agg(F.max(member).alias("p"))
        )
    return chosen.select("value", "p.pivot", "p.pivot_n", "p.pivot_place", "p.pivot_component")


def _likely(pairs: DataFrame, sketches: DataFrame, percent: int, k: int, id_type: str) -> DataFrame:
    """Pairs whose similarity, estimated on the sketch of their union, may reach the threshold."""
    least = least_shared(percent, k)

    def estimated(batch: dict) -> list[tuple]:
        rows = []
        for a, b, x, y in zip(batch["a"], batch["b"], batch["sketch_a"], batch["sketch_b"]):
            union = sorted({*x, *y})[:k]
            both = len({*x} & {*y} & {*union})
            if both >= least if len(union) == k else 100 * both >= percent * len(union):
                rows.append((a, b))
        return rows

    joined = pairs.join(sketches.select(F.col("node").alias("a"), F.col("sketch").alias("sketch_a")), "a")
    joined = joined.join(
        sketches.select(F.col("node").alias("b"), F.col("sketch").alias("sketch_b")), "b"
    )
    joined = in_tasks(joined.select("a", "b", "sketch_a", "sketch_b"), pairs.count(), 20_000)
    return map_rows(joined, estimated, f"a {id_type}, b {id_type}")


def _verified(pairs: DataFrame, texts: DataFrame, percent: int, width: int, id_type: str) -> DataFrame:
    """Pairs ``(u, v)`` whose full shingle sets reach the threshold."""

    def compared(batch: dict) -> list[tuple]:
        rows = []
        for a, b, x, y in zip(batch["a"], batch["b"], batch["text_a"], batch["text_b"]):
            x, y = (shingle_set(words_of(t), width) for t in (x, y))
            both = len(x & y)
            if 100 * both >= percent * (len(x) + len(y) - both):
                rows.append((a, b))
        return rows

    joined = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
    joined = joined.join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
    joined = in_tasks(joined.select("a", "b", "text_a", "text_b"), pairs.count(), 2_000)
    return map_rows(joined, compared, f"u {id_type}, v {id_type}")


def _round(
    lists: DataFrame, round_number: int, sketches: DataFrame, texts: DataFrame, percent: int,
    width: int, k: int, id_type: str,
) -> tuple[DataFrame, DataFrame] | None:
    """New links and the pivots used, or None if no list is open."""
    rows = lists.count()
    open_lists = stored(in_tasks(_open(lists), rows), "open-lists")
    if open_lists.isEmpty():
        return None
    pivots = stored(in_tasks(_pivots(lists, open_lists, round_number), rows), "pivots")
    near = F.expr(
        f"lists.value = pivots.value and component <> pivot_component "
        f"and 100 * least(n, pivot_n) >= {percent} * greatest(n, pivot_n) "
        f"and {100 + percent} * (1 + least(n - place, pivot_n - pivot_place)) >= {percent} * (n + pivot_n)"
    )
    pairs = (
        lists.alias("lists").join(pivots.alias("pivots"), near)
        .select(F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b"))
        .distinct()
    )
    pairs = stored(in_tasks(pairs, rows * min(8**round_number, 64)), "pairs")
    likely = stored(_likely(pairs, sketches, percent, k, id_type), "likely")
    return stored(_verified(likely, texts, percent, width, id_type), "links"), pivots


def near_duplicates(
    docs: DataFrame,
    width: int = 5,
    percent: int = 80,
    k: int = SKETCH,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``(id, n_shingles, component_id, kept)`` per document.

    Documents are linked if the Jaccard similarity of their shingle sets is at least
    ``percent`` percent; a component is named by its smallest id and that document is
    kept. Words are cut at ASCII white space and A-Z lower-cased. A text with fewer words
    than ``width`` is one shingle; a null or blank text has none and is linked with
    nothing. Rows with a null id are linked with nothing, have a null component and are
    kept. Rows that share an id and their shingles are one document. Any two documents
    above the threshold are compared but for a chance of about ``MISS``; only links that
    join two components are looked for.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    named = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    sketched = stored(_sketched(named, width, k), "sketches")
    digest = ["d1", "d2"]
    classes = stored(
        sketched.where("id is not null and n_shingles > 0")
        .groupBy(*digest)
        .agg(F.min("id").alias("node")),
        "classes",
    )
    match = [sketched.id == classes.node, *[sketched[c] == classes[c] for c in digest]]
    nodes = stored(
        classes.join(sketched.where("id is not null"), match)
        .select("node", sketched.d1, sketched.d2, F.col("n_shingles").alias("n"), "sketch")
        .dropDuplicates(["node", *digest]),
        "nodes",
    )
    active = stored(_sharing(nodes, percent, k), "active")
    texts = stored(
        named.withColumnRenamed("id", "node")
        .join(active, "node")
        .select("node", utf8("text").alias("text"))
        .dropDuplicates(["node", "text"]),
        "texts",
    )
    sketches = stored(nodes.join(active, "node").select("node", "sketch"), "active-sketches")
    lists = stored(_lists(texts, percent, width).withColumn("component", F.col("node")), "lists")
    found, round_number = None, 0
    while made := _round(lists, round_number, sketches, texts, percent, width, k, id_type):
        links, pivots = made
        if not links.isEmpty():
            known = links if found is None else links.unionByName(
                found.select(F.col("node").alias("u"), F.col("component").alias("v"))
            )
            found = stored(components(stored(known, "known-links")), "components")
        rest = lists.join(
            pivots.select("value", F.col("pivot").alias("node")), ["value", "node"], "left_anti"
        )
        if found is not None:
            merged = F.coalesce("merged", F.col("component"))
            rest = (
                rest.join(found.select("node", F.col("component").alias("merged")), "node", "left")
                .withColumn("component", merged)
                .drop("merged")
            )
        lists = stored(in_tasks(rest, lists.count()), "lists")
        round_number += 1
    named_classes = classes.withColumn("component", F.col("node")) if found is None else (
        classes.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    )
    final = stored(named_classes.select(*digest, "component"), "class-components")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
    return (
        sketched.drop("sketch")
        .join(final, digest, "left")
        .withColumn("component_id", component)
        .select(
            F.col("id").alias(id_col),
            "n_shingles",
            "component_id",
            F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
        )
    )
