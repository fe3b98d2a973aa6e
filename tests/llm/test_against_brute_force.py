"""Operators that SQL cannot express, against plain versions on random input."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest import SMALL
from oracle_check import compare, connect

from weftgraph.llm import license_scan, mixing, near_dedup, oracles, packing, quality_model, sharding
from weftgraph.llm import substring_dedup
from weftgraph.llm.common import stored
from weftgraph.llm.components import components
from weftgraph.llm.license_texts import NOTICES, PHRASES, TEXTS
from weftgraph.llm.queries import QUERIES, tokenizer_path

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return {r.doc_id: r.text for r in docs.collect()}


@pytest.mark.parametrize("name", sorted(oracles.ORACLES))
def test_matches_sql(spark, name):
    result = compare(spark, connect(SMALL), name, SMALL)
    assert result["same"], (result["differ"], result["types"])


def test_every_operator_is_registered():
    assert {int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES} == set(range(1, 14))


# --- licenses


def test_matching_statistics():
    licenses = license_scan.standard_licenses()
    rows = [
        (kind, license_scan.license_words(wording.encode()))
        for kind, group in (("phrase", PHRASES), ("notice", NOTICES), ("text", TEXTS))
        for wordings in group.values()
        for wording in wordings
    ]
    words, rng = list(licenses.names), random.Random(1)
    for _ in range(60):
        doc: list[bytes] = []
        while len(doc) < 100:
            _, wording = rng.choice(rows)
            at = rng.randrange(len(wording))
            doc += wording[at : at + rng.randint(1, 12)] if rng.random() < 0.6 else [
                rng.choice([*words, b"zzz"])
            ]
        hits, runs = license_scan.match(doc, licenses)
        want = [
            (t, i)
            for t, (kind, wording) in enumerate(rows)
            if kind != "text"
            for i in range(len(doc))
            if doc[i : i + len(wording)] == wording
        ]
        assert sorted(hits) == want

        def known(part):
            return any(
                w[i : i + len(part)] == part for _, w in rows for i in range(len(w) - len(part) + 1)
            )

        longest = []
        for end in range(len(doc)):
            size = 0
            while size <= end and known(doc[end - size : end + 1]):
                size += 1
            longest.append(size)
        maximal = [
            (end - size + 1, size)
            for end, size in enumerate(longest)
            if size >= license_scan.MIN_RUN and (longest[end + 1 : end + 2] != [size + 1])
        ]
        assert sorted((a, size) for a, size, _ in runs) == maximal


def test_whole_license_is_covered(spark):
    text = "Copyright (c) 2001 Nobody\n\n" + TEXTS["mit"][0] + " Something else follows here."
    half = " ".join(TEXTS["isc"][0].split()[:8])
    rows = spark.createDataFrame([(1, text), (2, half), (3, "Under the MIT license.")], "doc_id long, text string")
    found = {r.doc_id: r for r in license_scan.scan_licenses(rows).collect()}
    assert found[1].labels == "mit" and found[1].score == 1.0 and found[1].base_labels == ""
    assert found[2].labels == "" and 0 < found[2].score < 0.6
    assert (found[3].base_labels, found[3].first_word, found[3].n_base) == ("mit", 0, 1)


# --- shards


def least_capacity(sizes: list[int], shards: int) -> int:
    def fits(capacity):
        used, at = 1, 0
        for size in sizes:
            if size > capacity:
                return False
            if at + size > capacity:
                used, at = used + 1, 0
            at += size
        return used <= shards

    low, high = 0, sum(sizes)
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if fits(middle) else (middle + 1, high)
    return low


@pytest.mark.parametrize("shards", [1, 3, 16])
def test_smallest_capacity(docs, texts, shards):
    rows = sharding.shard_documents(docs, shards).collect()
    groups: Counter = Counter()
    for text in texts.values():
        key = int(hashlib.md5(text.encode()).hexdigest()[:15], 16)
        groups[key] += len(text.encode()) + 1
    want = least_capacity([groups[k] for k in sorted(groups)], shards)
    filled: Counter = Counter()
    for r in rows:
        assert r.text_crc32 == zlib.crc32(texts[r.doc_id].encode())
        filled[r.shard] += r.size
    assert max(filled.values()) == want and len(rows) == len(texts)


def test_no_shard_stays_empty_beside_a_large_group(spark):
    rng = random.Random(8)
    rows = [(i, f"own text {i} " + "x" * rng.randrange(120)) for i in range(700)]
    rows += [(1_000 + i, "the same text again and again " * 4) for i in range(300)]
    out = sharding.shard_documents(spark.createDataFrame(rows, "doc_id long, text string"), 16).collect()
    filled: Counter = Counter()
    for r in out:
        filled[r.shard] += r.size
    group = 300 * (len("the same text again and again ") * 4 + 1)
    rest = sum(filled.values()) - group
    assert len(filled) == 16 and max(filled.values()) < group + rest / 8
    # The shard before the group ends where the group starts, however full it is.
    assert min(filled.values()) > 0 and sorted(filled.values())[1] > 0.8 * rest / 16
    few = spark.createDataFrame([(i, "a" * (1 + 30 * (i == 3))) for i in range(5)], "doc_id long, text string")
    assert {r.shard for r in sharding.shard_documents(few, 16).collect()} <= set(range(16))


def test_capacity_with_a_hot_group(spark):
    rng = random.Random(3)
    rows = [(rng.randrange(1 << 60), rng.randint(1, 400)) for _ in range(3000)] + [(77, 9)] * 30_000
    frame = stored(spark.createDataFrame(rows, "hash long, size long"), "hot")
    groups: Counter = Counter()
    for key, size in rows:
        groups[key] += size
    ordered = [groups[k] for k in sorted(groups)]
    for shards in (2, 7, 40):
        assert sharding.cut_hashes(frame, shards)[1] == least_capacity(ordered, shards)


# --- mixing


def test_mix_follows_targets(spark, docs, texts):
    rows = mixing.mix_sources(docs).collect()
    again = mixing.mix_sources(docs.repartition(5)).collect()
    assert sorted((r.doc_id, r.taken) for r in rows) == sorted((r.doc_id, r.taken) for r in again)
    source = {r.doc_id: r.source for r in docs.select("doc_id", "source").collect()}
    sizes = {d: len(WORD.findall(t)) for d, t in texts.items()}
    total: Counter = Counter()
    longest: Counter = Counter()
    for d, n in sizes.items():
        total[source[d]] += n
        longest[source[d]] = max(longest[source[d]], n)
    names = sorted(total, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    capped: set = set()
    while True:
        left = 1.5 * sum(total.values()) - sum(2 * total[s] for s in capped)
        weights = sum(weight[s] for s in names if s not in capped)
        target = {s: 2 * total[s] if s in capped else left * weight[s] / weights for s in names}
        above = {s for s in names if target[s] > 2 * total[s]}
        if not above:
            break
        capped |= above
    taken: Counter = Counter()
    for r in rows:
        assert r.size == sizes[r.doc_id] and r.source_size == total[source[r.doc_id]]
        assert abs(r.target - target[source[r.doc_id]]) < 1e-6 * r.target
        assert r.taken in (0, r.size, 2 * r.size)
        taken[source[r.doc_id]] += r.taken
    assert all(abs(taken[s] - target[s]) <= longest[s] for s in names)
    assert sum(taken.values()) <= 1.5 * sum(total.values())


# --- near duplicates


def jaccard_components(texts: dict, width: int, percent: int) -> dict:
    sets = {d: near_dedup.shingle_set(near_dedup.words_of(t.encode()), width) for d, t in texts.items()}
    parent = {d: d for d in texts}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    ids = sorted(texts)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {d: root(d) for d in texts}


def test_near_duplicates_of_edited_copies(spark):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(800)]
    texts: dict[int, str] = {}
    boilerplate = [rng.choice(words) for _ in range(60)]
    for group in range(12):
        base = [rng.choice(words) for _ in range(rng.choice([3, 6, 9, 30, 120, 300]))]
        for _ in range(rng.choice([1, 2, 5, 40])):
            copy = [rng.choice(words) if rng.random() < 0.03 else w for w in base]
            texts[len(texts)] = " ".join(copy + (boilerplate if group % 3 == 0 else []))
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    for width, percent in ((3, 85), (5, 80)):
        want = jaccard_components(texts, width, percent)
        found = near_dedup.near_duplicates(frame, width, percent).collect()
        assert {r.doc_id: r.component_id for r in found} == want
        assert all(r.kept == (r.doc_id == r.component_id) for r in found)


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)] + [(200, 300), (7, 7)]
    rng = random.Random(2)
    rng.shuffle(edges)
    found = components(spark.createDataFrame(edges, "u long, v long"))
    got = {r.node: r.component for r in found.collect()}
    assert got == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(60)} | {200: 200, 300: 200}


# --- repeated passages


def test_repeated_passages_go(spark):
    rng = random.Random(11)
    words = [f"v{i}" for i in range(5000)]

    def prose(n):
        return [rng.choice(words) for _ in range(n)]

    passage, clean = prose(60), {}
    rows = []
    for d in range(60):
        own = prose(150)
        clean[d] = d % 3 != 0
        if not clean[d]:
            at = rng.randrange(150)
            own[at:at] = passage
        rows.append((d, " ".join(own) + "\n"))
    out = substring_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"))
    windows: dict = defaultdict(set)
    for r in out.collect():
        original = rows[r.doc_id][1]
        rebuilt, at = "", 0
        for span in r.removed:
            rebuilt += original[at : span.start]
            at = span.start + span.length
        assert rebuilt + original[at:] == r.text
        if clean[r.doc_id] or r.doc_id == 0:
            assert r.text == original and r.repeats_of == []
        else:
            # Borders near an end of the passage may first agree in a later document.
            assert r.repeats_of[0] == 0 and r.removed_words >= 60 - 2 * substring_dedup.WINDOW - 2
        kept = r.text.split()
        for i in range(len(kept) - 49):
            windows[tuple(kept[i : i + 50])].add(r.doc_id)
    assert all(len(found) == 1 for found in windows.values())


def test_repeated_lines_of_any_length_go(spark):
    """Lines of 5 to 60 words, some of them again in other documents and beside other lines."""
    rng = random.Random(12)
    vocabulary = [f"w{i}" if i % 3 else f"Wé{i}" for i in range(4000)]

    def line(n):
        return " ".join(rng.choice(vocabulary) for _ in range(n))

    shared = [line(n) for n in range(5, 61, 5)] + ["one two three four"]
    rows = []
    for d in range(40):
        lines = [line(rng.randint(5, 60)) for _ in range(8)]
        for _ in range(3):
            again = rng.choice(shared)
            lines.insert(rng.randrange(len(lines)), again if d % 2 else f"  {again.replace(' ', '   ').upper()} ")
        rows.append((d, "\n".join(lines)))
    found = {r.doc_id: r for r in substring_dedup.remove_repeats(
        spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()}
    seen: dict = {}
    for d, text in rows:
        at, want, kept = 0, [], ""
        for part in text.splitlines(keepends=True):
            key = tuple(part.encode().lower().split())
            if len(key) >= substring_dedup.LINE_WORDS and key in seen:
                if want and want[-1][0] + want[-1][1] == at:
                    want[-1] = (want[-1][0], want[-1][1] + len(part))
                else:
                    want.append((at, len(part)))
            else:
                seen[key] = d
                kept += part
            at += len(part)
        assert [tuple(s) for s in found[d].removed] == want and found[d].text == kept


def test_equal_texts_of_two_ids_leave_one(spark):
    text = "a b c d e f\n" + " ".join(f"q{i}" for i in range(90)) + "\nlast line\n"
    rows = [(4, text), (9, text), (None, text), (9, text)]
    found = substring_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((str(r.doc_id), r.text) for r in found) == sorted(
        [("4", text), ("9", ""), ("9", ""), ("None", "")])


# --- packing


def test_pieces_are_the_tokens(docs, texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    rows = packing.pieces(docs, tokenizer_path()).collect()
    pieces: dict = defaultdict(list)
    for r in rows:
        pieces[r.id].append(r)
    for d, text in texts.items():
        ids = np.array(tokenizer.encode(text, add_special_tokens=False).ids + [0], "<u4")
        at = 0
        for number, r in enumerate(sorted(pieces[d], key=lambda r: r.piece)):
            assert (r.piece, r.start) == (number, at) and (number == 0 or r.length == 2048)
            assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)


@pytest.mark.parametrize("text", ["", " a  b", "a\n b", "x <|endoftext|> y", " a  b", "it's 12,000 km", "\t", "a \x1cb", "é \U0001f600!"])
def test_tokens_of_odd_texts(text):
    from tokenizers import Tokenizer

    want = Tokenizer.from_file(tokenizer_path()).encode(text, add_special_tokens=False).ids
    assert np.frombuffer(packing.tokenizer(tokenizer_path())(text), "<u4").tolist() == want


def test_sum_of_squares_rule():
    rng = np.random.default_rng(1)
    sizes = rng.integers(1, 20, 300)
    bins, offsets = packing.sum_of_squares(sizes, 20)
    levels: dict[int, int] = {}
    for size, number, offset in zip(sizes.tolist(), bins.tolist(), offsets.tolist()):
        gaps = Counter(20 - level for level in levels.values() if level < 20)

        def squares(gap):
            after = gaps.copy()
            if gap < 20:
                after[gap] -= 1
            if gap - size:
                after[gap - size] += 1
            return sum(n * n for n in after.values())

        best = min(squares(gap) for gap in [*gaps, 20] if gap >= size and (gap == 20 or gaps[gap]))
        assert squares(20 - offset) == best and levels.get(number, 0) == offset
        levels[number] = offset + size
    assert max(levels.values()) <= 20


def test_few_sequences(docs):
    parts = stored(packing.pieces(docs, tokenizer_path()), "pieces")
    packed = packing.pack(parts).collect()
    least = -(-sum(r.length for r in packed) // 2048)
    assert len({r.sequence_id for r in packed}) <= 1.05 * least


# --- quality classifier


def test_estimated_accuracies():
    rng = np.random.default_rng(4)
    truth = rng.random(20_000) < 0.7
    accuracies, votes = [0.95, 0.8, 0.7, 0.65], []
    for accuracy in accuracies:
        right = rng.random(len(truth)) < accuracy
        heard = rng.random(len(truth)) < 0.6
        votes.append(np.where(heard, np.where(right == truth, 1, -1), 0))
    patterns = Counter(map(tuple, np.array(votes).T.tolist()))
    model = quality_model.estimate(sorted(patterns.items()), {})
    assert np.allclose(model["accuracy"], accuracies, atol=0.04)


def test_held_out_accuracy(spark):
    folder = SMALL.replace("0.001", "0.1")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    learned = labels.where("doc_id % 5 <> 0")
    model = quality_model.fit(docs, learned)
    judged = quality_model.classify(docs.select("doc_id", "text"), model).drop("text")
    rows = judged.join(labels.where("doc_id % 5 = 0"), "doc_id").collect()
    clean = [r.kept for r in rows if r.quality == 1 and r.toxic == 0]
    bad = [r.kept for r in rows if r.quality == 0 or r.toxic == 1]
    assert len(clean) > 300 and np.mean(clean) > 0.97
    assert len(bad) > 50 and np.mean(bad) < 0.1
    # The same from human labels alone, to measure what the weak labellers add.
    alone = {aspect: {"human": group["human"]} for aspect, group in quality_model.LABELLERS.items()}
    few = learned.where("doc_id % 50 = 1")
    results = {}
    for name, labellers in (("all", None), ("human", alone)):
        fitted = quality_model.fit(docs, few, labellers=labellers)
        found = quality_model.classify(docs.select("doc_id", "text"), fitted).drop("text")
        rows = found.join(labels.where("doc_id % 5 = 0"), "doc_id").collect()
        results[name] = (
            np.mean([r.kept for r in rows if r.quality == 1 and r.toxic == 0]),
            np.mean([not r.kept for r in rows if r.quality == 0 or r.toxic == 1]),
        )
    print("kept of the clean, rejected of the bad:", results)
    assert results["all"] != results["human"]
    assert results["all"][0] > 0.9 and results["all"][1] > results["human"][1] + 0.1
