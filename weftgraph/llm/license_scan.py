"""License scan with a generalised suffix automaton of license words.

All license wording goes into one automaton, word by word. A document is streamed
through it once; after each word the automaton knows the longest run of words,
ending there, that also stands in some license (the matching statistics). Phrases
and notices are seen when their state lies on the suffix path of the current one.
Longer runs are chained per license text into spans that cover it.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftgraph.llm.common import map_rows, utf8
from weftgraph.llm.license_texts import NOTICES, PHRASES, TEXTS

MIN_RUN = 4  # words of a run that may join a chain
MAX_GAP = 12  # words between two runs of a chain
COVER = 0.6  # share of a long text that a chain must cover

# Bytes that are no word characters become spaces; A-Z become a-z.
_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
    for c in range(256)
)


def license_words(text: bytes) -> list[bytes]:
    """The lower-cased words of a text: digits, letters and everything beyond ASCII."""
    return text.translate(_FOLD).split()


@dataclass
class Automaton:
    """Suffix automaton of several word sequences; state 0 is the start."""

    step: list[dict[int, int]] = field(default_factory=lambda: [{}])
    link: list[int] = field(default_factory=lambda: [-1])
    length: list[int] = field(default_factory=lambda: [0])
    # Per state: template to the last word of its first place there.
    ends: list[dict[int, int]] = field(default_factory=lambda: [{}])

    def _state(self, length: int, step: dict[int, int], link: int) -> int:
        self.step.append(step)
        self.link.append(link)
        self.length.append(length)
        self.ends.append({})
        return len(self.step) - 1

    def _split(self, at: int, word: int) -> int:
        """The state reached from ``at`` by ``word``, cut off at the length that fits."""
        to = self.step[at][word]
        if self.length[to] == self.length[at] + 1:
            return to
        part = self._state(self.length[at] + 1, dict(self.step[to]), self.link[to])
        self.ends[part] = dict(self.ends[to])
        self.link[to] = part
        while at >= 0 and self.step[at].get(word) == to:
            self.step[at][word] = part
            at = self.link[at]
        return part

    def add(self, template: int, words: list[int]) -> None:
        last = 0
        for place, word in enumerate(words):
            if word in self.step[last]:
                last = self._split(last, word)
            else:
                new = self._state(self.length[last] + 1, {}, 0)
                at = last
                while at >= 0 and word not in self.step[at]:
                    self.step[at][word] = new
                    at = self.link[at]
                self.link[new] = self._split(at, word) if at >= 0 else 0
                last = new
            at = last
            while at > 0:
                self.ends[at].setdefault(template, place)
                at = self.link[at]

    def find(self, words: list[int]) -> int:
        at = 0
        for word in words:
            at = self.step[at][word]
        return at


@dataclass
class Licenses:
    """The wording in compiled form."""

    names: dict[bytes, int]
    automaton: Automaton
    labels: list[str]
    sizes: list[int]
    kinds: list[str]
    # Per state: (length, template) of each phrase and notice ending there.
    whole: list[list[tuple[int, int]]]


def compile_licenses(phrases: dict, notices: dict, texts: dict) -> Licenses:
    names: dict[bytes, int] = {}
    automaton = Automaton()
    labels, sizes, kinds, rows = [], [], [], []
    for kind, group in (("phrase", phrases), ("notice", notices), ("text", texts)):
        for label, wordings in group.items():
            for wording in wordings:
                row = [names.setdefault(w, len(names)) for w in license_words(wording.encode())]
                automaton.add(len(rows), row)
                labels.append(label)
                sizes.append(len(row))
                kinds.append(kind)
                rows.append(row)
    at_state: dict[int, list[tuple[int, int]]] = {}
    for template, row in enumerate(rows):
        if kinds[template] != "text":
            at_state.setdefault(automaton.find(row), []).append((len(row), template))
    whole = []
    for state in range(len(automaton.step)):
        found, at = [], state
        while at > 0:
            found += at_state.get(at, ())
            at = automaton.link[at]
        whole.append(found)
    return Licenses(names, automaton, labels, sizes, kinds, whole)


@cache
def standard_licenses() -> Licenses:
    return compile_licenses(PHRASES, NOTICES, TEXTS)


def match(words: list[bytes], licenses: Licenses) -> tuple[list, list]:
    """``(hits, runs)`` of a document.

    Hits are ``(template, first word)`` of phrases and notices. Runs are maximal
    matches of at least ``MIN_RUN`` words as ``(first word, length, state)``.
    """
    step, link, lengths = (getattr(licenses.automaton, k) for k in ("step", "link", "length"))
    names, whole = licenses.names.get, licenses.whole
    hits, runs = [], []
    state = size = 0
    for place, word in enumerate(map(names, words)):
        if word is None:
            if size >= MIN_RUN:
                runs.append((place - size, size, state))
            state = size = 0
            continue
        if word not in step[state]:
            if size >= MIN_RUN:
                runs.append((place - size, size, state))
            while state > 0 and word not in step[state]:
                state = link[state]
                size = lengths[state]
        if word in step[state]:
            state = step[state][word]
            size += 1
            for length, template in whole[state]:
                if length <= size:
                    hits.append((template, place - length + 1))
    if size >= MIN_RUN:
        runs.append((len(words) - size, size, state))
    return hits, runs


def chains(runs: list, licenses: Licenses) -> list[tuple[int, int, int, int]]:
    """``(template, first word, last word, template words covered)`` of chained runs.

    Per template, a run joins the open chain if it goes on in the document within
    ``MAX_GAP`` words and further on in the template; otherwise it opens a new one.
    """
    done, open_chains = [], {}
    for first, size, state in runs:
        for template, end in licenses.automaton.ends[state].items():
            if licenses.kinds[template] != "text":
                continue
            chain = open_chains.get(template)
            begin = end - size + 1
            if chain and first - chain[1] <= MAX_GAP + 1 and end > chain[2]:
                overlap = max(0, chain[2] + 1 - begin)
                chain[1], chain[2] = first + size - 1, end
                chain[3] += size - overlap
            else:
                if chain:
                    done.append((template, chain[0], chain[1], chain[3]))
                open_chains[template] = [first, first + size - 1, end, size]
    return done + [(t, c[0], c[1], c[3]) for t, c in open_chains.items()]


def _scan(text: bytes, licenses: Licenses) -> tuple:
    words = license_words(text)
    hits, runs = match(words, licenses)
    base, spans = [], []
    for template, first in hits:
        label, size = licenses.labels[template], licenses.sizes[template]
        spans.append((label, first, first + size - 1, size, size))
        if licenses.kinds[template] == "phrase":
            base.append((first, label))
    best = 1.0 if spans else 0.0
    for template, first, last, covered in chains(runs, licenses):
        size = licenses.sizes[template]
        best = max(best, min(1.0, covered / size))
        if covered >= COVER * size:
            spans.append((licenses.labels[template], first, last, min(covered, size), size))
    spans.sort(key=lambda s: (s[1], s[2], s[0]))
    starts = [first for first, _ in base]
    return (
        len(words),
        len(base),
        min(starts, default=None),
        max(starts, default=None),
        ",".join(sorted({label for _, label in base})),
        ",".join(sorted({span[0] for span in spans})),
        best,
        [dict(zip(("label", "first", "last", "covered", "size"), s)) for s in spans],
    )


SCAN = (
    "n_words long, n_base long, first_word long, last_word long, base_labels string, "
    "labels string, score double, "
    "spans array<struct<label: string, first: long, last: long, covered: long, size: long>>"
)


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document with its licenses and the spans that show them.

    ``base_labels`` come from phrases alone, ``labels`` also from notices and from
    long texts of which a chain covers ``COVER``. ``score`` is the best covered share
    of any wording, 1 for a phrase or notice. A null or empty text has no words, no
    labels and score 0. Repeated rows and null ids are rows like any other; other
    columns are not read. The scan is linear in the text, however long.
    """
    id_type = docs.schema[id_col].dataType.simpleString()

    def scanned(batch: dict) -> list[tuple]:
        licenses = standard_licenses()
        return [(i, *_scan(t, licenses)) for i, t in zip(batch["id"], batch["text"])]

    rows = docs.select(F.col(id_col).alias("id"), utf8(text_col).alias("text"))
    return map_rows(rows, scanned, f"id {id_type}, {SCAN}").withColumnRenamed("id", id_col)
