"""Source divergence, collocations and URL verdicts against plain Python, and on odd rows."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pytest

from weftgraph.llm import collocations, source_audit, url_filter

CLASH = "doc_id long, text string, lang string, source string, term string, value string, rank string, phrase string, n string"


def frame(spark, rows):
    return spark.createDataFrame([(i, *r, "z", "z", "z", "z", "z") for i, r in enumerate(rows)], CLASH)


@pytest.fixture(scope="module")
def odd_rows():
    rng = random.Random(4)
    words = ["alpha", "Beta", "gamma", "ßé", "delta", "x1y"]
    rows = [
        (" ".join(rng.choice(words) for _ in range(rng.randint(0, 40))), rng.choice(["en", "de"]), f"s{rng.randrange(4)}")
        for _ in range(60)
    ]
    rows += [rows[0], rows[0], (None, "en", "s9"), ("", "en", None), (None, None, None), ("solo words", "fr", "one")]
    rows += [("Long " * 20_000 + "tail", "en", "s1"), ("ÀB-c.d\x00e", None, "s1")]
    return rows


def shares(counts, total, n_terms):
    return {t: 1 + 1_000_000_000 * (counts[t] + 2) // (total + 2 * n_terms) for t in counts}


def divergence(rows, least, best):
    docs, count, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        terms = [
            "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)
            for t in re.findall(r"[A-Za-z\u0080-\U0010ffff]+", text or "")
        ]
        docs[lang].update(set(terms))
        count[lang, source].update(terms)
    out = []
    for lang, source in groups:
        kept = sorted((t for t, n in docs[lang].items() if n >= least), key=str.encode)
        own = {s: {t: count[lang, s][t] for t in kept} for l, s in groups if l == lang}
        p = {s: shares(c, sum(c.values()), len(kept)) for s, c in own.items()}
        whole = {t: sum(c[t] for c in own.values()) for t in kept}
        q = shares(whole, sum(whole.values()), len(kept))

        def apart(a, b):
            return (a - b) ** 2 // (a + b)

        pairs = [(s, sum(apart(p[source][t], p[s][t]) for t in kept)) for s in own if s != source]
        terms = [
            (t, apart(p[source][t], q[t])) for t in kept if own[source][t] and p[source][t] > q[t]
        ]
        for part, items in (("pair", pairs), ("term", terms)):
            items.sort(key=lambda i: (-i[1], i[0].encode()))
            out += [
                (lang, source, part, item, value, rank + 1)
                for rank, (item, value) in enumerate(items)
                if part == "pair" or rank < best
            ]
    return sorted(out)


def test_divergence_matches_plain_counts(spark, odd_rows, monkeypatch):
    monkeypatch.setattr(source_audit, "PAGE", 2)
    docs = frame(spark, odd_rows).repartition(5)
    for least, best in ((1, 3), (10, 2)):
        found = source_audit.source_divergence(docs, least, best, block_terms=60).collect()
        assert sorted(tuple(r) for r in found) == divergence(odd_rows, least, best)
    assert source_audit.source_divergence(docs.where("false")).collect() == []


def phrases(rows, top, least, share):
    f, total = defaultdict(Counter), Counter()
    for text, lang, _ in rows:
        lang = "und" if lang is None else lang
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\n\x0b\x0c\r]", low):
            words = re.findall(r"[^ \t]+", piece)
            total[lang] += len(words)
            for size in range(1, 5):
                f[lang].update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    out = []
    for lang, counts in f.items():
        candidates = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        longest = Counter()
        for p, a in candidates.items():
            for size in range(2, len(p)):
                for i in range(len(p) - size + 1):
                    longest[p[i : i + size]] = max(longest[p[i : i + size]], a)
        scored = []
        for p, a in candidates.items():
            if p in longest and 100 * longest[p] >= share * a:
                continue
            cuts = [(2_000_000 * a // (counts[p[:k]] + counts[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            scored.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(scored)[:top]):
            out.append((lang, rank + 1, p.decode(), -a, left, right, total[lang], -score))
    return sorted(out)


def test_phrases_match_plain_counts(spark, odd_rows):
    rng = random.Random(5)
    fixed = ["new york city hall", "ad hoc", "in spite of", "as well as"]
    rows = list(odd_rows)
    for _ in range(80):
        parts = [rng.choice([*fixed, "w", "X", "y", "z", "of", "New"]) for _ in range(30)]
        rows.append(("".join(p + rng.choice([" ", "\t ", " ", ". ", "\n"]) for p in parts), rng.choice(["en", None]), "s"))
    docs = frame(spark, rows).repartition(4)
    # A first frontier of one or two branches takes several rounds to settle the same phrases.
    for top, least, first in ((6, 3, 1), (3, 5, 2), (2_000, 3, 8_000)):
        found = collocations.collocations(docs, top, least, first=first, block_words=150).collect()
        assert sorted(tuple(r) for r in found) == phrases(rows, top, least, 80)
    assert collocations.collocations(docs.where("false")).collect() == []


RULES = [("org/", "allow"), ("example.org/es/", "block"), ("com/fr/", "allow")]


def test_urls_and_rules(spark):
    schema = "page_id long, url string, html string, host string, path string, rule string, n string"
    urls = [
        "http://Blog.Example.ORG/es/1?x#y", "https://example.org", "http://badexample.org/es/", "ftp://a.COM/fr/",
        "http://com/fr/x", "no scheme/fr/", None, "", "http://u@h.co.uk:80/p", "http://1.2.3.4/a", "x://y?://z/q", "http:///p",
        "http://" + "a." * 3_000 + "net/" + "p" * 50_000,
    ]
    pages = spark.createDataFrame([(i, u, None, "z", "z", "z", "z") for i, u in enumerate(urls + urls[:1])], schema)
    none = spark.createDataFrame([], "host string, bad int")
    found = [r for r in sorted(url_filter.judge_urls(pages, none, RULES).collect(), key=lambda r: r.page_id)]
    assert [(r.host, r.path, r.rule, r.verdict) for r in found[:12]] == [
        ("blog.example.org", "/es/1", "example.org/es/", "block"), ("example.org", "", None, "allow"),
        ("badexample.org", "/es/", "org/", "allow"), ("a.com", "/fr/", "com/fr/", "allow"),
        ("com", "/fr/x", "com/fr/", "allow"), ("", "", None, "allow"), ("", "", None, "allow"), ("", "", None, "allow"),
        ("u@h.co.uk:80", "/p", None, "allow"), ("1.2.3.4", "/a", None, "allow"), ("y", "", None, "allow"),
        ("", "/p", None, "allow"),
    ]
    assert len(found[12].path) == 50_001 and found[13][1:] == found[0][1:]
    assert url_filter.judge_urls(pages.where("false"), none, RULES).collect() == []
    site = spark.createDataFrame([("u@h.co.uk:80",), ("1.2.3.4",), ("a.b.c.",), ("one",)], "host string")
    domain, suffix = url_filter.registered(site.host)
    assert [tuple(r) for r in site.select(domain, suffix).collect()] == [
        ("h.co.uk", "co.uk"), ("1.2.3.4", ""), ("b.c", "c"), ("one", "")]


def test_reputations_shrink(spark):
    """A host with many bad pages is blocked, one with a single bad page is not, unless its domain is bad."""
    outcomes = [("good.a.net", 0)] * 200 + [("one.a.net", 1)] + [("bad.a.net", 1)] * 40
    outcomes += [(f"h{i}.spam.net", 1) for i in range(40)] + [("x.a.net", None)]
    table = spark.createDataFrame(outcomes, "host string, bad int")
    low, middle, top = (
        {tuple(r)[:-2]: r.mean for r in level.collect()} for level in url_filter.reputations(table)
    )
    assert low["bad.a.net",] > 0.8 and low["good.a.net",] < 0.1 and 0.1 < low["one.a.net",] < low["bad.a.net",]
    assert middle["net", "spam.net"] > 0.8 > middle["net", "a.net"] and 0 < top["net",] < 1
    urls = ["good.a.net", "one.a.net", "bad.a.net", "h1.spam.net", "new.spam.net", "new.a.net", "else.where"]
    pages = spark.createDataFrame([(i, f"http://{h}/") for i, h in enumerate(urls)], "page_id long, url string")
    found = {r.host: (r.verdict, r.bad_bound) for r in url_filter.judge_urls(pages, table, []).collect()}
    assert {h for h, (v, _) in found.items() if v == "block"} == {"bad.a.net", "h1.spam.net", "new.spam.net"}
    assert found["else.where"] == ("allow", None)
