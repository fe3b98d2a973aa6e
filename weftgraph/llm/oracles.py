"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

# Five best integer inner products by brute force.
NEAREST = """
WITH v AS (
  SELECT row_number() OVER () AS row_id, vec_id,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
), s AS (
  SELECT q.row_id AS query, q.vec_id AS query_id, c.row_id, c.vec_id,
    list_inner_product(q.v, c.v)::BIGINT AS score
  FROM v q JOIN v c ON q.row_id <> c.row_id WHERE q.vec_id % 50 = 0
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, vec_id, row_id)::INTEGER AS rank
  FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""

PERSPECTIVES = """
WITH t AS (
  SELECT row_number() OVER () AS row_id, conv_id, turn, role, coalesce(text, '') AS raw,
    regexp_replace(coalesce(text, ''), '<(\\\\*)\\|', '<\\\\\\1|', 'g') AS body,
    replace(replace(replace(role, chr(92), chr(92) || chr(92)), '|', chr(92) || '|'), chr(10), chr(92) || 'n') AS name
  FROM conversations
), p AS (
  SELECT *, row_number() OVER (
    PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, raw, row_id) - 1 AS place FROM t
), s AS (
  SELECT DISTINCT conv_id, role AS speaker FROM t
  WHERE role IS NOT NULL AND role NOT IN ('system', 'tool')
), seen AS (
  SELECT p.conv_id, speaker, place, body, role IS NOT DISTINCT FROM speaker AS mine,
    CASE WHEN role IS NOT DISTINCT FROM speaker THEN '<|assistant|>' || chr(10)
         WHEN role IN ('system', 'tool') THEN '<|' || role || '|>' || chr(10)
         WHEN role IS NULL THEN '<|user|>' || chr(10)
         ELSE '<|user name=' || name || '|>' || chr(10) END AS head,
    '<|end|>' || chr(10) AS tail
  FROM p JOIN s ON p.conv_id IS NOT DISTINCT FROM s.conv_id
), placed AS (
  SELECT *, head || body || tail AS piece,
    sum(length(head || body || tail)) OVER (
      PARTITION BY conv_id, speaker ORDER BY place ROWS UNBOUNDED PRECEDING) - length(body || tail) AS start
  FROM seen
)
SELECT conv_id, speaker, (place // 256)::INTEGER AS part, count(*)::INTEGER AS n_turns,
  min(start - length(head))::BIGINT AS text_start, string_agg(piece, '' ORDER BY place) AS text,
  coalesce(string_agg(start::BIGINT || ':' || length(body || tail), ',' ORDER BY start)
    FILTER (WHERE mine), '') AS mask
FROM placed GROUP BY conv_id, speaker, place // 256
"""

# Exact similarity of all pairs that share a shingle, then reachability.
NEAR_DUPLICATES = """
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS words
  FROM documents
), sh AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) = 0 THEN []
    WHEN len(words) < 3 THEN [array_to_string(words, ' ')]
    ELSE list_transform(range(1, len(words) - 1),
      lambda i: words[i] || ' ' || words[i + 1] || ' ' || words[i + 2]) END) AS s
  FROM w
), n AS (
  SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id
), pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
  FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
  WHERE 100 * c >= 85 * (x.n + y.n - c)
), both_ways AS (
  SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach AS (
  SELECT a AS node, b AS other FROM both_ways
  UNION
  SELECT r.node, e.b FROM reach r JOIN both_ways e ON e.a = r.other
), least AS (
  SELECT node, min(other) AS m FROM reach GROUP BY node
)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles,
  least(w.doc_id, coalesce(m, w.doc_id)) AS component_id,
  w.doc_id = least(w.doc_id, coalesce(m, w.doc_id)) AS kept
FROM w LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN least l ON l.node = w.doc_id
"""

# Written out, so that the rules are checked against something of their own.
_BITS = """(CASE WHEN n_words < 50 THEN 1 ELSE 0 END)
    | (CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END)
    | (CASE WHEN 100 * n_symbols > 5 * word_chars THEN 4 ELSE 0 END)
    | (CASE WHEN 2 * n_capitals > n_letters THEN 8 ELSE 0 END)
    | (CASE WHEN word_chars < 2 * n_words OR word_chars > 15 * n_words THEN 16 ELSE 0 END)
    | (CASE WHEN 10 * n_dup_lines > 3 * n_lines THEN 32 ELSE 0 END)"""

RULE_LEDGER = f"""
WITH w AS (
  SELECT doc_id, coalesce(text, '') AS text,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)),
      lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines
  FROM documents
), windows AS (
  SELECT doc_id, i, [words[i], words[i + 1], words[i + 2]] AS s
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM w WHERE len(words) >= 3)
), again AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, s) AS c FROM windows)
  WHERE c > 1
), repeated AS (
  SELECT doc_id, count(DISTINCT i + k) AS n FROM again, (SELECT unnest([0, 1, 2]) AS k) GROUP BY doc_id
), m AS (
  SELECT w.doc_id, len(words)::BIGINT AS n_words,
    length(regexp_replace(text, '[\\x20\\x09-\\x0D]', '', 'g'))::BIGINT AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    len(lines)::BIGINT AS n_lines,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
    coalesce(repeated.n, 0)::BIGINT AS n_repeat_words,
    length(regexp_replace(text, '[^A-Za-z]', '', 'g'))::BIGINT AS n_letters,
    length(regexp_replace(text, '[^A-Z]', '', 'g'))::BIGINT AS n_capitals
  FROM w LEFT JOIN repeated ON repeated.doc_id = w.doc_id
), bits AS (
  SELECT *, ({_BITS})::BIGINT AS fail_bits FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  (fail_bits & 3) <> 0 AS base_failed,
  (fail_bits & 31) = 0 AS kept, fail_bits
FROM bits
"""

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

# Every kept term against every pair of sources of its language.
SOURCE_DIVERGENCE = f"""
WITH d AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    {_LOWER.format("coalesce(text, '')")} AS text
  FROM documents
), t AS (
  SELECT id, lang, source,
    unnest(regexp_extract_all(text, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
  FROM d
), kept AS (
  SELECT lang, term, count(*)::HUGEINT AS total FROM t GROUP BY lang, term
  HAVING count(DISTINCT id) >= 10
), g AS (
  SELECT DISTINCT lang, source FROM d
), v AS (
  SELECT lang, count(*)::HUGEINT AS v FROM kept GROUP BY lang
), c AS (
  SELECT lang, source, term, count(*)::HUGEINT AS n FROM t JOIN kept USING (lang, term)
  GROUP BY lang, source, term
), sizes AS (
  SELECT g.lang, g.source, coalesce(sum(c.n), 0)::HUGEINT AS size
  FROM g LEFT JOIN c USING (lang, source) GROUP BY g.lang, g.source
), shares AS (
  SELECT s.lang, s.source, k.term, coalesce(c.n, 0) AS n,
    1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 2)) // (s.size + 2 * v.v) AS p
  FROM sizes s JOIN kept k ON k.lang = s.lang JOIN v ON v.lang = s.lang
  LEFT JOIN c ON c.lang = s.lang AND c.source = s.source AND c.term = k.term
), whole AS (
  SELECT lang, sum(size) AS size FROM sizes GROUP BY lang
), own AS (
  SELECT k.lang, k.term,
    1 + (1000000000::HUGEINT * (k.total + 2)) // (w.size + 2 * v.v) AS q
  FROM kept k JOIN whole w USING (lang) JOIN v USING (lang)
), apart AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
  GROUP BY ALL
), pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN apart x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
), terms AS (
  SELECT s.lang, s.source, 'term' AS part, s.term AS item,
    (((p - q) * (p - q)) // (p + q))::BIGINT AS value
  FROM shares s JOIN own USING (lang, term) WHERE n > 0 AND p > q
)
SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms)
QUALIFY part = 'pair' OR rank <= 10
"""

# All phrases of one to four words counted outright.
COLLOCATIONS = f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    {_LOWER.format("coalesce(text, '')")}, '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents
), w AS (
  SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS words FROM pieces
), grams AS (
  SELECT lang, k AS size, unnest(list_transform(range(1, len(words) - k + 2),
    lambda i: array_to_string(words[i : i + k - 1], ' '))) AS phrase
  FROM w, (SELECT unnest([1, 2, 3, 4])::INTEGER AS k)
), f AS (
  SELECT lang, size, phrase, count(*)::HUGEINT AS n FROM grams GROUP BY ALL
), total AS (
  SELECT lang, sum(n)::BIGINT AS n FROM f WHERE size = 1 GROUP BY lang
), candidates AS (
  SELECT lang, size, phrase, n AS a, string_split(phrase, ' ') AS words FROM f WHERE size > 1 AND n >= 30
), cuts AS (
  SELECT lang, size, phrase, a, k, array_to_string(words[1 : k], ' ') AS head,
    array_to_string(words[k + 1 :], ' ') AS rest
  FROM candidates, (SELECT unnest([1, 2, 3]) AS k) WHERE k < size
), scored AS (
  SELECT c.lang, c.size, c.phrase, c.a, l.n AS l, r.n AS r, (2000000 * c.a) // (l.n + r.n) AS score
  FROM cuts c JOIN f l ON l.lang = c.lang AND l.phrase = c.head AND l.size = c.k
  JOIN f r ON r.lang = c.lang AND r.phrase = c.rest AND r.size = c.size - c.k
  QUALIFY row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY score, c.k) = 1
), parts AS (
  SELECT lang, a AS longer, array_to_string(words[i : i + s - 1], ' ') AS phrase
  FROM candidates, (SELECT unnest([2, 3]) AS s), (SELECT unnest([1, 2, 3]) AS i)
  WHERE s < size AND i + s - 1 <= size
), longest AS (
  SELECT lang, phrase, max(longer) AS longer FROM parts GROUP BY lang, phrase
)
SELECT s.lang, row_number() OVER (
    PARTITION BY s.lang ORDER BY score DESC, s.a DESC, s.phrase)::BIGINT AS rank,
  s.phrase, s.a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, total.n, score::BIGINT AS score
FROM scored s JOIN total ON total.lang = s.lang
LEFT JOIN longest x ON x.lang = s.lang AND x.phrase = s.phrase
WHERE longer IS NULL OR 100 * longer < 80 * s.a
QUALIFY rank <= 2000
"""

# The longest of the five rules, else what the pages of host, domain and suffix say.
_TWO = (
    "'ac.uk', 'co.uk', 'gov.uk', 'org.uk', 'com.au', 'net.au', 'org.au', 'co.nz', 'co.jp', 'ne.jp', "
    "'or.jp', 'com.br', 'com.cn', 'com.tr', 'com.mx', 'co.in', 'co.kr', 'co.za'"
)


def _level(name: str, children: str, parents: str, up: str, keys: str) -> str:
    return f"""{name}_s AS (
  SELECT {up}, sum(n)::DOUBLE AS pn, sum(bad)::DOUBLE AS pk, count(*)::DOUBLE - 1 AS others,
    sum(n::DOUBLE * n) AS squares, sum(bad::DOUBLE * bad / n) AS within
  FROM {children} GROUP BY {up}
), {name}_v AS (
  SELECT *, pk / pn AS p, within - pk * pk / pn - (pk / pn) * (1 - pk / pn) * others AS above,
    (pk / pn) * (1 - pk / pn) * (pn - squares / pn - others) AS below
  FROM {name}_s
), {name}_p AS (
  SELECT v.*, mean AS prior, CASE WHEN others < 1 OR below <= 1e-9 THEN 4.0 WHEN above <= 0 THEN 1000.0
    ELSE greatest(1.0, least(1000.0, below / greatest(above, 1e-12) - 1)) END AS strength
  FROM {name}_v v JOIN {parents} USING ({up})
), {name} AS (
  SELECT {keys}, (strength * prior + bad) / (strength + n) AS mean, strength + n AS weight
  FROM {children} JOIN {name}_p USING ({up})
)"""


URLS = f"""
WITH u AS (
  SELECT page_id, html,
    {_LOWER.format("coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), '')")} AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path
  FROM pages
), s AS (
  SELECT *, regexp_replace(regexp_replace(host, '^.*@|:[0-9]*$', '', 'g'), '\\.$', '') AS site,
    string_split(site, '.') AS parts, array_to_string(parts[-2:], '.') AS two,
    regexp_matches(site, '^[0-9]+\\.[0-9]+\\.[0-9]+\\.[0-9]+$') OR len(parts) < 2 AS whole
  FROM u
), h AS (
  SELECT page_id, host, path,
    CASE WHEN whole THEN site WHEN two IN ({_TWO}) THEN array_to_string(parts[-3:], '.') ELSE two END AS domain,
    CASE WHEN whole THEN '' WHEN two IN ({_TWO}) THEN two ELSE parts[-1] END AS suffix,
    CASE WHEN ends_with('.' || host, '.example.org') AND starts_with(path, '/en/1') THEN 'example.org/en/1'
         WHEN ends_with('.' || host, '.example.org') AND starts_with(path, '/es/') THEN 'example.org/es/'
         WHEN ends_with('.' || host, '.com') AND starts_with(path, '/fr/') THEN 'com/fr/'
         WHEN ends_with('.' || host, '.com') AND starts_with(path, '/de/') THEN 'com/de/'
         WHEN ends_with('.' || host, '.org') AND starts_with(path, '/') THEN 'org/' END AS rule,
    regexp_replace(html, '(?s)<script.*?</script>|<style.*?</style>|<[^>]*>|&[a-z]+;', ' ', 'g') AS text
  FROM s
), o AS (
  SELECT *, length(regexp_replace(text, '[\\x20\\x09-\\x0D]', '', 'g')) AS full_,
    length(regexp_replace(text, '[^#*$%|]', '', 'g')) AS symbols,
    CASE WHEN regexp_matches(host, '(^|[^a-z0-9])(ads|bet|casino|cheap|viagra|lottery|payday|pills|poker|porn|replica|spam|track|warez|xxx)([^a-z0-9]|$)') THEN 1
         WHEN full_ = 0 OR 100 * symbols > 5 * full_ THEN 1 WHEN full_ IS NOT NULL THEN 0 END AS bad
  FROM h
), hosts AS (
  SELECT suffix, domain, host, count(*) AS n, sum(bad) AS bad FROM o WHERE bad IS NOT NULL GROUP BY ALL
), domains AS (
  SELECT suffix, domain, sum(n) AS n, sum(bad) AS bad FROM hosts GROUP BY ALL
), suffixes AS (
  SELECT 0 AS every, suffix, sum(n) AS n, sum(bad) AS bad FROM domains GROUP BY ALL
), everything AS (
  SELECT 0 AS every, (sum(bad) + 1) / (sum(n) + 2) AS mean FROM suffixes
), {_level("top", "suffixes", "everything", "every", "suffix")}
, {_level("middle", "domains", "top", "suffix", "suffix, domain")}
, {_level("low", "hosts", "middle", "suffix, domain", "host")}
, known AS (
  SELECT o.*, coalesce(l.mean, m.mean, t.mean) AS mean, coalesce(l.weight, m.weight, t.weight) AS weight
  FROM o LEFT JOIN low l ON l.host = o.host
  LEFT JOIN middle m ON m.suffix = o.suffix AND m.domain = o.domain
  LEFT JOIN top t ON t.suffix = o.suffix
)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
       WHEN mean - 1.645 * sqrt(mean * (1 - mean) / (weight + 1)) > 0.25 THEN 'block'
       ELSE 'allow' END AS verdict
FROM known
"""

ORACLES = {
    "op3_nearest_vectors": NEAREST,
    "op4_perspectives": PERSPECTIVES,
    "op7_near_duplicates": NEAR_DUPLICATES,
    "op10_rule_ledger": RULE_LEDGER,
    "op11_source_divergence": SOURCE_DIVERGENCE,
    "op12_collocations": COLLOCATIONS,
    "op13_url_verdicts": URLS,
}
