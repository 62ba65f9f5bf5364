"""DuckDB SQL of the training-data queries that SQL can express.

The others (fingerprints by XXH64, fitted models, tokenizers, sampled
splitters) are held against brute force in ``tests/llm``.
"""

from __future__ import annotations

from logloom.llm import license_scan, secret_scan

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _words(text: str) -> str:
    return (f"regexp_extract_all(translate(coalesce({text}, ''), '{_UPPER}', '{_LOWER}'), "
            r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")


OP1 = f"""
WITH d AS (SELECT doc_id, {_words('text')} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_words('text')} AS w FROM benchmark),
p AS (SELECT DISTINCT item, least(len(w), 10) AS n,
             array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS win
      FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS i
            FROM b WHERE len(w) > 0)),
o AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS win
      FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
            FROM d, (SELECT DISTINCT n FROM p) WHERE len(w) >= n)),
h AS (SELECT doc_id, o.n, i, item FROM o JOIN p ON o.win = p.win AND o.n = p.n),
t AS (SELECT doc_id, count(DISTINCT pos) AS n_hit
      FROM (SELECT doc_id, unnest(range(i, i + n)) AS pos FROM h) GROUP BY doc_id),
m AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
      FROM (SELECT DISTINCT doc_id, item FROM h) GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN t USING (doc_id) LEFT JOIN m USING (doc_id)
"""

OP3 = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
"""


def _canonical_lines(text: str) -> str:
    t = f"lower(replace(replace({text}, chr(13) || chr(10), chr(10)), chr(13), chr(10)))"
    for a, b in license_scan.EQUIVALENT:
        t = f"replace({t}, '{a}', '{b}')"
    t = f"regexp_replace({t}, '{license_scan.COPYRIGHT_LINE}', '', 'g')"
    return f"regexp_replace({t}, '{license_scan.NOT_WORD}', ' ', 'g')"


def _one_line(text: str) -> str:
    return rf"trim(regexp_replace({text}, '[ \n]+', ' ', 'g'))"


def _op5() -> str:
    values = ", ".join("('{}', '{}')".format(i, t.replace("'", "''")) for i, t in license_scan.KNOWN)
    return rf"""
WITH k AS (SELECT DISTINCT license, {_one_line(_canonical_lines('t'))} AS unit
           FROM (VALUES {values}) AS v(license, t)),
c AS (SELECT doc_id, {_canonical_lines("coalesce(text, '')")} AS lines FROM documents),
u AS (SELECT doc_id, {_one_line('lines')} AS whole_text,
             list_distinct(list_transform(list_concat(string_split_regex(lines, '\n[ \n]*\n'),
                 string_split_regex(lines, '\n')), lambda x: {_one_line('x')})) AS units FROM c),
x AS (SELECT doc_id, unnest(list_distinct(list_concat([whole_text], units))) AS unit, whole_text FROM u),
h AS (SELECT doc_id, string_agg(DISTINCT license, ',' ORDER BY license) AS licenses,
             count(*) AS n_units, max(CASE WHEN x.unit = whole_text THEN license END) AS whole
      FROM x JOIN k USING (unit) GROUP BY doc_id)
SELECT u.doc_id, sha256(whole_text) AS text_sha256, whole, coalesce(licenses, '') AS licenses,
       coalesce(n_units, 0) AS n_units
FROM u LEFT JOIN h USING (doc_id)
"""


def _op6() -> str:
    parts = []
    for rank, r in enumerate(secret_scan.RULES):
        rx = r.regex.replace("'", "''")
        parts.append(f"""
SELECT doc_id, '{r.kind}' AS kind, {rank} AS rank, m, g, j FROM (
  SELECT doc_id, regexp_extract_all(text, '{rx}') AS m,
         string_split_regex(text, '{rx}') AS g,
         regexp_extract_all(text, '{rx}', {r.group}) AS j, {max(1, r.least)} AS least
  FROM documents WHERE regexp_matches(text, '{rx}'))""")
    least = " ".join(f"WHEN '{r.kind}' THEN {max(1, r.least)}" for r in secret_scan.RULES)
    base = ", ".join(f"'{r.kind}'" for r in secret_scan.RULES if r.base)
    counts = ", ".join(f"count(*) FILTER (kind = '{r.kind}') AS n_{r.kind}"
                       for r in secret_scan.RULES if r.base)
    zeros = ", ".join(f"coalesce(n_{r.kind}, 0) AS n_{r.kind}" for r in secret_scan.RULES if r.base)
    return f"""
WITH f AS ({" UNION ALL ".join(parts)}),
n AS (SELECT doc_id, kind, rank, m, g, j, unnest(range(1, len(m) + 1)) AS i FROM f),
s AS (SELECT doc_id, kind, rank, length(m[i]) AS size,
             CAST(list_sum(list_transform(g[1:i], lambda x: length(x)))
                  + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS BIGINT) AS start
      FROM n WHERE length(j[i]) >= CASE kind {least} END),
t AS (SELECT doc_id, rank, start, kind, kind || ':' || start || ':' || (start + size) AS span FROM s),
a AS (SELECT doc_id, {counts},
             string_agg(span, ',' ORDER BY start, rank) FILTER (kind IN ({base})) AS base,
             string_agg(span, ',' ORDER BY start, rank) AS spans FROM t GROUP BY doc_id)
SELECT d.doc_id, {zeros}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents d LEFT JOIN a USING (doc_id)
"""


OP8 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
x AS (SELECT page_id, h, sha1(h) AS d, max(page_id) OVER (PARTITION BY h) AS top FROM p),
q AS (SELECT * FROM x)
SELECT page_id, octet_length(encode(h)) AS payload_bytes,
       array_to_string(list_transform(range(32), lambda g: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         CAST(1 + list_sum(list_transform(range(5), lambda b: (
           ((strpos('0123456789abcdef', substr(d, CAST((g * 5 + b) // 4 + 1 AS INTEGER), 1)) - 1)
             >> CAST(3 - (g * 5 + b) % 4 AS INTEGER)) & 1) << CAST(4 - b AS INTEGER))) AS INTEGER), 1)), '')
         AS payload_digest,
       CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> top THEN top END AS refers_to
FROM q
"""

OP9 = f"""
WITH u AS (SELECT page_id,
  translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), '{_UPPER}', '{_LOWER}') AS host,
  regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages),
r AS (SELECT *, CASE
  WHEN ends_with('.' || host, '.example.org') AND starts_with(path, '/en/1') THEN 'example.org/en/1'
  WHEN ends_with('.' || host, '.example.org') AND starts_with(path, '/es/') THEN 'example.org/es/'
  WHEN ends_with('.' || host, '.com') AND starts_with(path, '/de/') THEN 'com/de/'
  WHEN ends_with('.' || host, '.com') AND starts_with(path, '/fr/') THEN 'com/fr/'
  WHEN ends_with('.' || host, '.org') AND starts_with(path, '/') THEN 'org/' END AS rule FROM u)
SELECT page_id, host, path, rule, CASE
  WHEN rule IN ('org/', 'com/fr/') THEN 'allow'
  WHEN rule IS NOT NULL THEN 'block'
  WHEN contains(path, '/ads/') OR contains(path, '/tracking/') OR ends_with(path, '.exe')
       OR ends_with(path, '.zip') OR starts_with(host, 'ads.') OR starts_with(host, 'track.')
       THEN 'block' ELSE 'allow' END AS verdict
FROM r
"""

OP11 = """
WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
           FROM embeddings
           WHERE label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same,
             CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
      FROM e a JOIN e b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
SELECT anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other) AS INTEGER) AS rank,
       other AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
QUALIFY rank <= 5
"""

def _terms(text: str) -> str:
    return (f"regexp_extract_all(translate(coalesce({text}, ''), '{_UPPER}', '{_LOWER}'), "
            r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')")


OP13 = f"""
WITH d AS (SELECT doc_id, {_terms('text')} AS w FROM documents),
l AS (SELECT doc_id, len(w) AS n FROM d WHERE len(w) > 0),
g AS (SELECT count(*) AS docs, sum(n) AS total FROM l),
t AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(w) AS term FROM d) GROUP BY doc_id, term),
q AS (SELECT item_id, term, count(*) AS times
      FROM (SELECT item_id, unnest({_terms('text')}) AS term FROM benchmark) GROUP BY item_id, term),
f AS (SELECT term, count(*) AS df FROM t WHERE term IN (SELECT term FROM q) GROUP BY term),
w AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * df + 1))) AS BIGINT) AS weight FROM f, g),
m AS (SELECT doc_id, 25 + (75 * n * docs) // CAST(total AS BIGINT) AS m FROM l, g),
s AS (SELECT item_id, doc_id, CAST(sum(times * weight * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
      FROM q JOIN w USING (term) JOIN t USING (term) JOIN m USING (doc_id) GROUP BY item_id, doc_id)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank,
       doc_id, score
FROM s WHERE score > 0 QUALIFY rank <= 10
"""

SQL: dict[str, str] = {
    "op1_decontaminate": OP1, "op3_exact_dedup": OP3, "op5_license_scan": _op5(),
    "op6_secret_scan": _op6(), "op8_warc": OP8, "op9_url_filter": OP9,
    "op11_hard_negatives": OP11,
    "op13_ranked_search": OP13}
