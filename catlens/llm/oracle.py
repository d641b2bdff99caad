"""DuckDB SQL for the operators that SQL can express."""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORD = r"[^\x20\x09-\x0D]+"

OP3 = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_WORD}') AS ws FROM documents
), g AS (
  SELECT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
         ELSE list_distinct(list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i+3], ' '))) END) AS s FROM w
), n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id
), p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM g a JOIN g b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL
), l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 85 * (x.n + y.n - i)
), r AS (SELECT doc_id AS a, doc_id AS b FROM w UNION SELECT r.a, l.b FROM r JOIN l ON l.a = r.b)
SELECT w.doc_id, CAST(coalesce(any_value(n.n), 0) AS BIGINT) AS n_shingles, min(r.b) AS component_id
FROM w JOIN r ON r.a = w.doc_id LEFT JOIN n ON n.doc_id = w.doc_id GROUP BY w.doc_id
"""

OP7 = f"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS ws FROM documents
), v AS (
  SELECT doc_id, s, md5(array_to_string(ws[s:s+49], ' ')) AS h FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS s FROM w WHERE len(ws) >= 50)
), f AS (SELECT h, min(doc_id) AS d FROM v GROUP BY h
), c AS (SELECT DISTINCT doc_id, unnest(range(s, s + 50)) AS p FROM v JOIN f USING (h) WHERE d < doc_id
), q AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS p FROM w
), k AS (SELECT q.doc_id, string_agg(word, ' ' ORDER BY p) AS kept, count(*) AS n FROM q ANTI JOIN c USING (doc_id, p) GROUP BY q.doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN k USING (doc_id)
"""


def _filled(level: int) -> str:
    """One level of the water-filling: table l<level> with each node's budget as given."""
    cols = ["domain", "lang", "source"][: level + 1]
    part = f"PARTITION BY {', '.join(cols[:-1])}" if level else ""
    source = f"n{level} JOIN l{level - 1} USING ({', '.join(cols[:-1])})" if level else "n0, total"
    before = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    return f"""
n{level} AS (SELECT {', '.join(cols)}, sum(tokens) * 2 AS capacity FROM leaf GROUP BY ALL),
r{level} AS (SELECT {', '.join(cols)}, capacity, given,
  (given - coalesce(sum(capacity) OVER (w {before}), 0)) / (count(*) OVER ({part}) - coalesce(count(*) OVER (w {before}), 0)) AS level
  FROM {source} WINDOW w AS ({part} ORDER BY capacity, {cols[-1]})),
l{level} AS (SELECT {', '.join(cols)}, CASE WHEN capacity <= level * (1 + 1e-12) THEN CAST(capacity AS DOUBLE)
  ELSE least(CAST(capacity AS DOUBLE), max(CASE WHEN capacity > level * (1 + 1e-12) THEN level END) OVER ({part})) END AS given FROM r{level})"""


OP5 = f"""
WITH d AS (
  SELECT doc_id, lang, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{_WORD}')) AS BIGINT) AS n,
         coalesce(nullif(regexp_extract(source, '^[A-Za-z]+'), ''), 'none') AS domain FROM documents
), leaf AS (SELECT domain, lang, source, sum(n) AS tokens FROM d GROUP BY ALL
), total AS (SELECT CAST(0.5 * sum(tokens) AS DOUBLE) AS given FROM leaf
),{_filled(0)},{_filled(1)},{_filled(2)},
plan AS (
  SELECT domain, lang, source, tokens, CAST(floor(given + 1e-6) AS BIGINT) AS budget, CAST(floor(given + 1e-6) AS BIGINT) // greatest(tokens, 1) AS epochs
  FROM leaf JOIN l2 USING (domain, lang, source)
), k AS (
  SELECT d.*, budget, epochs, budget - epochs * tokens AS rest, md5('5:' || epochs || ':' || doc_id) AS key FROM d JOIN plan USING (domain, lang, source)
), t AS (SELECT *, coalesce(sum(n) OVER (PARTITION BY domain, lang, source ORDER BY key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM k)
SELECT doc_id, domain, lang, source, n AS n_tokens, budget, CAST(epochs + CASE WHEN before < rest THEN 1 ELSE 0 END AS BIGINT) AS copies FROM t
"""

OP10 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages
), d AS (SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, sha1(html) AS payload_digest FROM p
), t AS (SELECT payload_digest, max(page_id) AS top FROM d WHERE payload_bytes >= 1000 GROUP BY payload_digest)
SELECT page_id, payload_bytes, d.payload_digest, CASE WHEN top <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN top <> page_id THEN top END AS refers_to
FROM d LEFT JOIN t ON t.payload_digest = d.payload_digest AND d.payload_bytes >= 1000
"""

# The CRC-32 step per bit (-1 in the list) and per character of the decimal text.
_CRC32 = (
    "xor(list_reduce(flatten(list_transform(string_split(CAST({0} AS VARCHAR), ''), lambda x: [CAST(ascii(x) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1])), "
    "lambda c, s: CASE WHEN s >= 0 THEN xor(c, s) WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, CAST(4294967295 AS BIGINT)), CAST(4294967295 AS BIGINT))"
)

OP11 = f"""
WITH o AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS ws, {_CRC32.format('doc_id')} AS h FROM documents
), t AS (SELECT *, len(ws) AS n, CASE WHEN h % 10 = 0 AND len(ws) > 0 THEN (h // 10) % len(ws) END AS a FROM o
), w AS (
  SELECT doc_id, n, CASE WHEN a IS NULL THEN ws ELSE
         list_transform(range(0, n), lambda i: ws[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + (h // 10) % 8)) END]) END AS ws FROM t
), g AS (SELECT doc_id, i, md5_number(array_to_string(ws[i+1:i+5], ' ')) AS s FROM (SELECT doc_id, ws, unnest(range(0, n - 4)) AS i FROM w WHERE n >= 5)
), m AS (SELECT x.doc_id, x.i, y.i - x.i AS q FROM g x JOIN g y ON x.doc_id = y.doc_id AND x.s = y.s AND x.i < y.i
), island AS (SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS k FROM m
), stretch AS (SELECT doc_id, min(i) AS s, max(i) + 5 + q AS e, q FROM island GROUP BY doc_id, q, k HAVING max(i) - min(i) + 5 + q >= greatest(6, 4 * q)
), r AS (SELECT doc_id, s, e - s AS len, min(q) AS q FROM stretch GROUP BY doc_id, s, e
), per AS (
  SELECT doc_id, count(*) AS n_runs, sha256(string_agg(s || ',' || len || ',' || q || chr(10), '' ORDER BY s, q)) AS runs_sha256 FROM r GROUP BY doc_id
), best AS (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY CAST(len AS DOUBLE) / q DESC, s, q) = 1
), gone AS (SELECT DISTINCT doc_id, unnest(range(s + q, s + len)) AS i FROM r
), words AS (SELECT doc_id, unnest(ws) AS word, unnest(range(0, n)) AS i FROM w
), kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT w.doc_id, coalesce(n_runs, 0) AS n_runs, s AS start, len AS length, q AS period, 1000 * len // q AS exponent_milli,
       coalesce(runs_sha256, sha256('')) AS runs_sha256, sha256(coalesce(kept.text, '')) AS collapsed_sha256
FROM w LEFT JOIN per USING (doc_id) LEFT JOIN best USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

OP12 = f"""
WITH t AS (
  SELECT conv_id AS c, md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS u, strlen(coalesce(text, '')) AS b, turn
  FROM conversations WHERE conv_id IS NOT NULL
), size AS (SELECT u, any_value(b) AS b FROM t GROUP BY u
), own AS (SELECT c, list(u ORDER BY turn NULLS FIRST, u) AS us, {_CRC32.format('c')} % 9 AS h FROM t GROUP BY c
), built AS (SELECT o.c, list_concat(coalesce(d.us, [])[1:o.h], o.us[o.h + 1:]) AS us FROM own o LEFT JOIN own d ON d.c = o.c - o.c % 5
), p AS (SELECT c, len(us) AS n, array_to_string(us, '') AS k, unnest(range(0, len(us) + 1)) AS d FROM built
), node AS (
  SELECT substr(k, 1, 32 * d) AS k, d, min(c) AS conv_id, count(*) AS n_convs, string_agg(CASE WHEN n = d THEN c END, ',' ORDER BY c) AS ends FROM p GROUP BY ALL
), kids AS (SELECT substr(k, 1, 32 * (d - 1)) AS k, count(*) AS n_children FROM node WHERE d > 0 GROUP BY 1
), cost AS (SELECT node.k, d, n_children IS NULL AS leaf, coalesce((n_convs - 1) * b, 0) AS saved FROM node LEFT JOIN size ON u = right(node.k, 32) LEFT JOIN kids USING (k)
), below AS (
  SELECT substr(k, 1, 32 * up) AS k, sum(CASE WHEN leaf THEN 1 ELSE 0 END) AS n_leaves, sum(saved) AS saved FROM (SELECT *, unnest(range(0, d + 1)) AS up FROM cost) GROUP BY 1)
SELECT a.conv_id, a.d AS depth, b.conv_id AS parent_conv_id, a.n_convs, coalesce(n_children, 0) AS n_children, CAST(n_leaves AS BIGINT) AS n_leaves,
       CAST(saved AS BIGINT) AS saved_tokens, sha256(coalesce(a.ends, '')) AS ends_sha256
FROM node a LEFT JOIN kids ON kids.k = a.k JOIN below ON below.k = a.k LEFT JOIN node b ON a.d > 0 AND b.k = substr(a.k, 1, 32 * (a.d - 1))
"""

ORACLE_SQL = {
    "op3_ngram_join": OP3,
    "op5_hierarchical_mixing": OP5,
    "op7_fm_index_dedup": OP7,
    "op10_warc_index": OP10,
    "op11_periodic_runs": OP11,
    "op12_prefix_trie": OP12,
}
