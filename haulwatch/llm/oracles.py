"""DuckDB SQL with the results of the queries that SQL can express."""

from __future__ import annotations

LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP2 = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS x
  FROM (SELECT item_id, w, least(13, len(w)) AS k FROM b WHERE len(w) > 0), unnest(range(1, len(w) - k + 2)) AS t(i)
),
sizes AS (SELECT DISTINCT k FROM windows),
places AS (SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS x FROM d, sizes, unnest(range(1, len(w) - k + 2)) AS t(i)),
found AS (SELECT doc_id, item_id, i, k FROM places JOIN windows USING (k, x)),
hit AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM found, unnest(range(i, i + k)) AS t(j) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""

_ALIKE = rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + {{width}} - 1], ' ') AS s FROM d, unnest(range(1, greatest(len(w) - {{width}} + 1, 1) + 1)) AS t(i) WHERE len(w) > 0
),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM shingles a JOIN shingles b USING (s) WHERE a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM common c JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c.n >= {{percent}} * (x.n + y.n - c.n)
),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, CAST(least(doc_id, coalesce(m, doc_id)) AS BIGINT) AS component_id{{kept}}
FROM d LEFT JOIN sizes USING (doc_id) LEFT JOIN (SELECT a AS doc_id, min(b) AS m FROM reach GROUP BY a) USING (doc_id)
"""

OP6 = _ALIKE.format(width=5, percent=75, kept=", doc_id <= coalesce(m, doc_id) AS kept")
OP11 = _ALIKE.format(width=4, percent=85, kept="")

_KINDS = {
    "assign": (r"""(?:(?i:password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)""", 1, 12),
    "access": (r"AKIA[A-Z0-9]+", 0, 18),
    "hex": (r"[0-9a-f]+", 0, 16),
    "owned": (r"[A-Za-z0-9+/_-]{20,}={0,2}", 0, 20),
}
_FOUND = " UNION ALL ".join(
    f"""SELECT doc_id, owner, repository, {k} AS kind, start, start + length(m) AS "end", v FROM (
  SELECT doc_id, owner, repository, ms[i] AS m, vs[i] AS v,
    list_sum([length(x) FOR x IN gs[1:i]]) + coalesce(list_sum([length(x) FOR x IN ms[1:i - 1]]), 0) AS start
  FROM (SELECT doc_id, owner, repository, regexp_extract_all(t, '{p}') AS ms, regexp_extract_all(t, '{p}', {g}) AS vs, string_split_regex(t, '{p}') AS gs FROM d),
    unnest(range(1, len(ms) + 1)) AS u(i)) WHERE length(v) >= {least}"""
    for k, (p, g, least) in enumerate(_KINDS.values())
)
_LISTED = "string_agg(['assign', 'access', 'hex', 'owned'][kind + 1] || ':' || start || ':' || \"end\", ',' ORDER BY start, kind)"

OP4 = f"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS owner, coalesce(lang, '') AS repository, coalesce(text, '') AS t FROM documents),
every AS ({_FOUND}),
base AS (SELECT DISTINCT * FROM every WHERE kind < 3),
bare AS (
  SELECT DISTINCT * FROM every e WHERE kind = 3 AND regexp_matches(v, '[0-9].*[0-9].*[0-9]') AND regexp_matches(v, '[A-Za-z].*[A-Za-z].*[A-Za-z]')
    AND len(list_distinct(string_split(v, ''))) >= 10
    AND NOT EXISTS (SELECT 1 FROM base b WHERE b.doc_id = e.doc_id AND b.start < e."end" AND e.start < b."end")
),
candidates AS (SELECT * FROM base UNION ALL SELECT * FROM bare),
live AS (
  SELECT v FROM (SELECT DISTINCT v, owner, repository FROM candidates) GROUP BY v HAVING count(DISTINCT owner) <= 2 AND count(*) <= 4
),
spans AS (SELECT *, v IN (SELECT v FROM live) AS is_live FROM candidates),
told AS (
  SELECT doc_id, count(*) FILTER (kind = 0) AS a, count(*) FILTER (kind = 1) AS b, count(*) FILTER (kind = 2) AS c,
    {_LISTED} FILTER (kind < 3) AS base, {_LISTED} FILTER (kind < 3 OR is_live) AS spans, count(*) FILTER (is_live) AS n
  FROM spans GROUP BY doc_id
)
SELECT doc_id, CAST(coalesce(a, 0) AS BIGINT) AS n_assign, CAST(coalesce(b, 0) AS BIGINT) AS n_access, CAST(coalesce(c, 0) AS BIGINT) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, CAST(coalesce(n, 0) AS BIGINT) AS n_live
FROM d LEFT JOIN told USING (doc_id)
"""

OP10 = r"""
WITH p AS (
  SELECT page_id, coalesce(CAST(page_id AS VARCHAR), '') AS name, regexp_replace(coalesce(url, ''), '[\x00-\x20\x7F]', '%20', 'g') AS url, coalesce(html, '') AS html,
    greatest(1, CAST(ceil(count(*) OVER () / 1024.0) AS BIGINT)) AS n FROM pages
),
r AS (
  SELECT page_id, url, CAST(('0x' || substr(sha256(name || ' ' || url), 1, 8)) AS BIGINT) % n AS archive,
    'WARC/1.0' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10) || 'WARC-Target-URI: ' || url || chr(13) || chr(10)
    || 'WARC-Date: 1970-01-01T00:00:00Z' || chr(13) || chr(10) || 'WARC-Record-ID: <urn:key:' || sha256(name || ' ' || url) || '>' || chr(13) || chr(10)
    || 'Content-Type: text/html; charset=utf-8' || chr(13) || chr(10) || 'Content-Length: ' || strlen(html) || chr(13) || chr(10) || chr(13) || chr(10)
    || html || chr(13) || chr(10) || chr(13) || chr(10) AS record, substr(sha256(CAST(page_id AS VARCHAR)), 1, 2) IN ('00', '7f') AS damaged FROM p
),
h AS (SELECT *, sha256(record) AS leaf, CAST(strlen(record) AS BIGINT) AS size FROM r),
o AS (
  SELECT *, row_number() OVER w - 1 AS position, CAST(sum(size) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS "end"
  FROM h WINDOW w AS (PARTITION BY archive ORDER BY url COLLATE C, page_id, leaf)
)
SELECT page_id, archive, position, "end" - size AS start, "end", leaf AS record_sha256, CASE WHEN damaged THEN 'corrupt' ELSE 'intact' END AS status FROM o
"""

_NEAREST = """
near{r} AS MATERIALIZED (
  SELECT id, part, min(entry) AS entry, min(d) AS d FROM (
    SELECT id, part, entry, d, min(d) OVER (PARTITION BY id, part) AS least
    FROM (SELECT id, part, entry, sum((v - c) * (v - c)) AS d FROM x JOIN book{r} USING (part, place) GROUP BY ALL)
  ) WHERE d = least GROUP BY id, part
)"""
_IMPROVED = """
book{s} AS MATERIALIZED (
  SELECT part, entry, place, CAST(coalesce((total - ((total % uses) + uses) % uses) // uses, c) AS BIGINT) AS c
  FROM book{r} LEFT JOIN (
    SELECT part, entry, place, sum(v) AS total, count(*) AS uses FROM near{r} JOIN x USING (id, part) GROUP BY ALL
  ) USING (part, entry, place)
)"""
_ROUNDS = ",".join(_NEAREST.format(r=r) + "," + _IMPROVED.format(r=r, s=r + 1) for r in range(6)) + "," + _NEAREST.format(r=6)

OP12 = f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id, embedding) AS id, vec_id, embedding, label FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
),
x AS MATERIALIZED (
  SELECT id, (p - 1) // (len(embedding) // 8) AS part, (p - 1) % (len(embedding) // 8) AS place, CAST(floor(4096 * CAST(embedding[p] AS DOUBLE)) AS BIGINT) AS v
  FROM kept, unnest(range(1, len(embedding) + 1)) AS t(p)
),
book0 AS MATERIALIZED (SELECT part, id - 1 AS entry, place, v AS c FROM x WHERE id <= 16),
{_ROUNDS},
coded AS (SELECT id, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM near6 GROUP BY id),
books AS (SELECT sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY part, entry, place)) AS h FROM book6)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, (SELECT h FROM books) AS codebooks_sha256
FROM kept JOIN coded USING (id)
"""

ORACLES = {"op2_decontamination": OP2, "op4_secret_scans": OP4, "op6_near_duplicates": OP6, "op10_warc_fixity": OP10, "op11_ngram_join": OP11, "op12_vector_codes": OP12}
