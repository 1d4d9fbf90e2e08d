"""DuckDB SQL of the training-data queries that SQL can express.

Tokenizer files (2, 8), surrogates drawn anew until none collides (1) and
trained models (6, 10, 13) and eigenvectors (12) are out of its reach; tests hold those against brute
force.
"""

from __future__ import annotations

_OP3 = """
WITH v AS (
  SELECT vec_id, [x::DOUBLE FOR x IN embedding] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
    AND len([x FOR x IN embedding IF x <> 0]) > 0
), d AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, sqrt(list_sum([(q.e[i] - c.e[i]) * (q.e[i] - c.e[i]) FOR i IN range(1, len(q.e) + 1)])) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id AND len(c.e) = len(q.e)
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS rank FROM d
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 10
"""

_OP7 = """
WITH v AS (
  SELECT vec_id, [floor(256 * x::DOUBLE) FOR x IN embedding] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), d AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(c.e) = len(q.e)
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM d
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
"""

_OP4 = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w
  FROM documents
), s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) = 1 THEN w
    ELSE [w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))] END) AS s
  FROM w
), n AS (
  SELECT doc_id, len(s) AS n, s FROM s
), e AS (
  SELECT doc_id, n, unnest(s) AS sh FROM n
), i AS (
  SELECT a.doc_id AS a, b.doc_id AS b, a.n AS na, b.n AS nb, count(*) AS common
  FROM e a JOIN e b ON a.sh = b.sh AND a.doc_id < b.doc_id
    AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
  GROUP BY ALL
), l AS (
  SELECT a, b FROM i WHERE 100 * common >= 80 * (na + nb - common)
), l2 AS (
  SELECT a, b FROM l UNION SELECT b, a FROM l
), reach AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION
  SELECT r.doc_id, l2.b FROM reach r JOIN l2 ON l2.a = r.other
), c AS (
  SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id
)
SELECT n.doc_id, n.n AS n_shingles, c.component_id, n.doc_id = c.component_id AS kept
FROM n JOIN c ON n.doc_id = c.doc_id
"""

_URL = (r"regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)([^?#]*)[?]?([^#]*)', {})")
_HOST = (r"regexp_replace(lower({s}) || '://' || lower({h}), '^(http://[^/]*):80$|^(https://[^/]*):443$', '\1\2')"
         ).format(s=_URL.format(1), h=_URL.format(2))
_QUERY = (r"array_to_string(list_sort([x FOR x IN string_split({q}, '&') IF x <> '' AND NOT starts_with(x, 'utm_')]), '&')"
          ).format(q=_URL.format(4))
_OP5 = f"""
WITH p AS (
  SELECT page_id, url, md5(html) AS m, length(html) AS n, page_id * 60 AS ts,
    CASE WHEN contains(url, '#') THEN url
         ELSE url || (CASE WHEN contains(url, '?') THEN '&' ELSE '?' END) || 'utm_medium=feed#x' END AS mark
  FROM pages
), rec AS (
  SELECT page_id * 4 AS record_id, 'response' AS kind, url, ts, '"' || m || '"' AS etag, m AS digest, n FROM p
  UNION ALL
  SELECT page_id * 4 + 2, 'response', url, ts + 43200, '"' || reverse(m) || '"', reverse(m), n FROM p WHERE page_id % 4 = 0
  UNION ALL
  SELECT page_id * 4 + 1, 'revisit', mark, ts + 86400,
    '"' || CASE WHEN page_id % 5 = 0 THEN 'changed' WHEN page_id % 4 = 0 THEN reverse(m) ELSE m END || '"',
    CASE WHEN page_id % 3 <> 0 THEN CASE WHEN page_id % 4 = 0 THEN reverse(m) ELSE m END END, NULL FROM p
  UNION ALL
  SELECT page_id * 4 + 3, 'revisit', mark, ts - 30, '"' || m || '"', m, NULL FROM p WHERE page_id % 7 = 0
), c AS (
  SELECT * REPLACE (CASE WHEN {_URL.format(1)} = '' THEN url ELSE {_HOST}
    || CASE WHEN {_URL.format(3)} = '' THEN '/' ELSE {_URL.format(3)} END
    || CASE WHEN {_QUERY} = '' THEN '' ELSE '?' || {_QUERY} END END AS url) FROM rec
), j AS (
  SELECT v.*, r.record_id AS base_id, r.ts AS base_at, r.digest AS base_digest, r.n AS base_n, r.etag AS base_etag,
    row_number() OVER (PARTITION BY v.record_id ORDER BY r.ts DESC, r.record_id DESC) AS k
  FROM c v LEFT JOIN c r ON r.kind = 'response' AND r.url = v.url AND r.ts < v.ts
  WHERE v.kind = 'revisit'
), o AS (
  SELECT *, CASE WHEN base_id IS NULL THEN 'no_response'
    WHEN etag <> base_etag OR coalesce(digest <> base_digest, false) THEN 'mismatch' ELSE 'resolved' END AS outcome
  FROM j WHERE k = 1
)
SELECT record_id, url, base_id, base_at, outcome,
  CASE WHEN outcome = 'resolved' THEN 'content-length=' || base_n || '; content-type=text/html; date=day '
    || (CAST(floor((ts - 86400 * (record_id % 4 = 1)::INT + 30 * (record_id % 4 = 3)::INT) / 86400) AS BIGINT) + 1)
    || '; etag=' || CASE WHEN record_id % 4 = 1 THEN 'W/' ELSE '' END || etag || '; x-cache=hit' END AS headers,
  CASE WHEN outcome = 'resolved' THEN base_digest END AS digest
FROM o
"""

# Bytes as hexadecimal text: place i (from 0) of n bytes is two characters at 2 * i + 1. Windows are taken from
# parts of 300 bytes, each of which has 201 of them: a substring of a whole text costs the text's length.
_OP9 = """
WITH h AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), o AS (
  SELECT doc_id, h, unnest(range(0, greatest(len(h) // 2 - 99, 0), 201)) AS o FROM h
), p AS (
  SELECT doc_id, o, substr(h, 2 * o + 1, 600) AS p FROM o
), j AS (
  SELECT doc_id, o, p, unnest(range(0, len(p) // 2 - 99)) AS j FROM p
), w AS (
  SELECT doc_id, o + j AS i, md5_number(substr(p, 2 * j + 1, 200)) AS m FROM j
), f AS (
  SELECT m, min(ROW(doc_id, i)) AS f FROM w GROUP BY m HAVING count(*) > 1
), x AS (
  SELECT w.doc_id, w.i FROM w JOIN f ON w.m = f.m WHERE ROW(w.doc_id, w.i) <> f.f
), b AS (
  SELECT doc_id, i, max(i + 100) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS e
  FROM x
), g AS (
  SELECT doc_id, i, sum(CASE WHEN e IS NULL OR i > e THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS g FROM b
), s AS (
  SELECT doc_id, g, min(i) AS a, max(i) + 100 AS b FROM g GROUP BY doc_id, g
), k AS (
  SELECT h.doc_id, h.h, s.a, coalesce(lag(s.b) OVER (PARTITION BY h.doc_id ORDER BY s.a), 0) AS from_, s.b,
    row_number() OVER (PARTITION BY h.doc_id ORDER BY s.a DESC) = 1 AS last
  FROM h LEFT JOIN s ON s.doc_id = h.doc_id
), r AS (
  SELECT doc_id, any_value(h) AS h, coalesce(sum(b - a), 0) AS gone, count(a) AS spans,
    CASE WHEN count(a) = 0 THEN any_value(h) ELSE
      string_agg(substr(h, 2 * from_ + 1, 2 * (a - from_)), '' ORDER BY a) || any_value(CASE WHEN last THEN substr(h, 2 * b + 1) END)
    END AS kept
  FROM k GROUP BY doc_id
)
SELECT doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, CAST(gone AS BIGINT) AS n_removed, spans AS n_spans,
  sha256(unhex(kept)) AS kept_sha256
FROM r
"""

_OP11 = r"""
WITH t AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), w AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM t
), n AS (
  SELECT lang, sum(len(ws))::HUGEINT AS n FROM w GROUP BY lang
), x AS (
  SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM w
), f AS (
  SELECT lang, ws[i:i + k - 1] AS g, count(*)::HUGEINT AS f FROM x, range(1, 6) AS s(k) WHERE i + k - 1 <= len(ws)
  GROUP BY ALL HAVING count(*) >= 100
), c AS (
  SELECT f.lang, f.g, f.f AS a, k, l.f AS l, r.f AS r, n.n, 1000 * f.f * n.n // (l.f * r.f) AS score
  FROM f JOIN n ON n.lang = f.lang JOIN range(1, 5) AS s(k) ON k < len(f.g)
    JOIN f l ON l.lang = f.lang AND l.g = f.g[1:k] JOIN f r ON r.lang = f.lang AND r.g = f.g[k + 1:len(f.g)]
), b AS (
  SELECT *, array_to_string(g, ' ') AS phrase FROM c QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1
), d AS (
  SELECT * FROM b WHERE NOT EXISTS (
    SELECT 1 FROM f q WHERE q.lang = b.lang AND len(q.g) > len(b.g) AND 100 * q.f >= 100 * b.a
      AND contains(' ' || array_to_string(q.g, ' ') || ' ', ' ' || b.phrase || ' '))
), o AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM d
)
SELECT lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM o WHERE rank <= 2000
"""

LLM_ORACLE_SQL: dict[str, str] = {
    "op3_vptree": _OP3, "op4_near_dedup": _OP4, "op5_revisits": _OP5, "op7_top_products": _OP7, "op9_repeats": _OP9,
    "op11_collocations": _OP11}
