"""DuckDB SQL for the operators' queries that SQL can express."""

from __future__ import annotations

WORD = r"[^\x20\x09-\x0D]+"
LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP2 = rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all({LOWER}, '{WORD}') AS w FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: md5(array_to_string(w[i:i+4], ' ')))
                                      WHEN len(w) > 0 THEN [md5(array_to_string(w, ' '))] ELSE [] END) AS s
  FROM words
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2
), links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * shared.n >= 80 * (x.n + y.n - shared.n)
), both_ways AS (
  SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reached AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION
  SELECT r.a, l.b FROM reached r JOIN both_ways l ON r.b = l.a
)
SELECT d.doc_id, coalesce(any_value(sizes.n), 0)::BIGINT AS n_shingles, min(reached.b)::BIGINT AS component_id
FROM documents d LEFT JOIN sizes ON sizes.doc_id = d.doc_id LEFT JOIN reached ON reached.a = d.doc_id
GROUP BY d.doc_id
"""

OP4 = rf"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w FROM documents
), windows AS (
  SELECT doc_id, w, i, md5(array_to_string(w[i:i+49], ' ')) AS h FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM words)
), firsts AS (
  SELECT h, min(doc_id) AS least FROM windows GROUP BY h
), gone AS (
  SELECT DISTINCT doc_id, i + j AS p FROM (SELECT doc_id, i, unnest(range(0, 50)) AS j FROM windows JOIN firsts USING (h) WHERE least < doc_id)
), removed AS (
  SELECT doc_id, list(p) AS ps, count(*) AS n FROM gone GROUP BY doc_id
), kept AS (
  SELECT doc_id, array_agg(x ORDER BY p) AS w FROM (
    SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p FROM words
  ) AS flat ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id
)
SELECT words.doc_id, len(words.w)::BIGINT AS n_words, coalesce(removed.n, 0)::BIGINT AS n_removed,
       sha256(coalesce(array_to_string(kept.w, ' '), '')) AS kept_sha256
FROM words LEFT JOIN removed USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

OP7 = rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all({LOWER}, '{WORD}') AS w FROM documents
), i AS (
  SELECT item_id, regexp_extract_all({LOWER}, '{WORD}') AS w FROM benchmark
), item_shingles AS (
  SELECT DISTINCT item_id, least(5, len(w)) AS k, unnest(list_transform(range(1, len(w) - least(5, len(w)) + 2), lambda p: array_to_string(w[p:p + least(5, len(w)) - 1], ' '))) AS s
  FROM i WHERE len(w) > 0
), doc_shingles AS (
  SELECT DISTINCT doc_id, k, unnest(list_transform(range(1, len(w) - k + 2), lambda p: array_to_string(w[p:p + k - 1], ' '))) AS s
  FROM d, (SELECT DISTINCT k FROM item_shingles) WHERE len(w) >= k
), sizes AS (
  SELECT item_id, count(*) AS n FROM item_shingles GROUP BY item_id
), shared AS (
  SELECT doc_id, item_id, count(*) AS n FROM item_shingles JOIN doc_shingles USING (k, s) GROUP BY doc_id, item_id
)
SELECT doc_id, item_id, sizes.n::BIGINT AS n_shingles, shared.n::BIGINT AS n_shared
FROM shared JOIN sizes USING (item_id) WHERE 100 * shared.n >= 80 * sizes.n
"""

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

OP12 = rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all({LOWER}, '{TERM}') AS w FROM documents
), sizes AS (
  SELECT doc_id, len(w)::BIGINT AS n FROM d WHERE len(w) > 0
), whole AS (
  SELECT count(*)::BIGINT AS n_docs, sum(n)::BIGINT AS n_terms FROM sizes
), tf AS (
  SELECT doc_id, t, count(*)::BIGINT AS tf FROM (SELECT doc_id, unnest(w) AS t FROM d) GROUP BY doc_id, t
), weights AS (
  SELECT t, floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1)))::BIGINT AS weight FROM tf, whole GROUP BY t
), item_terms AS (
  SELECT item_id, t, count(*)::BIGINT AS times FROM (SELECT item_id, unnest(regexp_extract_all({LOWER}, '{TERM}')) AS t FROM benchmark) GROUP BY item_id, t
), scores AS (
  SELECT item_id, doc_id, sum(times * weight * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * n_docs) // n_terms))))::BIGINT AS score
  FROM item_terms JOIN tf USING (t) JOIN weights USING (t) JOIN sizes USING (doc_id), whole GROUP BY item_id, doc_id
)
SELECT item_id, rank::INT AS rank, doc_id, score FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0) WHERE rank <= 20
"""
