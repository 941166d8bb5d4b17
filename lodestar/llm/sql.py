"""DuckDB statements that give the same rows as the queries, by plain relational means."""

OP2 = r"""
WITH RECURSIVE v AS (
  SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE list_cosine_similarity(a.e, b.e) >= 0.9),
reach AS (
  SELECT vec_id AS x, vec_id AS y FROM embeddings
  UNION
  SELECT reach.x, links.y FROM reach JOIN links ON links.x = reach.y),
lowest AS (SELECT x, min(y) AS component_id FROM reach GROUP BY x),
counted AS (SELECT x, count(*) AS n FROM links GROUP BY x)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN lowest ON lowest.x = vec_id LEFT JOIN counted ON counted.x = vec_id
"""

OP5 = r"""
WITH t AS (
  SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations),
r AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos, count(*) OVER (PARTITION BY conv_id) AS n FROM t),
p AS (
  SELECT conv_id, pos, n, string_agg(strlen(role) || ':' || role || strlen(text) || ':' || text, '') OVER (PARTITION BY conv_id ORDER BY pos) AS prefix FROM r),
whole AS (SELECT prefix, min(conv_id) AS conv_id, min(n) AS n_turns, count(*) AS n_copies FROM p WHERE pos = n GROUP BY prefix),
kept AS (SELECT * FROM whole WHERE prefix NOT IN (SELECT prefix FROM p WHERE pos < n))
SELECT conv_id, any_value(n_turns)::INT AS n_turns, any_value(n_copies) AS n_copies,
  string_agg('<|im_start|>' || replace(role, '<|im_', '<| im_') || chr(10) || replace(text, '<|im_', '<| im_') || '<|im_end|>' || chr(10), '' ORDER BY pos) AS rendered
FROM kept JOIN r USING (conv_id) GROUP BY conv_id
"""

OP8 = r"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, r.vec_id, list_sum(list_transform(list_zip(q.e, r.e), lambda p: coalesce(p[1] * p[2], 0)))::BIGINT AS score
  FROM v q JOIN v r ON r.vec_id <> q.vec_id WHERE q.vec_id % 100 = 0),
ranked AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""

OP10 = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
  FROM documents),
shingles AS (
  SELECT doc_id, unnest(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END)) AS s
  FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n_both FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (
  SELECT x, y FROM shared JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * n_both >= 75 * (p.n + q.n - n_both)),
reach AS (
  SELECT doc_id AS x, doc_id AS y FROM documents
  UNION
  SELECT reach.x, links.y FROM reach JOIN links ON links.x = reach.y),
lowest AS (SELECT x, min(y) AS component_id FROM reach GROUP BY x)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d LEFT JOIN sizes USING (doc_id) JOIN lowest ON lowest.x = d.doc_id
"""
