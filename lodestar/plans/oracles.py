"""DuckDB statements that give the rows of the registered queries, written from the rules and not from the operators."""

from __future__ import annotations

from lodestar.plans.views import ENTITIES

_SIM = "CASE WHEN lower({a}) = lower({b}) THEN 1.0 ELSE 1.0 - levenshtein(lower({a}), lower({b}))::DOUBLE / greatest(length({a}), length({b})) END"
_LETTERS = "len(list_intersect(string_split({a}, ''), string_split({b}, '')))"

_BRANDS = f"""{ENTITIES},
F AS (SELECT brand, count(*) AS freq, min(seq) AS first_seq FROM E WHERE trim(brand) <> '' GROUP BY brand),
B AS (SELECT row_number() OVER (ORDER BY freq DESC, first_seq) AS idx, brand, freq, regexp_replace(lower(brand), '[^a-z0-9_]', '', 'g') AS core FROM F),
P AS (
  SELECT a.idx AS i, b.idx AS j, a.brand AS brand1, b.brand AS brand2, a.freq AS freq1, b.freq AS freq2, a.core AS core1, b.core AS core2, {_SIM.format(a="a.core", b="b.core")} AS similarity
  FROM B a JOIN B b ON a.idx < b.idx
  WHERE CASE WHEN a.core = '' OR b.core = '' THEN false
    WHEN greatest(a.freq, b.freq) < 20 AND least(a.freq, b.freq) <= 3 THEN false
    WHEN contains(a.core, b.core) OR contains(b.core, a.core) THEN true
    WHEN abs(length(a.core) - length(b.core)) > 8 AND length(a.core) > 4 AND length(b.core) > 4 THEN false
    WHEN {_LETTERS.format(a="a.core", b="b.core")} >= 2 THEN true
    WHEN least(a.freq, b.freq) <= 3 AND a.core[1] <> b.core[1] AND {_SIM.format(a="a.core", b="b.core")} < 0.8 THEN false
    WHEN {_SIM.format(a="a.core", b="b.core")} >= CASE WHEN least(a.freq, b.freq) <= 3 THEN 0.72 ELSE 0.65 END THEN true
    ELSE least(length(a.core), length(b.core)) <= 3 AND {_LETTERS.format(a="a.core", b="b.core")} > 0 END),
R AS (
  SELECT *, CASE WHEN lower(brand1) = lower(brand2) THEN 'rule_exact_match'
    WHEN abs(length(brand1) - length(brand2)) > greatest(length(brand1), length(brand2)) * 0.7 AND NOT contains(brand1, brand2) AND NOT contains(brand2, brand1) THEN 'rule_length_diff'
    WHEN core1 <> '' AND core1 = core2 THEN 'rule_core_match'
    WHEN (contains(brand1, brand2) OR contains(brand2, brand1)) AND abs(length(brand1) - length(brand2)) <= 10 THEN 'rule_contains'
    WHEN {_LETTERS.format(a="core1", b="core2")} < 2 THEN 'rule_no_common' END AS method FROM P)"""

_JUDGED = """
SELECT brand1, brand2, method, method IN ('rule_exact_match', 'rule_core_match', 'rule_contains') AS is_alias,
  CASE method WHEN 'rule_exact_match' THEN CASE WHEN freq1 >= freq2 THEN brand1 ELSE brand2 END
    WHEN 'rule_core_match' THEN CASE WHEN freq1 >= freq2 THEN brand1 ELSE brand2 END
    WHEN 'rule_contains' THEN CASE WHEN length(brand1) < length(brand2) THEN CASE WHEN freq1 >= freq2 THEN brand1 ELSE brand2 END ELSE CASE WHEN freq2 >= freq1 THEN brand2 ELSE brand1 END END END AS canonical,
  CASE method WHEN 'rule_exact_match' THEN 1.0 WHEN 'rule_length_diff' THEN 0.9 WHEN 'rule_core_match' THEN 0.92 WHEN 'rule_contains' THEN 0.85 ELSE 0.88 END::DOUBLE AS confidence
FROM R WHERE method IS NOT NULL"""

_COMPONENTS = """,
L AS (SELECT i AS x, j AS y FROM R WHERE method IN ('rule_exact_match', 'rule_core_match', 'rule_contains')),
S AS (SELECT x, y FROM L UNION ALL SELECT y, x FROM L),
C AS (SELECT idx AS x, idx AS y FROM B UNION SELECT C.x, S.y FROM C JOIN S ON S.x = C.y),
G AS (SELECT b.brand, h.brand AS canonical, b.freq FROM (SELECT x, min(y) AS root FROM C GROUP BY x) c JOIN B b ON b.idx = c.x JOIN B h ON h.idx = c.root)"""

_KNN_FIELDS = "0.4 * {m} + 0.2 * {f} + 0.1 * {s}"
_KNN = f"""
WITH {ENTITIES},
Q AS (SELECT * FROM E WHERE brand = ''),
K AS (SELECT * FROM E WHERE brand <> ''),
N AS (SELECT lower(manufacturer[1]) AS block, count(*) AS n FROM K GROUP BY 1),
SC AS (
  SELECT q.seq AS q, k.seq AS c, k.brand, ({_KNN_FIELDS.format(m=_SIM.format(a="q.product_model", b="k.product_model"), f=_SIM.format(a="q.manufacturer", b="k.manufacturer"), s=_SIM.format(a="q.series", b="k.series"))}) / (0.4 + 0.2 + 0.1) AS score
  FROM Q q JOIN K k ON lower(q.manufacturer[1]) = lower(k.manufacturer[1]) OR coalesce((SELECT n FROM N WHERE block = lower(q.manufacturer[1])), 0) < 10),
T AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY round(score, 12) DESC, c) AS r FROM SC WHERE score > 0),
V AS (SELECT q, brand, sum(score * score) AS w, min(r) AS fr FROM T WHERE r <= 5 GROUP BY q, brand),
A AS (SELECT q, arg_max(brand, (round(w, 12), -fr)) AS inferred, max(w) / sum(w) AS confidence FROM V GROUP BY q)
SELECT E.seq, CASE WHEN brand <> '' THEN brand ELSE coalesce(inferred, 'UNKNOWN') END AS brand, brand = '' AND inferred IS NOT NULL AS brand_inferred,
  CASE WHEN brand = '' THEN round(coalesce(confidence, 0), 6) END AS brand_confidence,
  CASE WHEN brand = '' THEN CASE WHEN confidence >= 0.75 THEN 'high' WHEN confidence >= 0.6 THEN 'medium' WHEN confidence > 0 THEN 'low' ELSE 'failed' END END AS confidence_level
FROM E LEFT JOIN A ON A.q = E.seq"""


def _merged(noisy: bool) -> str:
    """The merge of records by model; ``noisy``: by canonical model, the first of equal specifications."""
    model = "CASE WHEN seq % 3 = 0 THEN ' ' || lower(product_model) || '+ ' ELSE product_model END" if noisy else "product_model"
    return f"""
WITH {ENTITIES},
X AS (SELECT *, product_model AS merge_key, lower(product_model) AS low, {model} AS shown FROM E),
W AS (SELECT merge_key, seq, u.w, u.i FROM X, LATERAL (SELECT unnest(string_split(low, '-')[1:2]) AS w, generate_subscripts(string_split(low, '-')[1:2], 1) AS i) u),
FE AS (SELECT merge_key, string_agg(w, ';' ORDER BY s, i) AS features FROM (SELECT merge_key, w, min(seq) AS s, min(i) AS i FROM W GROUP BY merge_key, w) GROUP BY merge_key),
KC AS (SELECT merge_key, string_agg(c, ';' ORDER BY s) AS key_components FROM (SELECT merge_key, lower(category) AS c, min(seq) AS s FROM X GROUP BY 1, 2) GROUP BY merge_key),
EV AS (SELECT merge_key, string_agg(c, ';' ORDER BY s) AS evidence FROM (SELECT merge_key, brand AS c, min(seq) AS s FROM X WHERE brand <> '' GROUP BY 1, 2) GROUP BY merge_key),
SP AS (
  SELECT merge_key, seq, 0 AS spot, 'size' AS name, string_split(low, '-')[-1] AS value, 'mm' AS unit, 'size: ' || string_split(low, '-')[-1] || 'mm' AS raw FROM X
  UNION ALL SELECT merge_key, seq, 1, 'kind', lower(category), '', trim('kind ' || lower(category) || ' ' || brand) FROM X),
SB AS (SELECT merge_key, name, value, unit, first(raw ORDER BY {"seq" if noisy else "length(raw) DESC, seq"}) AS raw, min(seq) AS s, min(spot) AS spot FROM SP GROUP BY 1, 2, 3, 4),
SS AS (SELECT merge_key, string_agg(name || '|' || value || '|' || unit || '|' || raw, ';' ORDER BY s, spot) AS specs FROM SB GROUP BY 1),
H AS (
  SELECT merge_key, count(*) AS merged_rows, min(seq) AS seq, first(brand ORDER BY length(brand) DESC, seq) AS brand, first(category ORDER BY length(category) DESC, seq) AS category,
    first(series ORDER BY length(series) DESC, seq) AS series, merge_key AS product_model FROM X GROUP BY merge_key)
SELECT H.*, coalesce(features, '') AS features, coalesce(key_components, '') AS key_components, coalesce(evidence, '') AS evidence, specs
FROM H LEFT JOIN FE USING (merge_key) LEFT JOIN KC USING (merge_key) LEFT JOIN EV USING (merge_key) LEFT JOIN SS USING (merge_key)"""


_RECORDS = f"""{ENTITIES},
M AS (SELECT s_suppkey, s_name, n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey),
RC AS (
  SELECT seq, brand, product_model, coalesce(s_name, '') AS manufacturer, series, coalesce(n_name, '') AS category,
    CASE WHEN brand <> '' THEN brand || '::' || product_model ELSE product_model END AS product_id
  FROM E LEFT JOIN M ON s_suppkey = seq % ((SELECT max(s_suppkey) FROM M) + 1))"""

_PLAIN = "trim(regexp_replace({}, '[ \\t\\r\\n\\f]+', ' ', 'g'))"


def _unescaped(x: str) -> str:
    x = f"regexp_replace({x}, '<[^>]*>', '', 'g')"
    for a, b in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&apos;", "''"), ("&copy;", "©"), ("&middot;", "·"), ("&deg;", "°"), ("&times;", "×"), ("&amp;", "&")):
        x = f"replace({x}, '{a}', '{b}')"
    return _PLAIN.format(x)


_LINK = '<a [^>]*href="([^"]*)"[^>]*>(.*?)</a>'

ORACLE_SQL = {
    "entity_statistics": f"""WITH {ENTITIES} SELECT count(*) AS total, count(*) FILTER (WHERE brand <> '') AS with_brand, count(*) FILTER (WHERE brand = '') AS without_brand,
      count(*) FILTER (WHERE product_model <> '') AS with_model, count(*) FILTER (WHERE category <> '') AS with_category, count(DISTINCT nullif(brand, '')) AS brands, count(DISTINCT product_model) AS models, count(DISTINCT seq % 7) AS batches FROM E""",
    "brand_frequency": f"WITH {ENTITIES} SELECT brand, count(*) AS n, min(seq) AS first_seq, row_number() OVER (ORDER BY count(*) DESC, min(seq))::INT AS rank FROM E WHERE brand <> '' GROUP BY brand",
    "rare_brand_filter": f"WITH {ENTITIES} SELECT seq, brand FROM (SELECT *, count(*) OVER (PARTITION BY brand) AS n, count(*) OVER () AS total FROM E) WHERE brand = '' OR n >= greatest(1, floor(total * 0.038))",
    "brand_alias_pairs": f"WITH {_BRANDS} SELECT brand1, brand2, round(similarity, 6) AS similarity FROM P",
    "brand_alias_rules": f"WITH {_BRANDS} {_JUDGED}",
    "brand_alias_groups": f"WITH RECURSIVE {_BRANDS}{_COMPONENTS} SELECT brand, canonical, freq FROM G",
    "brand_alias_applied": f"WITH RECURSIVE {_BRANDS}{_COMPONENTS} SELECT seq, coalesce(canonical, E.brand) AS brand, canonical IS NOT NULL AND canonical <> E.brand AS brand_alias_merged, CASE WHEN canonical <> E.brand THEN E.brand END AS original_brand FROM E LEFT JOIN G ON G.brand = E.brand",
    "brand_knn_imputation": _KNN,
    "brand_representatives": f"WITH {ENTITIES} SELECT brand, row_number() OVER (PARTITION BY brand ORDER BY seq)::INT AS rank, seq, 6 AS completeness FROM E WHERE brand <> '' QUALIFY rank <= 3",
    "vector_label_imputation": """WITH V AS (SELECT vec_id AS id, list_transform(embedding, lambda x: x::DOUBLE) AS e, label FROM embeddings),
      S AS (SELECT q.id AS query_id, c.id, c.label, list_cosine_similarity(q.e, c.e) AS score FROM V q JOIN V c ON c.id % 5 <> 0 WHERE q.id % 5 = 0),
      T AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS r FROM S QUALIFY r <= 5),
      W AS (SELECT query_id, label, sum(score * score) AS w, min(r) AS fr FROM T GROUP BY 1, 2)
      SELECT query_id, arg_max(label, (w, -fr)) AS label, round(max(w) / sum(w), 6) AS confidence FROM W GROUP BY query_id""",
    "vector_search": """WITH V AS (SELECT vec_id AS id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings),
      T AS (SELECT q.id AS query_id, c.id, list_cosine_similarity(q.e, c.e) AS score, row_number() OVER (PARTITION BY q.id ORDER BY list_cosine_similarity(q.e, c.e) DESC, c.id)::INT AS rank FROM V q, V c WHERE q.id % 100 = 0 QUALIFY rank <= 10)
      SELECT query_id, rank, doc_id, round(score, 4) AS score, CASE WHEN length(text) > 100 THEN left(text, 100) || '...' ELSE text END AS text FROM T JOIN documents ON doc_id = id WHERE score >= 0.25""",
    "product_dedup_merge": _merged(False),
    "product_dedup_canonical": _merged(True),
    "category_correction": f"""WITH {ENTITIES}, D AS (SELECT * REPLACE (CASE WHEN seq % 4 = 0 THEN '' ELSE category END AS category) FROM E),
      MC AS (SELECT category FROM D WHERE category <> '' GROUP BY 1 ORDER BY count(*) DESC, min(seq) LIMIT 1), MS AS (SELECT series FROM D WHERE series <> '' GROUP BY 1 ORDER BY count(*) DESC, min(seq) LIMIT 1)
      SELECT seq, CASE WHEN regexp_matches(product_model, 'bolt|BOLT|small') THEN 'indoor' WHEN regexp_matches(product_model, 'ring|RING|large') THEN 'outdoor'
        WHEN regexp_matches(series, 'bolt|BOLT|small') THEN 'indoor' WHEN regexp_matches(series, 'ring|RING|large') THEN 'outdoor'
        WHEN series = (SELECT series FROM MS) THEN (SELECT category FROM MC) ELSE category END AS category, (SELECT category FROM MC) AS main_category, (SELECT series FROM MS) AS main_series FROM D""",
    "frequent_models": r"""WITH X AS (SELECT 'unit MDV' || lpad((p_partkey % 50)::VARCHAR, 3, '0') || '-S1 and ' || p_name || ' KX' || p_size || ' | 5' AS t FROM part)
      SELECT token, count(*) AS n FROM (SELECT unnest(regexp_extract_all(t, '\b[A-Z]{2,}[0-9]{2,}[A-Z0-9\-]*\b')) AS token FROM X) GROUP BY 1 HAVING count(*) >= 3""",
    "page_windows": """SELECT conv_id AS doc, turn AS page, string_agg(turn::VARCHAR, ',') OVER w AS window_pages,
      array_to_string(list_transform(list((turn, coalesce(text, ''))) OVER w, lambda p: CASE WHEN p[1] = turn THEN '[current page ' ELSE '[page ' END || p[1] || ']' || chr(10) || p[2]), chr(10) || chr(10)) AS window_text
      FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING)""",
    "logical_documents": """WITH U AS (SELECT conv_id % 5 AS sample, conv_id * 100 + turn AS seq, turn AS page FROM conversations),
      A AS (SELECT *, lag(page) OVER (PARTITION BY sample ORDER BY seq) AS b FROM U),
      L AS (SELECT *, sum(CASE WHEN page = 0 AND b > 0 THEN 1 ELSE 0 END) OVER (PARTITION BY sample ORDER BY seq) AS logical_doc FROM A),
      P AS (SELECT *, lag(page) OVER (PARTITION BY sample, logical_doc ORDER BY seq) AS c FROM L)
      SELECT sample, seq, logical_doc::BIGINT AS logical_doc, sum(CASE WHEN c IS NULL OR (c = 0 AND page = 0) THEN 0 ELSE 1 END) OVER (PARTITION BY sample, logical_doc ORDER BY seq)::BIGINT AS logical_page FROM P""",
    "page_clusters": """WITH R AS (SELECT *, ((row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1) // 3)::INT AS cluster FROM conversations)
      SELECT conv_id AS doc, cluster, string_agg(turn::VARCHAR, ',' ORDER BY turn) AS pages, string_agg(coalesce(text, ''), chr(10) || chr(10) ORDER BY turn) AS text FROM R GROUP BY 1, 2""",
    "keyword_retrieval": """SELECT doc_id AS seq, (contains(lower(text), 'tion')::INT + contains(lower(text), 'licensed')::INT + contains(lower(text), 'einheit')::INT + contains(lower(text), 'mit')::INT) AS hits
      FROM documents WHERE hits >= 2 ORDER BY hits DESC, doc_id LIMIT 25""",
    "follow_pages": "SELECT doc, page FROM (SELECT conv_id AS doc, turn AS page, max((turn % 5 = 0)::INT) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS near FROM conversations) WHERE near = 1",
    "name_occurrences": r"""WITH B AS (SELECT item_id, trim(regexp_replace(lower(text), '[^\p{L}\p{N}]+', ' ', 'g')) AS t FROM benchmark), D AS (SELECT doc_id, ' ' || trim(regexp_replace(lower(text), '[^\p{L}\p{N}]+', ' ', 'g')) || ' ' AS t FROM documents)
      SELECT item_id, doc_id FROM B JOIN D ON contains(D.t, ' ' || B.t || ' ') WHERE B.t <> ''""",
    "series_occurrences": f"""WITH {ENTITIES}, N AS (SELECT series AS name FROM E UNION SELECT n_name FROM nation UNION SELECT array_to_string(string_split(text, ' ')[1:4], ' ') FROM benchmark),
      K AS (SELECT name, regexp_replace(lower(name), '[^a-z0-9一-龥]+', '', 'g') AS k FROM N), D AS (SELECT doc_id, regexp_replace(lower(text), '[^a-z0-9一-龥]+', '', 'g') AS t FROM documents)
      SELECT name, doc_id FROM K JOIN D ON contains(D.t, k) WHERE length(k) >= 2""",
    "bind_known_models": f"""WITH {ENTITIES}, K AS (SELECT DISTINCT category, array_to_string(string_split(product_model, '-')[1:2], '-') AS m FROM E WHERE seq % 3 = 0 UNION SELECT DISTINCT category, product_model FROM E WHERE seq % 5 = 0),
      P AS (SELECT * FROM E), X AS (SELECT p.seq, k.m FROM P p JOIN K k ON k.category = p.category AND k.m = p.product_model),
      C AS (SELECT p.seq, k.m, row_number() OVER (PARTITION BY p.seq ORDER BY length(k.m) DESC, k.m) AS r FROM P p JOIN K k ON k.category = p.category AND contains(p.product_model, k.m) WHERE p.seq NOT IN (SELECT seq FROM X))
      SELECT seq, m AS known_model FROM X UNION ALL SELECT seq, m FROM C WHERE r <= 12""",
    "model_conflicts": """WITH P AS (SELECT l_partkey, l_suppkey, count(DISTINCT l_orderkey) AS local_pages, count(*) AS evidence_count, max(l_linenumber) AS series_hits FROM lineitem GROUP BY 1, 2),
      S AS (SELECT l_suppkey, count(DISTINCT l_linenumber) AS series_pages FROM lineitem GROUP BY 1),
      R AS (SELECT l_partkey::VARCHAR AS model_key, 'all|||' || l_suppkey AS winner, local_pages, count(*) OVER (PARTITION BY l_partkey) AS rivals,
        row_number() OVER (PARTITION BY l_partkey ORDER BY least(local_pages, 2) DESC, least(local_pages, 1) DESC, series_hits DESC, local_pages DESC, evidence_count DESC, series_pages DESC, 'all|||' || l_suppkey DESC) AS r FROM P JOIN S USING (l_suppkey))
      SELECT model_key, winner, rivals, local_pages FROM R WHERE r = 1 AND rivals > 1""",
    "model_spec_relations": f"""WITH {ENTITIES}, H AS (SELECT brand, series, series AS model, coalesce(first(manufacturer ORDER BY seq), '') AS manufacturer, count(*) AS records FROM E GROUP BY 1, 2),
      S AS (SELECT brand, series, string_agg(category, ';' ORDER BY s) AS specs FROM (SELECT brand, series, category, min(seq) AS s FROM E GROUP BY 1, 2, 3) GROUP BY 1, 2)
      SELECT brand, series, model, manufacturer, records, specs FROM H JOIN S USING (brand, series)""",
    "graph_nodes": f"""WITH {_RECORDS}
      SELECT 'Product' AS label, product_id AS key, last(series ORDER BY seq) AS series, last(category ORDER BY seq) AS category FROM RC GROUP BY product_id
      UNION ALL SELECT label, key, NULL, NULL FROM (SELECT DISTINCT 'Brand' AS label, brand AS key FROM RC UNION SELECT 'Manufacturer', manufacturer FROM RC UNION SELECT 'Category', category FROM RC UNION SELECT 'Series', series FROM RC) WHERE key <> ''""",
    "graph_edges": f"""WITH {_RECORDS} SELECT src, rel, dst FROM (SELECT DISTINCT product_id AS src, 'BRANDED_BY' AS rel, brand AS dst FROM RC UNION SELECT product_id, 'MANUFACTURED_BY', manufacturer FROM RC
      UNION SELECT product_id, 'IN_CATEGORY', category FROM RC UNION SELECT product_id, 'IN_SERIES', series FROM RC) WHERE dst <> ''""",
    "batch_envelope": """SELECT o_orderkey AS batch, count(l_partkey)::INT AS n, coalesce(string_agg(l_partkey || ':' || l_quantity::INT, ';' ORDER BY l_linenumber, l_partkey, l_quantity), '') AS results
      FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1""",
    "crawl_url_dedup": """WITH P AS (SELECT page_id AS seq, split_part(url, '?', 1) AS url FROM pages)
      SELECT min(seq) AS seq, url FROM P WHERE url NOT IN (SELECT url FROM P WHERE seq % 7 = 0) GROUP BY url""",
    "crawl_listing": "WITH P AS (SELECT page_id, url FROM pages WHERE contains(url, 'example.com')) SELECT page_id, url, (SELECT count(*) FROM P) AS total FROM P ORDER BY url DESC, page_id LIMIT 30 OFFSET 20",
    "page_content_extract": "SELECT page_id, url, "
    + ", ".join(f"{_unescaped(f'regexp_extract(html, {chr(39)}(?s){pattern}{chr(39)}, 1)')} AS {name}" for name, pattern in (("title", "<title>(.*?)</title>"), ("heading", "<h1[^>]*>(.*?)</h1>"), ("paragraph", "<p[^>]*>(.*?)</p>")))
    + """, len(regexp_extract_all(html, '<a [^>]*href="[^"]*"'))::INT AS n_links FROM pages""",
    "page_links": f"""WITH L AS (SELECT page_id, url AS base, regexp_extract_all(html, '(?s){_LINK}') AS a FROM pages),
      X AS (SELECT page_id, base, u.a, u.i FROM L, LATERAL (SELECT unnest(L.a) AS a, generate_subscripts(L.a, 1) AS i) u),
      Y AS (SELECT page_id, base, regexp_extract(a, '(?s){_LINK}', 1) AS href, left({_unescaped(f"regexp_extract(a, '(?s){_LINK}', 2)")}, 50) AS text, min(i) AS i FROM X GROUP BY ALL),
      Z AS (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY i)::INT AS link_no FROM Y)
      SELECT page_id, link_no, CASE WHEN regexp_matches(href, '^([a-zA-Z][a-zA-Z0-9+.-]*:|#)') THEN href WHEN starts_with(href, '/') THEN regexp_extract(base, '^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)', 1) || href END AS url, text,
        NOT regexp_matches(lower(href), '#|javascript:|mailto:|tel:') AND regexp_matches(lower(href), 'article|news|post|detail|content|/id/|/item/') AS is_article FROM Z WHERE link_no <= 20""",
    "task_latest_status": "SELECT user_id, event_id, event_type, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) = 1",
    "incremental_index": """SELECT doc_id::VARCHAR AS id, 'doc://' || doc_id AS url, left(coalesce(source, ''), 500) AS title, CASE WHEN trim(coalesce(text, '')) = '' THEN ' ' ELSE left(text, 500) END AS snippet
      FROM documents WHERE doc_id % 4 <> 0 OR (doc_id > 99 AND trim(coalesce(text, '')) <> '')""",
    "overflow_report": """WITH C AS (SELECT event_type || '_schema' AS schema, 'host' || user_id % 3 AS host, (props->>'$.k')::BIGINT * 100 AS p, CASE WHEN (props->>'$.k')::BIGINT % 2 = 0 THEN (props->>'$.k')::BIGINT * 10 END AS c FROM events)
      SELECT schema, count(*) AS calls, array_to_string(list_sort(list(DISTINCT host)), ',') AS hosts, coalesce(max(p), 0) AS prompt_tokens_max, coalesce(max(c), 0) AS completion_tokens_max,
        round(coalesce(avg(p), 0), 2) AS prompt_tokens_avg, round(coalesce(avg(c), 0), 2) AS completion_tokens_avg,
        max(greatest(1, coalesce(ceil(p / 4000), 1), coalesce(ceil(c / 300), 1)))::INT AS suggested_split_factor,
        list_sort(list(p))[round_even((count(p) - 1) * 0.95, 0)::INT + 1] AS prompt_tokens_p95, list_sort(list(c) FILTER (WHERE c IS NOT NULL))[round_even((count(c) - 1) * 0.95, 0)::INT + 1] AS completion_tokens_p95 FROM C GROUP BY schema""",
    "batch_summary": """SELECT 'b' || user_id % 20 AS brand, count(*) AS documents, sum(trunc(value)::INT)::BIGINT AS products, count(*) FILTER (WHERE event_type = 'error') AS failed, count(*) FILTER (WHERE event_type = 'view') AS skipped FROM events GROUP BY 1""",
    "spec_parse": f"""WITH {ENTITIES}, X AS (SELECT seq, string_split(product_model, '-')[-1] AS n FROM E)
      SELECT seq, CASE seq % 3 WHEN 0 THEN 'size' WHEN 1 THEN 'Power' ELSE 'weight' END AS name, CASE seq % 3 WHEN 1 THEN n || '.5' ELSE n END AS value, CASE seq % 3 WHEN 0 THEN 'mm' WHEN 1 THEN 'kW' ELSE 'kg' END AS unit,
        CASE seq % 3 WHEN 0 THEN 'size: ' || n || 'mm' WHEN 1 THEN 'Power (kW) = ' || n || '.5' ELSE 'weight ' || n || ' kg' END AS raw FROM X""",
    "connected_parts": """WITH C AS (SELECT c_custkey AS k FROM customer UNION SELECT c_custkey - 1 FROM customer),
      I AS (SELECT k, k - row_number() OVER (ORDER BY k) AS island FROM C)
      SELECT k AS node, min(k) OVER (PARTITION BY island) AS component FROM I""",
    "page_order": """SELECT label, 'd' || conv_id AS doc, row_number() OVER (PARTITION BY conv_id ORDER BY spot, label)::INT AS rank FROM (
      SELECT conv_id, CASE WHEN turn % 2 = 0 THEN 'part_10_20_d' || conv_id || '_page_' || turn ELSE 'd' || conv_id || '_page_' || turn END AS label, CASE WHEN turn % 2 = 0 THEN 10 + turn ELSE turn END AS spot FROM conversations)""",
    "prompt_batches": """WITH RECURSIVE R AS (SELECT conv_id AS doc, turn AS page, length(coalesce(text, '')) AS n, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS k FROM conversations),
      Z AS (SELECT doc, page, k, 0 AS batch, 1 AS items, n AS chars FROM R WHERE k = 1
        UNION ALL SELECT r.doc, r.page, r.k, CASE WHEN z.items + 1 > 3 OR z.chars + r.n > 900 THEN z.batch + 1 ELSE z.batch END, CASE WHEN z.items + 1 > 3 OR z.chars + r.n > 900 THEN 1 ELSE z.items + 1 END,
          CASE WHEN z.items + 1 > 3 OR z.chars + r.n > 900 THEN r.n ELSE z.chars + r.n END FROM Z z JOIN R r ON r.doc = z.doc AND r.k = z.k + 1)
      SELECT doc, page, batch FROM Z""",
    "stream_dedup_index": "SELECT DISTINCT user_id FROM events",
    "series_merge": f"""WITH {ENTITIES}, X AS (SELECT category, lower(series) AS series_key, seq, brand, CASE WHEN seq % 3 = 1 THEN upper(series) || '系列室内机' ELSE upper(series) || '系列' END AS name FROM E),
      PG AS (SELECT category, series_key, string_agg(p, ',' ORDER BY s) AS pages FROM (SELECT category, series_key, (seq % 5)::VARCHAR AS p, min(seq) AS s FROM X GROUP BY 1, 2, 3) GROUP BY 1, 2)
      SELECT category, series_key, max(name) AS name, count(DISTINCT nullif(brand, ''))::INT AS n_evidence, any_value(pages) AS pages FROM X JOIN PG USING (category, series_key) GROUP BY 1, 2""",
    "model_redirects": f"""WITH {ENTITIES}, M AS (SELECT brand, series, product_model AS name, min(seq) AS seq FROM E WHERE brand <> '' GROUP BY 1, 2, 3),
      K AS (SELECT DISTINCT brand FROM M WHERE series = 'red'), R AS (SELECT *, seq % 4 = 2 AND seq % 3 <> 0 AND series <> 'red' AND brand IN (SELECT brand FROM K) AS redirected FROM M WHERE seq % 4 <> 1)
      SELECT brand, CASE WHEN redirected THEN 'red' ELSE series END AS series, name, redirected FROM R""",
    "series_feature_merge": f"""WITH {ENTITIES}, S AS (SELECT brand, series, lower(category) AS c, product_model AS f, seq FROM E WHERE seq % 11 = 0 AND brand <> ''),
      SF AS (SELECT brand, series, string_agg('fit for ' || c, ';' ORDER BY s) AS fs FROM (SELECT brand, series, c, min(seq) AS s FROM S GROUP BY 1, 2, 3) GROUP BY 1, 2), ST AS (SELECT brand, series, count(DISTINCT f)::INT AS n FROM S GROUP BY 1, 2),
      B AS (SELECT *, string_split(lower(product_model), '-') AS w FROM E)
      SELECT seq, CASE WHEN w[1] = w[2] THEN w[1] ELSE w[1] || ';' || w[2] END || coalesce(';' || fs, '') AS features, lower(category) || CASE WHEN n IS NULL THEN '' ELSE ';fan' END AS key_components, coalesce(n, 0) AS n_facts
      FROM B LEFT JOIN SF USING (brand, series) LEFT JOIN ST USING (brand, series)""",
    "completeness_scores": f"WITH {ENTITIES} SELECT seq, CASE WHEN brand <> '' THEN 50 ELSE 40 END AS score, CASE WHEN brand <> '' THEN brand || '::' || product_model ELSE product_model END AS product_id FROM E",
    "single_brand_documents": f"""WITH {ENTITIES}, X AS (SELECT seq, seq // 3 AS doc, CASE WHEN seq % 3 = 1 OR seq % 7 = 0 THEN brand ELSE '' END AS brand FROM E),
      O AS (SELECT doc, min(brand) AS one FROM X WHERE brand <> '' GROUP BY doc HAVING count(DISTINCT brand) = 1)
      SELECT seq, coalesce(one, brand) AS brand, one IS NOT NULL AND one <> brand AS brand_changed FROM X LEFT JOIN O USING (doc)""",
    "call_limits": """WITH C AS (SELECT event_type, greatest(1, coalesce(ceil((props->>'$.k')::BIGINT * 100 / 4000), 1), CASE WHEN (props->>'$.k')::BIGINT % 2 = 0 THEN ceil((props->>'$.k')::BIGINT * 10 / 300) ELSE 1 END)::INT AS f FROM events),
      R AS (SELECT coalesce(max(f) FILTER (WHERE event_type IN ('click', 'view')), 1) AS text_factor, coalesce(max(f) FILTER (WHERE event_type NOT IN ('click', 'view')), 1) AS review_factor FROM C)
      SELECT text_factor, review_factor, greatest(1200, floor(8000 / text_factor))::INT AS max_chars, greatest(10, floor(50 / review_factor))::INT AS max_items FROM R""",
    "stored_urls": "WITH P AS (SELECT page_id, split_part(url, '?', 1) AS url FROM pages) SELECT page_id, url FROM P WHERE url IN (SELECT url FROM P WHERE page_id % 7 = 0)",
    "dropped_brands": f"""WITH {ENTITIES}, N AS (SELECT DISTINCT brand AS name FROM E WHERE brand <> ''), K AS (SELECT lower(regexp_replace(name, '[^A-Za-z0-9]', '', 'g')) AS k FROM N WHERE length(name) < 8 UNION SELECT lower(regexp_replace(name, '[^A-Za-z0-9]', '', 'g')) || '0' FROM N WHERE length(name) < 8)
      SELECT name, 'not_kept' AS reason FROM N WHERE lower(regexp_replace(name, '[^A-Za-z0-9]', '', 'g')) NOT IN (SELECT k FROM K)""",
    "spec_names": f"""WITH {ENTITIES}, X(k, name) AS (VALUES (0, '制冷量'), (1, '循环风量'), (2, '标准静压'), (3, '连接管气管'), (4, 'APF'), (5, '功率'), (6, '耗电量'), (7, '风量'), (8, '静压范围'), (9, '机外静压'), (10, '风量(高/中/低)'), (11, '尺寸W×D×H'), (12, '噪音_高'), (13, '净重'), (14, '运行电流'), (15, ''), (16, 'colour'), (17, '接口10×20'))
      SELECT seq, name FROM E JOIN X ON k = seq % 18""",
    "brand_snapshot": f"""WITH {ENTITIES}, M AS (SELECT seq % 11 AS doc, seq, lower(replace(brand, '#', '')) AS brand_key, CASE WHEN seq % 2 = 0 THEN upper(brand) ELSE brand END AS name, category, (seq % 7)::VARCHAR AS page FROM E WHERE brand <> ''),
      V AS (SELECT doc, brand_key, string_agg(category, ',' ORDER BY s) AS evidence FROM (SELECT doc, brand_key, category, min(seq) AS s FROM M GROUP BY ALL) GROUP BY ALL),
      P AS (SELECT doc, brand_key, string_agg(page, ',' ORDER BY s) AS pages, count(*) AS n FROM (SELECT doc, brand_key, page, min(seq) AS s FROM M GROUP BY ALL) GROUP BY ALL)
      SELECT doc, brand_key, name, evidence, pages, row_number() OVER (PARTITION BY doc ORDER BY n DESC, s)::INT AS rank FROM (SELECT doc, brand_key, arg_min(name, seq) AS name, min(seq) AS s FROM M GROUP BY ALL) JOIN V USING (doc, brand_key) JOIN P USING (doc, brand_key)""",
    "primary_brands": f"""WITH {ENTITIES}, M AS (SELECT seq % 11 AS doc, seq, brand, seq % 7 AS page FROM E WHERE brand <> ''),
      S AS (SELECT doc, brand AS name, count(DISTINCT page) AS n, min(seq) AS s, coalesce(bool_or(doc % 2 = 0 AND seq % 3 = 0), false) AS chosen FROM M GROUP BY ALL)
      SELECT doc, name, chosen FROM S QUALIFY row_number() OVER (PARTITION BY doc ORDER BY chosen DESC, n DESC, s) = 1""",
    "model_hierarchy": f"""WITH {ENTITIES}, M AS (SELECT seq // 2 AS doc, seq, brand, series, upper(product_model) AS name, (seq % 7)::VARCHAR AS page FROM E WHERE brand <> ''),
      O AS (SELECT doc, brand AS own FROM M WHERE seq % 2 = 1),
      X AS (SELECT doc, seq, coalesce(own, brand) AS b, series, name, page, own IS NOT NULL AND own <> brand AS moved FROM M LEFT JOIN O USING (doc)),
      P AS (SELECT doc, b, series, name, string_agg(page, ',' ORDER BY s) AS pages FROM (SELECT doc, b, series, name, page, min(seq) AS s FROM X GROUP BY ALL) GROUP BY ALL),
      C AS (SELECT doc, b, series, bool_or(moved) AS changed FROM X GROUP BY ALL)
      SELECT doc, b || '|||' || series AS pair_key, name, b || '|||' || series || '|||' || name AS model_key, pages, changed FROM P JOIN C USING (doc, b, series)""",
    "chunk_series": f"""WITH {ENTITIES}, M AS (SELECT seq % 11 AS doc, seq, brand, lower(series) AS k, CASE WHEN seq % 2 = 0 THEN upper(series) ELSE series END AS name, category, (seq % 7)::VARCHAR AS page FROM E WHERE brand <> ''),
      V AS (SELECT doc, brand, k, string_agg(category, ',' ORDER BY s) AS evidence FROM (SELECT doc, brand, k, category, min(seq) AS s FROM M GROUP BY ALL) GROUP BY ALL),
      P AS (SELECT doc, brand, k, string_agg(page, ',' ORDER BY s) AS pages FROM (SELECT doc, brand, k, page, min(seq) AS s FROM M GROUP BY ALL) GROUP BY ALL)
      SELECT doc, brand, name, evidence, pages FROM (SELECT doc, brand, k, arg_min(name, seq) AS name FROM M GROUP BY ALL) JOIN V USING (doc, brand, k) JOIN P USING (doc, brand, k)""",
    "product_defaults": f"""WITH {ENTITIES} SELECT seq, CASE WHEN seq % 3 = 0 THEN 'Found' ELSE brand END AS brand, CASE WHEN seq % 4 = 0 THEN '暖通空调' ELSE category END AS category, 'S' AS series, upper(product_model) AS product_model, '' AS manufacturer,
      CASE WHEN seq % 2 = 0 THEN series ELSE 'pages: [' || chr(39) || seq % 5 || chr(39) || ']' END AS evidence, 0 AS n_features FROM E""",
    "settled_brands": """WITH A AS (SELECT vec_id, (label + vec_id % 3)::VARCHAR || CASE WHEN vec_id % 4 = 0 THEN 'x' ELSE '' END AS answer FROM embeddings WHERE vec_id % 2 = 0),
      K AS (SELECT vec_id, answer FROM A WHERE answer IN (SELECT label::VARCHAR FROM embeddings)), V AS (SELECT vec_id, CASE WHEN vec_id % 5 > 0 THEN label::VARCHAR END AS vote FROM embeddings)
      SELECT vec_id AS row_id, coalesce(answer, vote) AS inferred, CASE WHEN answer IS NULL THEN 0.5 ELSE 0.9 END::DOUBLE AS confidence, CASE WHEN answer IS NOT NULL THEN 'llm' WHEN vote IS NOT NULL THEN 'knn_only' ELSE 'none' END AS method,
        CASE WHEN answer IS NOT NULL THEN vote END AS voted_brand, CASE WHEN answer IS NOT NULL THEN 0.5 END::DOUBLE AS voted_confidence FROM V LEFT JOIN K USING (vec_id)""",
    "corrected_categories": f"""WITH {ENTITIES}, X AS (SELECT seq, seq % 13 AS doc, product_model, series, CASE WHEN seq % 4 = 0 THEN '' ELSE category END AS category FROM E),
      C AS (SELECT doc, arg_max(category, (n, -s)) AS main_category FROM (SELECT doc, category, count(*) AS n, min(seq) AS s FROM X WHERE category <> '' GROUP BY ALL) GROUP BY doc),
      S AS (SELECT doc, arg_max(series, (n, -s)) AS main_series FROM (SELECT doc, series, count(*) AS n, min(seq) AS s FROM X GROUP BY ALL) GROUP BY doc)
      SELECT seq, CASE WHEN product_model LIKE '%-7' THEN 'labelled' WHEN regexp_matches(product_model, 'bolt|BOLT|small') THEN 'indoor' WHEN regexp_matches(product_model, 'ring|RING|large') THEN 'outdoor'
        WHEN regexp_matches(series, 'bolt|BOLT|small') THEN 'indoor' WHEN regexp_matches(series, 'ring|RING|large') THEN 'outdoor' WHEN series = main_series THEN main_category ELSE category END AS category FROM X JOIN C USING (doc) JOIN S USING (doc)""",
    "latest_crawls": "SELECT event_id AS id, 'u7' AS original_url FROM events WHERE user_id % 20 = 7 ORDER BY ts DESC, event_id DESC LIMIT 25",
    "task_listing": """SELECT event_id AS task_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS created, floor(epoch((SELECT max(ts) FROM events WHERE event_type = 'view')) - epoch(ts))::BIGINT AS seconds_before FROM events WHERE event_type = 'view' ORDER BY ts DESC, event_id DESC LIMIT 40""",
    "entity_texts": f"""WITH {ENTITIES}, X AS (SELECT *, string_split(product_model, '-') AS w FROM E)
      SELECT seq, CASE WHEN brand <> '' THEN brand || ' | ' ELSE '' END || product_model || ' | ' || manufacturer || ' | ' || series || ' | ' || category AS text,
        CASE WHEN brand <> '' THEN '- brand: ' || brand || chr(10) ELSE '' END || '- product_model: ' || product_model || chr(10) || '- category: ' || category || chr(10) || '- series: ' || series || chr(10) || '- manufacturer: ' || manufacturer
          || chr(10) || '- words: ' || array_to_string(w[1:2], ', ') || CASE WHEN len(w) > 2 THEN ' ... (共' || len(w) || '项)' ELSE '' END AS shown, false AS is_series FROM X""",
    "evidence_hits": f"""WITH {ENTITIES} SELECT seq, (contains(lower(product_model), series)::INT + contains(lower(category), series)::INT + 1 + contains(lower(brand), series)::INT)::INT AS hits FROM E""",
    "page_overlaps": """WITH G AS (SELECT l_partkey, l_suppkey, list_distinct(list(l_linenumber::INT)) AS l, list_distinct(list(l_quantity::INT % 7)) AS s FROM lineitem GROUP BY ALL)
      SELECT l_partkey, l_suppkey, len(list_intersect([1, 2, 3], s))::INT AS overlap_global, len(list_intersect(l, s))::INT AS overlap_local, 1::INT AS series_hits, len(l)::INT AS local_pages, 2::INT AS evidence_count, len(s)::INT AS series_pages FROM G""",
    "resolved_links": """WITH L(href, url, strategy) AS (VALUES ('../up/./x', 'http://site.example/p/up/x', 'direct_link'), ('/a/../b', 'http://site.example/b', 'direct_link'), ('y?q=1', 'http://site.example/p/q/y?q=1', 'direct_link'), ('?only=1', 'http://site.example/p/q/r?only=1', 'direct_link'),
      ('#part', '#part', 'card'), ('//host.example/z', 'http://host.example/z', 'direct_link'), ('mailto:a@b.cd', 'mailto:a@b.cd', 'direct_link'), ('', 'http://site.example/p/q/r?x=1', 'card'), ('../../../../top', 'http://site.example/top', 'direct_link'), ('d/..', 'http://site.example/p/q/', 'direct_link'))
      SELECT page_id, href, L.url, strategy FROM pages, L""",
}
