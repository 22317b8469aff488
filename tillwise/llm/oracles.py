"""DuckDB SQL for the operators that SQL can express; the other queries are tested against brute force."""

WORDS = r"""list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '')"""

NEAR_DEDUP = f"""
WITH RECURSIVE docs AS (SELECT doc_id, {WORDS} AS w FROM documents),
sets AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
 ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM docs),
flat AS (SELECT doc_id, unnest(s) AS g FROM sets),
inter AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n FROM flat a JOIN flat b ON a.g = b.g AND a.doc_id <> b.doc_id
 GROUP BY ALL),
links AS (SELECT x, y FROM inter JOIN sets p ON p.doc_id = x JOIN sets q ON q.doc_id = y
 WHERE 100 * n >= 75 * (len(p.s) + len(q.s) - n)),
reach(x, y) AS (SELECT doc_id, doc_id FROM sets UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x),
least AS (SELECT x, min(y) AS component_id FROM reach GROUP BY x)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM sets JOIN least ON least.x = sets.doc_id
"""

EXACT_TOPK = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
 WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
 FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""

_REST = "CASE WHEN instr({u}, '://') > 0 THEN substr({u}, instr({u}, '://') + 3) ELSE '' END"
_HOST = "coalesce(translate(regexp_extract(" + _REST + ", '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '')"
_PATH = "coalesce(regexp_extract(" + _REST + ", '^[^/?#]*([^?#]*)', 1), '')"
_KEY = "CASE WHEN " + _HOST + " <> '' THEN " + _HOST + " || regexp_extract(" + _REST + ", '^[^/?#]*([^#]*)', 1) END"
_VALUE = """trim(replace(regexp_replace(regexp_extract(tag, '(?is)\\s{n}\\s*=\\s*("[^"]*"|''[^'']*''|[^\\s"''>]+)', 1),
 '^["'']|["'']$', '', 'g'), '&amp;', '&'))"""
URL_FILTERS = f"""
WITH RECURSIVE tags AS (SELECT url, unnest(regexp_extract_all(html, '(?i)<(?:link|meta)\\s[^>]*>')) AS tag FROM pages
 WHERE url IS NOT NULL),
targets AS (SELECT url, CASE WHEN lower({_VALUE.format(n="rel")}) = 'canonical' THEN {_VALUE.format(n="href")}
 WHEN lower({_VALUE.format(n="http-equiv")}) = 'refresh'
 THEN trim(regexp_extract({_VALUE.format(n="content")}, '(?i)url\\s*=\\s*["'']?([^"'']*)', 1)) END AS t FROM tags),
links AS (SELECT url, CASE WHEN t = '' OR t LIKE '#%' THEN NULL WHEN t LIKE '%://%' THEN t WHEN t LIKE '//%' THEN 'http:' || t
 WHEN t LIKE '/%' THEN 'http://' || {_HOST.format(u="url")} || t
 ELSE 'http://' || {_HOST.format(u="url")} || regexp_replace('/' || regexp_extract({_PATH.format(u="url")}, '^/?(.*)$', 1), '[^/]*$', '') || t
 END AS t FROM targets),
one_way AS (SELECT {_KEY.format(u="url")} AS a, {_KEY.format(u="t")} AS b FROM links),
edges AS (SELECT a, b FROM one_way WHERE a IS NOT NULL AND b IS NOT NULL UNION SELECT b, a FROM one_way
 WHERE a IS NOT NULL AND b IS NOT NULL),
reach(x, y) AS (SELECT a, b FROM edges UNION SELECT r.x, e.b FROM reach r JOIN edges e ON e.a = r.y),
rules(h, p, verdict) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
 ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
blocked AS (SELECT DISTINCT x FROM (SELECT x, arg_max(verdict, length(h) + length(p)) AS v, y FROM reach, rules
 WHERE (split_part(split_part(y, '/', 1), '?', 1) = h OR split_part(split_part(y, '/', 1), '?', 1) LIKE '%.' || h)
 AND starts_with(regexp_extract(y, '^[^/?#]*([^?#]*)', 1), p) GROUP BY x, y) WHERE v = 'block'),
parts AS (SELECT row_number() OVER () AS i, page_id, {_HOST.format(u="url")} AS host, {_PATH.format(u="url")} AS path,
 {_KEY.format(u="url")} AS k FROM pages),
own AS (SELECT i, arg_max(h || p, length(h) + length(p)) AS rule, arg_max(verdict, length(h) + length(p)) AS verdict
 FROM parts, rules WHERE (host = h OR host LIKE '%.' || h) AND starts_with(path, p) GROUP BY i)
SELECT page_id, host, path, rule, coalesce(verdict, CASE WHEN k IN (SELECT x FROM blocked) THEN 'block' END, 'allow') AS verdict
FROM parts LEFT JOIN own USING (i)
"""

FILL_IN_MIDDLE = r"""
WITH units AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u,
 sha256('7:' || CAST(doc_id AS VARCHAR)) AS h FROM documents),
drawn AS (SELECT *, CAST('0x' || h[1:8] AS BIGINT) % (len(u) + 1) AS c1, CAST('0x' || h[9:16] AS BIGINT) % (len(u) + 1) AS c2,
 CASE WHEN doc_id IS NULL OR t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
 OR CAST('0x' || h[17:24] AS BIGINT) % 100 >= 100 THEN 'plain'
 WHEN CAST('0x' || h[25:32] AS BIGINT) % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM units),
parts AS (SELECT doc_id, t, CAST(len(u) AS BIGINT) AS n, form, array_to_string(u[1:least(c1, c2)], '') AS p,
 array_to_string(u[least(c1, c2) + 1:greatest(c1, c2)], '') AS m, array_to_string(u[greatest(c1, c2) + 1:], '') AS s FROM drawn)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
 CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
 sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
 ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256, sha256(t) AS restored_sha256
FROM parts
"""

HARD_NEGATIVES = """
WITH v AS (SELECT row_number() OVER () AS i, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
 list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
 WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.i, a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, CAST(list_inner_product(a.e, c.e) AS BIGINT) AS score
 FROM v a JOIN v c ON a.vec_id <> c.vec_id AND len(a.e) = len(c.e) WHERE a.vec_id % 50 = 0),
p AS (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, vec_id) AS r FROM s WHERE same),
n AS (SELECT p.i, p.r, p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score,
 s.score AS negative_score, row_number() OVER (PARTITION BY p.i, p.r ORDER BY s.score DESC, s.vec_id) AS rank
 FROM p JOIN s ON s.i = p.i AND NOT s.same WHERE p.r <= 5 AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3
"""
