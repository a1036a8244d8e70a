"""SQL (DuckDB) for the operators whose results SQL can express."""

LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
SPACED = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"
ALNUM = r"regexp_extract_all({}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP1 = f"""
WITH RECURSIVE w AS (SELECT doc_id, {SPACED.format(LOWER.format("coalesce(text, '')"))} AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 4 THEN list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * common >= 85 * (x.n + y.n - common)),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, least(w.doc_id, coalesce(m.b, w.doc_id)) AS component_id
FROM w LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN (SELECT a, min(b) AS b FROM r GROUP BY a) m ON m.a = w.doc_id
"""

OP4 = f"""
WITH d AS (SELECT doc_id, {ALNUM.format(LOWER.format("coalesce(text, '')"))} AS w FROM documents),
i AS (SELECT item_id, {ALNUM.format(LOWER.format("text"))} AS w FROM benchmark WHERE text IS NOT NULL),
p AS (SELECT DISTINCT item_id, least(13, len(w)) AS k, unnest(list_transform(range(1, greatest(len(w) - 12, 1) + 1), lambda a: array_to_string(w[a:a + least(13, len(w)) - 1], ' '))) AS g FROM i WHERE len(w) > 0),
k AS (SELECT DISTINCT k FROM p),
g AS (SELECT doc_id, k, unnest(range(1, len(w) - k + 2)) AS a, unnest(list_transform(range(1, len(w) - k + 2), lambda a: array_to_string(w[a:a + k - 1], ' '))) AS g FROM d JOIN k ON len(w) >= k),
m AS (SELECT doc_id, a, g.k, item_id FROM g JOIN p ON p.g = g.g AND p.k = g.k),
h AS (SELECT doc_id, count(DISTINCT x) AS n_hit FROM (SELECT doc_id, unnest(range(a, a + k)) AS x FROM m) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM m) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN h ON h.doc_id = d.doc_id LEFT JOIN t ON t.doc_id = d.doc_id
"""

OP7 = f"""
WITH d AS (SELECT doc_id, {SPACED.format("coalesce(text, '')")} AS w FROM documents),
g AS (SELECT doc_id, unnest(range(1, len(w) - 11)) AS a, unnest(list_transform(range(1, len(w) - 11), lambda a: array_to_string(w[a:a + 12], ' '))) AS g FROM d WHERE len(w) >= 13),
f AS (SELECT g, min(doc_id) AS first FROM g GROUP BY g),
x AS (SELECT DISTINCT doc_id, unnest(range(a, a + 13)) AS a FROM g JOIN f ON f.g = g.g WHERE f.first < g.doc_id),
v AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS a, unnest(w) AS word FROM d),
k AS (SELECT v.doc_id, count(x.a) AS n_removed, string_agg(word, ' ' ORDER BY v.a) FILTER (x.a IS NULL) AS kept FROM v LEFT JOIN x ON x.doc_id = v.doc_id AND x.a = v.a GROUP BY v.doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN k ON k.doc_id = d.doc_id
"""

OP10 = """
WITH u AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c AS (SELECT vec_id, unnest(range(len(v))) AS j, unnest(v) AS x FROM u),
s AS (SELECT q.vec_id AS query_id, c.vec_id, sum(q.x * c.x)::BIGINT AS score FROM c q JOIN c ON q.j = c.j AND q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0 GROUP BY ALL)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank, vec_id, score FROM s QUALIFY rank <= 5
"""
