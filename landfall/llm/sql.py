"""What SQL can express of the operators, for the queries of the same names."""

NEAR_DEDUP = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS ws
  FROM documents),
s AS (
  SELECT doc_id, unnest(CASE WHEN len(ws) = 0 THEN []
    WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')))
    END) AS g
  FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared
  FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (
  SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
  WHERE 100 * shared >= 75 * (x.n + y.n - shared)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION SELECT reach.a, e.b FROM reach JOIN e ON reach.b = e.a),
c AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM c LEFT JOIN n USING (doc_id)
"""

SUFFIX_DEDUP = """
WITH h AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
k AS (
  SELECT doc_id, i, hash(substr(h, 2 * i + 1, 400)) AS m
  FROM (SELECT doc_id, h, unnest(range(0, len(h) // 2 - 199)) AS i FROM h)),
d AS (SELECT doc_id, i FROM k WHERE m IN (SELECT m FROM k GROUP BY m HAVING count(*) > 1)),
g AS (
  SELECT doc_id, i, sum(CASE WHEN i > coalesce(before, -1000) + 200 THEN 1 ELSE 0 END)
    OVER (PARTITION BY doc_id ORDER BY i) AS run
  FROM (SELECT *, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM d)),
r AS (SELECT doc_id, min(i) AS s, max(i) + 200 AS e FROM g GROUP BY doc_id, run),
t AS (
  SELECT doc_id, s, e, coalesce(lag(e) OVER (PARTITION BY doc_id ORDER BY s), 0) AS since FROM r
  UNION ALL
  SELECT doc_id, len(h) // 2, len(h) // 2, coalesce(last, 0)
  FROM h LEFT JOIN (SELECT doc_id, max(e) AS last FROM r GROUP BY doc_id) USING (doc_id)),
kept AS (
  SELECT doc_id, string_agg(substr(h, 2 * since + 1, 2 * (s - since)), '' ORDER BY s, e) AS kept
  FROM t JOIN h USING (doc_id) GROUP BY doc_id)
SELECT h.doc_id, len(h) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed,
       coalesce(n_spans, 0) AS n_spans, sha256(unhex(kept)) AS kept_sha256
FROM h JOIN kept USING (doc_id) LEFT JOIN (
  SELECT doc_id, CAST(sum(e - s) AS BIGINT) AS n_removed, count(*) AS n_spans FROM r GROUP BY doc_id
) USING (doc_id)
"""

COLLOCATIONS = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
f1 AS (SELECT lang, x, count(*) AS a FROM (SELECT lang, unnest(ws) AS x FROM w) GROUP BY ALL),
f2 AS (
  SELECT lang, x, y, count(*) AS a
  FROM (SELECT lang, ws[i] AS x, ws[i + 1] AS y FROM (SELECT lang, ws, unnest(range(1, len(ws))) AS i FROM w))
  GROUP BY ALL HAVING count(*) >= 10),
f3 AS (
  SELECT lang, x, y, z, count(*) AS a
  FROM (SELECT lang, ws[i] AS x, ws[i + 1] AS y, ws[i + 2] AS z
        FROM (SELECT lang, ws, unnest(range(1, len(ws) - 1)) AS i FROM w))
  GROUP BY ALL HAVING count(*) >= 10),
longer AS (
  SELECT lang, x, y, max(a) AS longer
  FROM (SELECT lang, x, y, a FROM f3 UNION ALL SELECT lang, y, z, a FROM f3) GROUP BY ALL),
cuts AS (
  SELECT lang, x || ' ' || y AS phrase, f2.a, l.a AS l, r.a AS r, 1 AS k
  FROM f2 JOIN f1 l USING (lang, x) JOIN f1 r ON r.lang = f2.lang AND r.x = f2.y
  LEFT JOIN longer USING (lang, x, y)
  WHERE longer IS NULL OR 100 * longer < 50 * f2.a
  UNION ALL
  SELECT f3.lang, f3.x || ' ' || f3.y || ' ' || f3.z, f3.a, l.a, r.a, 1
  FROM f3 JOIN f1 l USING (lang, x) JOIN f2 r ON r.lang = f3.lang AND r.x = f3.y AND r.y = f3.z
  UNION ALL
  SELECT f3.lang, f3.x || ' ' || f3.y || ' ' || f3.z, f3.a, l.a, r.a, 2
  FROM f3 JOIN f2 l USING (lang, x, y) JOIN f1 r ON r.lang = f3.lang AND r.x = f3.z),
scored AS (
  SELECT *, CAST(1000000::HUGEINT * a::HUGEINT * a::HUGEINT // (l::HUGEINT * r::HUGEINT) AS BIGINT) AS score
  FROM cuts),
least AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
ranked AS (
  SELECT *, row_number() OVER (
    PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM least)
SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, score
FROM ranked JOIN (SELECT lang, sum(a) AS n FROM f1 GROUP BY lang) USING (lang) WHERE rank <= 2000
"""


def _clusters(rounds: int = 3) -> str:
    """K-means by plain measuring: each round a common table expression of the one before."""
    parts = [r"""
v AS (
  SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: CAST(floor(64 * x::DOUBLE) AS BIGINT)) AS x
  FROM embeddings
  WHERE len(embedding) = 64 AND list_aggregate(list_transform(embedding, lambda x: coalesce(isfinite(x), false)), 'bool_and')),
e AS MATERIALIZED (SELECT row, unnest(range(64)) AS d, unnest(x) AS x FROM v),
s AS (SELECT vec_id, x, sha256('1:' || vec_id) AS h FROM v ORDER BY h, x LIMIT 16),
c0 AS MATERIALIZED (
  SELECT c, unnest(range(64)) AS d, unnest(x) AS x FROM (SELECT x, row_number() OVER (ORDER BY h, x) - 1 AS c FROM s))"""]
    for i in range(rounds + 1):
        parts.append(f"""
a{i} AS MATERIALIZED (
  SELECT row, min(struct_pack(distance, c)) AS best FROM (
    SELECT e.row, c.c, CAST(sum((e.x - c.x) * (e.x - c.x)) AS BIGINT) AS distance
    FROM e JOIN c{i} c USING (d) GROUP BY ALL)
  GROUP BY row)""")
        if i < rounds:
            parts.append(f"""
c{i + 1} AS MATERIALIZED (
  SELECT c, d, CASE WHEN n IS NULL THEN x ELSE (t - ((t % n) + n) % n) // n END AS x
  FROM c{i} LEFT JOIN (
    SELECT best.c AS c, d, CAST(sum(x) AS BIGINT) AS t, count(*) AS n FROM e JOIN a{i} USING (row) GROUP BY ALL)
  USING (c, d))""")
    return f"""
WITH {",".join(parts)},
g AS (SELECT c, sha256(string_agg(x::VARCHAR, ',' ORDER BY d)) AS g FROM c{rounds} GROUP BY c)
SELECT vec_id, CAST(best.c AS INTEGER) AS cluster, best.distance AS distance,
       CAST(sum(best.distance) OVER (PARTITION BY best.c) AS BIGINT) AS cluster_inertia,
       CAST(sum(best.distance) OVER () AS BIGINT) AS inertia, g AS centroid_sha256
FROM a{rounds} JOIN v USING (row) JOIN g ON g.c = best.c
"""


CLUSTERS = _clusters()
