"""DuckDB SQL for the operators that SQL can express."""

WORDS = r"[^\x20\x09-\x0D]+"
LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_GROUPS = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((('0x' || substr(h, {5 * g + 1}, 5))::BIGINT >> {15 - 5 * k}) & 31), 1)" for g in range(8) for k in range(4)
)

WARC = f"""
WITH d AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
h AS (SELECT page_id, octet_length(b) AS n, sha1(b) AS h FROM d),
f AS (SELECT *, min(page_id) OVER (PARTITION BY h) AS first FROM h)
SELECT page_id, n::BIGINT AS payload_bytes, {_GROUPS} AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to
FROM f
"""

PASSAGES = f"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORDS}') AS ws FROM documents),
win AS (SELECT doc_id, i, array_to_string(ws[i:i + 12], ' ') AS k FROM w, unnest(range(1, greatest(len(ws) - 11, 1))) t(i)),
owner AS (SELECT k, min(doc_id) AS m FROM win GROUP BY k),
hit AS (SELECT DISTINCT doc_id, i + j AS p FROM win JOIN owner USING (k), range(0, 13) r(j) WHERE doc_id > m),
pos AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS p FROM w),
kept AS (
  SELECT doc_id, count(hit.p) AS n_removed, string_agg(word, ' ' ORDER BY p) FILTER (WHERE hit.p IS NULL) AS t
  FROM pos LEFT JOIN hit USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""

LEAKS = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({LOWER}, '[0-9a-z\x{{80}}-\x{{10FFFF}}]+') AS ws FROM documents),
q AS (SELECT item_id, regexp_extract_all({LOWER}, '[0-9a-z\x{{80}}-\x{{10FFFF}}]+') AS ws FROM benchmark),
qg AS (SELECT DISTINCT item_id, least(5, len(ws)) AS width, array_to_string(ws[i:i + least(5, len(ws)) - 1], ' ') AS g FROM q, unnest(range(1, len(ws) - least(5, len(ws)) + 2)) t(i) WHERE len(ws) > 0),
dg AS (SELECT DISTINCT doc_id, width, array_to_string(ws[i:i + width - 1], ' ') AS g FROM d, (SELECT DISTINCT width FROM qg) v, unnest(range(1, greatest(len(ws) - width + 2, 1))) t(i)),
size AS (SELECT item_id, count(*) AS n FROM qg GROUP BY item_id),
pair AS (SELECT doc_id, item_id, count(*) AS s FROM qg JOIN dg USING (width, g) GROUP BY doc_id, item_id)
SELECT doc_id, item_id, n::BIGINT AS n_shingles, s::BIGINT AS n_shared, s / n AS containment FROM pair JOIN size USING (item_id) WHERE s * 100 >= n * 80
"""

JACCARD = f"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({LOWER}, '{WORDS}') AS ws FROM documents),
g AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS s FROM w, unnest(range(1, CASE WHEN len(ws) >= 5 THEN len(ws) - 3 ELSE 2 END)) t(i) WHERE len(ws) > 0),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM g a JOIN g b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
link AS (SELECT a, b FROM shared JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 80 * (x.n + y.n - k)),
reach(a, b) AS (SELECT doc_id, doc_id FROM documents UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a)
SELECT reach.a AS doc_id, any_value(coalesce(n.n, 0))::BIGINT AS n_shingles, min(reach.b) AS component_id FROM reach LEFT JOIN n ON n.doc_id = reach.a GROUP BY reach.a
"""

_DISTANCE = "list_sum(list_transform(list_zip(v, c), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"


def _rounds(n: int) -> str:
    """Centroids c0, c1, ... of the rounds, and each round's vectors by nearest centroid a0, a1, ..."""
    assign = "a{r} AS MATERIALIZED (SELECT id, v, arg_min(k, d * 100 + k) AS k, min(d) AS d FROM (SELECT row AS id, v, k, %s AS d FROM x, c{r}) GROUP BY id, v)" % _DISTANCE
    parts = [assign.format(r=0)]
    for r in range(1, n + 1):
        parts.append(f"s{r} AS (SELECT k, i, sum(v[i])::BIGINT AS s, count(*)::BIGINT AS n FROM a{r - 1}, range(1, 65) t(i) GROUP BY k, i)")
        parts.append(f"m{r} AS (SELECT k, list((s - ((s % n) + n) % n) // n ORDER BY i) AS c FROM s{r} GROUP BY k)")
        parts.append(f"c{r} AS MATERIALIZED (SELECT k, coalesce(m{r}.c, c{r - 1}.c) AS c FROM c{r - 1} LEFT JOIN m{r} USING (k))")
        parts.append(assign.format(r=r))
    return ",\n".join(parts)


CENTROIDS = f"""
WITH x AS MATERIALIZED (
  SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda e: floor(64 * e::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = 64),
c0 AS MATERIALIZED (SELECT (row_number() OVER (ORDER BY h, v) - 1)::INT AS k, v AS c FROM (SELECT sha256('1:' || vec_id) AS h, v FROM x ORDER BY h, v LIMIT 16)),
{_rounds(3)}
SELECT vec_id, k AS cluster, d::BIGINT AS distance, (sum(d) OVER (PARTITION BY k))::BIGINT AS cluster_inertia, (sum(d) OVER ())::BIGINT AS inertia,
       sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a3 JOIN x ON x.row = a3.id JOIN c3 USING (k)
"""

_TERMS = rf"regexp_extract_all({LOWER}, '[0-9a-z\x{{80}}-\x{{10FFFF}}]+')"

SEARCH = f"""
WITH d AS (SELECT doc_id, {_TERMS} AS ts FROM documents),
c AS (SELECT count(*) FILTER (WHERE len(ts) > 0) AS docs, sum(len(ts))::HUGEINT AS terms FROM d),
t AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(ts) AS term FROM d) GROUP BY doc_id, term),
q AS (SELECT item_id, term, count(*) AS r FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark) GROUP BY item_id, term),
w AS (SELECT term, floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM t, c GROUP BY term, docs),
m AS (SELECT doc_id, (75 + (25 * len(ts) * docs) // terms)::BIGINT AS m FROM d, c WHERE len(ts) > 0),
s AS (SELECT item_id, doc_id, sum(r * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
      FROM q JOIN t USING (term) JOIN w USING (term) JOIN m USING (doc_id) GROUP BY item_id, doc_id HAVING score > 0),
r AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score FROM s)
SELECT * FROM r WHERE rank <= 20
"""
