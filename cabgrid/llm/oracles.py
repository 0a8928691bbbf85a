"""DuckDB SQL for the corpus queries that SQL can express on small tables."""

_WORDS = r"'[^\x20\x09-\x0D]+'"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

NEAR_DEDUP = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), {_WORDS}) AS ws FROM documents
), sh AS (
  SELECT DISTINCT doc_id, list_aggregate(ws[p:p + 3], 'string_agg', ' ') AS s
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 1) + 1)) AS p FROM w WHERE len(ws) > 0)
), n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id
), links AS (
  SELECT x.doc_id AS a, y.doc_id AS b
  FROM sh x JOIN sh y ON x.s = y.s AND x.doc_id <> y.doc_id
  JOIN n nx ON nx.doc_id = x.doc_id JOIN n ny ON ny.doc_id = y.doc_id
  GROUP BY x.doc_id, y.doc_id, nx.n, ny.n
  HAVING 100 * count(*) >= 80 * (nx.n + ny.n - count(*))
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM w
  UNION
  SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b
), c AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT c.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.component_id, c.component_id = c.doc_id AS kept
FROM c LEFT JOIN n USING (doc_id)
"""

SUBSTRING_DEDUP = f"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), {_WORDS}) AS ws FROM documents
), win AS (
  SELECT doc_id, p, list_aggregate(ws[p:p + 12], 'string_agg', ' ') AS s
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS p FROM w WHERE len(ws) >= 13)
), f AS (SELECT s, min(doc_id) AS first_id FROM win GROUP BY s
), gone AS (
  SELECT DISTINCT win.doc_id, win.p + k.k AS p
  FROM win JOIN f USING (s) CROSS JOIN (SELECT unnest(range(13)) AS k) k WHERE f.first_id < win.doc_id
), word AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS p FROM w
), kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS t
  FROM word ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id
), g AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT w.doc_id, len(w.ws)::BIGINT AS n_words, coalesce(g.n, 0)::BIGINT AS n_removed,
       sha256(coalesce(kept.t, '')) AS kept_sha256
FROM w LEFT JOIN g USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

TOP_K = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 10
"""


def _code_rounds(rounds: int) -> str:
    """The rounds of VECTOR_CODES: assignment a{i}, then codebooks c{i + 1}."""
    out = []
    for i in range(rounds + 1):
        out.append(f"""
a{i} AS MATERIALIZED (
  SELECT vec_id, part, any_value(x) AS x, min({{'d': d, 'e': entry}}) AS best
  FROM (
    SELECT p.vec_id, p.part, p.x, c.entry,
           list_sum(list_transform(list_zip(p.x, c.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
    FROM p JOIN c{i} c ON c.part = p.part
  ) GROUP BY vec_id, part
)""")
        if i < rounds:
            out.append(f"""
m{i} AS (
  SELECT part, entry, list(mean ORDER BY pos) AS x FROM (
    SELECT part, best.e AS entry, pos, floor(sum(x[pos]) / count(*))::BIGINT AS mean
    FROM a{i}, (SELECT unnest(range(1, (SELECT max(w) FROM p) + 1)) AS pos) GROUP BY part, best.e, pos
  ) GROUP BY part, entry
), c{i + 1} AS MATERIALIZED (
  SELECT c.part, c.entry, coalesce(m.x, c.x) AS x FROM c{i} c LEFT JOIN m{i} m ON m.part = c.part AND m.entry = c.entry
)""")
    return ",".join(out)


#: For tables with one vector length, a multiple of 8, and ids that don't repeat.
VECTOR_CODES = f"""
WITH v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(4096 * x::DOUBLE)::BIGINT) AS e, len(embedding) // 8 AS w FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), p AS MATERIALIZED (
  SELECT vec_id, label, part, w, e[part * w + 1:(part + 1) * w] AS x FROM v, (SELECT unnest(range(8)) AS part)
), c0 AS MATERIALIZED (
  SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry, x
  FROM p WHERE vec_id IN (SELECT vec_id FROM v ORDER BY vec_id LIMIT 16)
), {_code_rounds(6)}, h AS (
  SELECT sha256(string_agg(y::VARCHAR, ',' ORDER BY part, entry, pos)) AS codebooks_sha256
  FROM (SELECT part, entry, unnest(x) AS y, unnest(range(len(x))) AS pos FROM c6)
), r AS (
  SELECT vec_id, string_agg(printf('%02x', best.e), '' ORDER BY part) AS code, sum(best.d)::BIGINT AS error FROM a6 GROUP BY vec_id
)
SELECT r.vec_id, r.code, r.error, (sum(r.error) OVER (PARTITION BY v.label))::BIGINT AS label_error, h.codebooks_sha256
FROM r JOIN v USING (vec_id) CROSS JOIN h
"""

FILTER_AUDIT = f"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), {_WORDS}) AS ws FROM documents
), l AS (
  SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id
), m AS (
  SELECT doc_id, part,
         (len(ws) < 100)::INT
         + 2 * (100 * list_unique(ws) < 80 * len(ws))::INT
         + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t))::INT
         + 8 * regexp_matches(t, '[#$%&*|]')::INT
         + 16 * (doc_id > min(doc_id) OVER (PARTITION BY t))::INT AS mask
  FROM d
), c AS (
  SELECT part, mask, count(*) AS n, coalesce(sum(good), 0) AS good, coalesce(sum(toxic), 0) AS toxic
  FROM m LEFT JOIN l USING (doc_id) GROUP BY part, mask
), f AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x
), o AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
  FROM f a JOIN f b ON b.x <> a.x JOIN f c ON c.x NOT IN (a.x, b.x) JOIN f d ON d.x NOT IN (a.x, b.x, c.x) JOIN f e ON e.x NOT IN (a.x, b.x, c.x, d.x)
), s AS (
  SELECT filter_order, step, (1 << (ascii(filter_order[step]) - 65)) AS own,
         coalesce(list_sum(list_transform(range(1, step), lambda k: 1 << (ascii(filter_order[k]) - 65))), 0)::INT AS before
  FROM o CROSS JOIN (SELECT unnest(range(1, 6)) AS step)
), r AS (
  SELECT part, filter_order, step::INT AS step, own,
         coalesce(sum(n) FILTER (mask & (own | before) = 0), 0)::BIGINT AS kept,
         coalesce(sum(n) FILTER (mask & before = 0 AND mask & own <> 0), 0)::BIGINT AS removed,
         coalesce(sum(n) FILTER (mask & before <> 0 AND mask & own <> 0), 0)::BIGINT AS redundant,
         coalesce(sum(n) FILTER (mask = own), 0)::BIGINT AS unique_fails,
         coalesce(sum(good) FILTER (mask & before = 0 AND mask & own <> 0), 0)::BIGINT AS good_lost,
         coalesce(sum(toxic) FILTER (mask & before = 0 AND mask & own <> 0), 0)::BIGINT AS toxic_lost
  FROM c CROSS JOIN s GROUP BY part, filter_order, step, own
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley
FROM r
"""
