"""DuckDB SQL of the text operators' queries that SQL can express."""

from __future__ import annotations

# All pairs of distinct sets that share a shingle, counted; links closed.
OP11 = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
docs AS (
  SELECT doc_id, list_sort(list_distinct(
    CASE WHEN len(w) >= 4 THEN list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))
         WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END)) AS s FROM words),
sets AS MATERIALIZED (
  SELECT row_number() OVER () AS node, s, len(s) AS n, min(doc_id) AS least FROM docs WHERE len(s) > 0 GROUP BY s),
grams AS MATERIALIZED (SELECT node, unnest(s) AS g FROM sets),
pairs AS (
  SELECT x.node AS a, y.node AS b, count(*) AS c FROM grams x JOIN grams y ON x.g = y.g AND x.node < y.node GROUP BY 1, 2),
linked AS MATERIALIZED (
  SELECT a, b FROM pairs JOIN sets x ON x.node = a JOIN sets y ON y.node = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
edges AS MATERIALIZED (SELECT a, b FROM linked UNION ALL SELECT b, a FROM linked),
reach(a, b) AS (SELECT node, node FROM sets UNION SELECT r.a, e.b FROM reach r JOIN edges e ON e.a = r.b),
names AS (SELECT r.a AS node, min(t.least) AS component_id FROM reach r JOIN sets t ON t.node = r.b GROUP BY r.a)
SELECT d.doc_id, len(d.s)::BIGINT AS n_shingles,
       CASE WHEN len(d.s) = 0 THEN d.doc_id ELSE k.component_id END AS component_id,
       d.doc_id IS NOT DISTINCT FROM (CASE WHEN len(d.s) = 0 THEN d.doc_id ELSE k.component_id END) AS kept
FROM docs d LEFT JOIN sets t ON t.s = d.s LEFT JOIN names k ON k.node = t.node
"""

OP12 = r"""
WITH units AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS hex,
         regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u FROM documents),
draws AS (
  SELECT doc_id, t, u, len(u)::BIGINT AS n, ('0x' || hex[1:8])::BIGINT % (len(u) + 1) AS c1,
         ('0x' || hex[9:16])::BIGINT % (len(u) + 1) AS c2, ('0x' || hex[17:24])::BIGINT % 100 AS r3,
         ('0x' || hex[25:32])::BIGINT % 100 AS r4 FROM units),
forms AS (
  SELECT *, CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR r3 >= 50 THEN 'plain'
                 WHEN r4 < 80 THEN 'spm' ELSE 'psm' END AS form,
         array_to_string(u[1:least(c1, c2)], '') AS p, array_to_string(u[least(c1, c2) + 1:greatest(c1, c2)], '') AS m,
         array_to_string(u[greatest(c1, c2) + 1:], '') AS s FROM draws)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM forms
"""


def _op13(rounds: int = 10, k: int = 8, dim: int = 64) -> str:
    """The rounds written out one after the other; distances in full."""
    head = f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS x
  FROM embeddings WHERE len(embedding) = {dim}
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {dim}),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('3:' || coalesce(vec_id::VARCHAR, '')), x) - 1 AS c, x FROM kept
  ORDER BY 1 LIMIT {k})"""

    def nearest(i: int) -> str:
        return f"""
a{i} AS MATERIALIZED (
  SELECT r, min({{'d': d, 'c': c}}) AS best FROM (
    SELECT r, c, list_sum(list_transform(list_zip(v.x, k.x), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS d
    FROM kept v CROSS JOIN c{i} k) GROUP BY r)"""

    parts = [head]
    for i in range(rounds):
        parts.append(nearest(i))
        parts.append(f"""
s{i} AS (
  SELECT best.c AS c, pos, sum(y)::BIGINT AS s, count(*)::BIGINT AS n FROM (
    SELECT a.best, unnest(v.x) AS y, unnest(range(1, {dim} + 1)) AS pos FROM a{i} a JOIN kept v USING (r)) GROUP BY 1, 2),
m{i} AS (
  SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY pos) AS x FROM s{i} GROUP BY c),
c{i + 1} AS MATERIALIZED (
  SELECT k.c, coalesce(m.x, k.x) AS x FROM c{i} k LEFT JOIN m{i} m USING (c))""")
    parts.append(nearest(rounds))
    return ",".join(parts) + f"""
SELECT v.vec_id, a.best.c::INT AS cluster, a.best.d AS distance,
       (sum(a.best.d) OVER (PARTITION BY a.best.c))::BIGINT AS cluster_inertia, (sum(a.best.d) OVER ())::BIGINT AS inertia,
       sha256(array_to_string(k.x, ',')) AS centroid_sha256
FROM a{rounds} a JOIN kept v USING (r) JOIN c{rounds} k ON k.c = a.best.c
"""


ORACLE_SQL: dict[str, str] = {
    "op11_setsketch_near_duplicates": OP11,
    "op12_fill_in_middle": OP12,
    "op13_bisector_centroids": _op13(),
}
