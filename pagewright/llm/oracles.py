"""SQL of the queries that it can express, for DuckDB over the same tables: the definitions themselves, without any method."""

from __future__ import annotations

#: Windows are the shortest runs of lines with 8 words, from each line on and up to each line.
SQL_OP5 = r"""
WITH a AS (SELECT doc_id, text, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents WHERE text IS NOT NULL),
c AS (SELECT *, len(list_filter(string_split(translate(line, chr(9) || chr(11) || chr(12) || chr(13), '    '), ' '), lambda x: x <> '')) AS words FROM a),
l AS (SELECT doc_id, pos, line, words, row_number() OVER w AS i, sum(words) OVER w AS upto FROM c WHERE words > 0 WINDOW w AS (PARTITION BY doc_id ORDER BY pos)),
f AS (SELECT x.doc_id, x.i AS a, min(y.i) AS z FROM l x JOIN l y ON x.doc_id = y.doc_id AND y.i BETWEEN x.i AND x.i + 7 AND y.upto - x.upto + x.words >= 8 GROUP BY ALL),
b AS (SELECT y.doc_id, max(x.i) AS a, y.i AS z FROM l x JOIN l y ON x.doc_id = y.doc_id AND x.i BETWEEN y.i - 7 AND y.i AND y.upto - x.upto + x.words >= 8 GROUP BY y.doc_id, y.i),
v AS (SELECT * FROM f UNION SELECT * FROM b),
k AS (SELECT v.doc_id, v.a, v.z, string_agg(l.line, chr(10) ORDER BY l.i) AS key FROM v JOIN l ON v.doc_id = l.doc_id AND l.i BETWEEN v.a AND v.z GROUP BY ALL),
e AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY doc_id, a) AS n FROM k),
g AS (SELECT DISTINCT l.doc_id, l.i, l.pos FROM e JOIN l ON e.doc_id = l.doc_id AND l.i BETWEEN e.a AND e.z WHERE e.n > 1),
m AS (SELECT DISTINCT doc_id, a, z FROM e WHERE n > 1),
o AS (SELECT *, max(z) OVER (PARTITION BY doc_id ORDER BY a, z ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM m),
r AS (SELECT doc_id, count(*) FILTER (reach IS NULL OR a > reach + 1) AS n_runs FROM o GROUP BY doc_id),
n AS (SELECT l.doc_id, count(*) AS n_lines, count(g.i) AS n_removed FROM l LEFT JOIN g ON l.doc_id = g.doc_id AND l.i = g.i GROUP BY l.doc_id),
t AS (SELECT c.doc_id, coalesce(string_agg(c.line, chr(10) ORDER BY c.pos) FILTER (g.pos IS NULL), '') AS kept FROM c LEFT JOIN g ON c.doc_id = g.doc_id AND c.pos = g.pos GROUP BY c.doc_id)
SELECT d.doc_id, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_runs, 0)::BIGINT AS n_runs, sha256(coalesce(kept, '')) AS kept_sha256, kept AS kept_text
FROM documents d LEFT JOIN n ON d.doc_id = n.doc_id LEFT JOIN r ON d.doc_id = r.doc_id LEFT JOIN t ON d.doc_id = t.doc_id
"""

#: Bytes as two hexadecimal digits each.
SQL_OP6 = r"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, (length(hex(encode(coalesce(text, '')))) // 2)::BIGINT AS n_bytes FROM documents),
p AS (SELECT doc_id, unnest(range(0, n_bytes - 49)) AS pos, h FROM d WHERE n_bytes >= 50),
s AS (SELECT doc_id, pos, substring(h, 2 * pos + 1, 100) AS string FROM p),
l AS (SELECT string, min(doc_id) AS least FROM s GROUP BY string HAVING min(doc_id) < max(doc_id)),
r AS (SELECT DISTINCT s.doc_id, s.pos FROM s JOIN l ON s.string = l.string WHERE l.least < s.doc_id),
o AS (SELECT *, lag(pos) OVER w AS before FROM r WINDOW w AS (PARTITION BY doc_id ORDER BY pos)),
i AS (SELECT *, sum(CASE WHEN before IS NULL OR pos > before + 50 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY pos) AS span FROM o),
x AS (SELECT doc_id, span, min(pos) AS a, max(pos) + 50 AS z FROM i GROUP BY doc_id, span),
k AS (SELECT doc_id, span, z, lead(a) OVER (PARTITION BY doc_id ORDER BY span) AS next, a, z - a AS gone FROM x),
t AS (SELECT k.doc_id, count(*) AS n_spans, sum(gone) AS n_removed, substring(any_value(h), 1, 2 * min(a)) || string_agg(substring(h, 2 * z + 1, 2 * (coalesce(next, n_bytes) - z)), '' ORDER BY span) AS kept FROM k JOIN d ON k.doc_id = d.doc_id GROUP BY k.doc_id)
SELECT d.doc_id, n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(kept, h))) AS kept_sha256 FROM d LEFT JOIN t ON d.doc_id = t.doc_id
"""

SQL_OP8 = r"""
WITH d AS (
  SELECT doc_id, coalesce(source, chr(1114111)) AS source, len(list_filter(string_split(translate(coalesce(text, ''), chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '     '), ' '), lambda x: x <> '')) AS size, md5('42:' || doc_id) AS key
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source) AS n FROM d GROUP BY source),
w AS (SELECT source, source_size, CASE (n - 1) % 3 WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS weight FROM s),
f AS (
  SELECT *, source_size / weight AS fill,
    (1.5::DOUBLE * sum(source_size) OVER () - 2.0::DOUBLE * coalesce(sum(source_size) OVER (ORDER BY source_size / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
      / sum(weight) OVER (ORDER BY source_size / weight, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rate
  FROM w),
r AS (SELECT arg_min(rate, fill) AS rate FROM f WHERE NOT rate > 2.0 * fill),
t AS (
  SELECT f.source, source_size, coalesce(CASE WHEN f.rate > 2.0 * fill THEN 2.0::DOUBLE * source_size ELSE least(weight * r.rate, 2.0::DOUBLE * source_size) END, 0)::DOUBLE AS target
  FROM f CROSS JOIN (SELECT max(rate) AS rate FROM r) r),
p AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, floor(t.target)::BIGINT AS budget,
    (sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.doc_id, d.size ROWS UNBOUNDED PRECEDING) - d.size)::BIGINT AS start
  FROM d JOIN t ON d.source = t.source)
SELECT doc_id, size::BIGINT AS size, source_size, target,
  (CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END * size
    + greatest(0, least(size, budget - CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END * source_size - start)))::BIGINT AS taken
FROM p
"""

SQL_OP9 = r"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(string_split(translate(translate(coalesce(text, ''), chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '     '), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), ' '), lambda x: x <> '') AS w FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM w),
e AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM s),
t AS (SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS n, any_value(b.n) AS m, count(*) AS k FROM e a JOIN e b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM t WHERE 100 * k >= 75 * (n + m - k)),
edges AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach(doc_id, other) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, e.b FROM reach r JOIN edges e ON r.other = e.a)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, min(r.other) AS component_id FROM s JOIN reach r ON s.doc_id = r.doc_id GROUP BY s.doc_id, len(s.s)
"""

SQL: dict[str, str] = {"op5_line_winnowing": SQL_OP5, "op6_suffix_dedup": SQL_OP6, "op8_mixing": SQL_OP8, "op9_jaccard_join": SQL_OP9}
