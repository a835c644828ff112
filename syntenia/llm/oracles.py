"""DuckDB SQL for the training-data queries that SQL can express."""

from __future__ import annotations

from syntenia.llm.centroid_clusters import op13_sql
from syntenia.llm.hard_negatives import OP12_SQL
from syntenia.llm.url_rules import OP8_SQL

#: Words, the templates of every line, those by position in each leaf, and the lines of none that recurs.
OP3_SQL = """
WITH lines AS (
  SELECT doc_id, row_number() OVER () AS r, coalesce(text, '') AS t, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
each AS (SELECT doc_id, r, t, unnest(l) AS line, generate_subscripts(l, 1) AS i FROM lines),
cut AS (SELECT *, list_filter(regexp_split_to_array(line, '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w0 FROM each),
masked AS (SELECT *, list_transform(w0, lambda w: CASE WHEN regexp_matches(w, '[0-9]') THEN '<*>' ELSE w END) AS w, len(w0) AS n FROM cut),
named AS (
  SELECT *, CASE WHEN n BETWEEN 1 AND 3 AND len(list_filter(w, lambda x: x <> '<*>')) = 0
    THEN '3 ' || n || ' ' || array_to_string(w0, ' ') ELSE '0 ' || n || ' ' || array_to_string(w, ' ') END AS literal,
    least(3, n // 2) AS d FROM masked),
keyed AS (
  SELECT *, CASE WHEN n >= 10 THEN [literal,
      '1 ' || n || ' ' || array_to_string(w[1:3 + (n - 3) // 2], ' '),
      '2 ' || n || ' ' || array_to_string(w[1:3], ' ') || ' / ' || array_to_string(w[4 + (n - 3) // 2:], ' ')]
    WHEN n >= 1 THEN [literal] ELSE [] END AS keys,
    CASE WHEN n >= 3 THEN n || ' ' || array_to_string(w[1:d], ' ') END AS leaf FROM named),
leaves AS (SELECT leaf, count(DISTINCT t) AS texts FROM keyed WHERE leaf IS NOT NULL GROUP BY leaf HAVING count(DISTINCT t) >= 3),
held AS (SELECT DISTINCT t, literal, leaf, n, d, w, texts FROM keyed JOIN leaves USING (leaf)),
places AS (
  SELECT t, literal, leaf, n, len(list_filter(w[1:d], lambda x: x <> '<*>')) AS lead, texts, unnest(w[d + 1:]) AS token, unnest(range(d, n)) AS pos FROM held),
tokens AS (
  SELECT leaf, pos, token, count(DISTINCT t) AS c, (count(DISTINCT t) * 8 >= texts)::int + (count(DISTINCT t) * 2 >= texts)::int AS level
  FROM places WHERE token <> '<*>' GROUP BY leaf, pos, token, texts HAVING count(DISTINCT t) >= 3),
levels AS (SELECT unnest([0, 1, 2]) AS k),
general AS (
  SELECT DISTINCT p.literal, p.leaf || ' : ' || string_agg(p.pos || ' ' || p.token, ' ' ORDER BY p.pos) AS template
  FROM (SELECT DISTINCT literal, leaf, n, lead, pos, token FROM places) p JOIN tokens USING (leaf, pos, token) JOIN levels ON level >= k
  GROUP BY p.literal, p.leaf, p.n, p.lead, k HAVING (count(*) + p.lead) * 2 > p.n),
again AS (SELECT template FROM general JOIN (SELECT DISTINCT t, literal FROM held) USING (literal) GROUP BY template HAVING count(DISTINCT t) >= 3),
recurring AS (
  SELECT k FROM (SELECT DISTINCT unnest(keys) AS k, t FROM keyed) GROUP BY k HAVING count(*) >= 3
  UNION SELECT literal FROM general JOIN again USING (template)),
bad AS (SELECT DISTINCT r, i FROM (SELECT r, i, unnest(keys) AS k FROM keyed) JOIN recurring USING (k)),
judged AS (SELECT k.*, b.r IS NOT NULL AS gone FROM keyed k LEFT JOIN bad b ON k.r = b.r AND k.i = b.i)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped, coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '') AS text
FROM judged GROUP BY doc_id, r
"""

#: Distinct shingles, pairs that share enough of them, and the closure of the links.
OP10_SQL = """
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT x, y FROM pairs JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * c >= 80 * (p.n + q.n - c)),
both_ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach(x, y) AS (SELECT x, y FROM both_ways UNION SELECT r.x, b.y FROM reach r JOIN both_ways b ON r.y = b.x)
SELECT w.doc_id, coalesce(s.n, 0) AS n_shingles, least(w.doc_id, coalesce((SELECT min(y) FROM reach WHERE x = w.doc_id), w.doc_id)) AS component_id
FROM words w LEFT JOIN sizes s ON s.doc_id = w.doc_id
"""

ORACLES = {"op3_line_templates": OP3_SQL, "op8_url_rules": OP8_SQL, "op10_jaccard_join": OP10_SQL, "op12_hard_negatives": OP12_SQL, "op13_weighted_clusters": op13_sql()}
