"""DuckDB twins of the queries of this subpackage that SQL can express."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

OP2 = """
WITH h AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
win AS (SELECT doc_id, p, substr(h, 2 * p - 1, 100) AS g FROM (SELECT doc_id, h, unnest(range(1, len(h) // 2 - 48)) AS p FROM h)),
firsts AS (SELECT g, min(doc_id) AS f FROM win GROUP BY 1),
hit AS (SELECT w.doc_id, w.p FROM win w JOIN firsts USING (g) WHERE f < w.doc_id),
step AS (SELECT doc_id, p, CASE WHEN p - lag(p) OVER (PARTITION BY doc_id ORDER BY p) <= 50 THEN 0 ELSE 1 END AS new FROM hit),
run AS (SELECT doc_id, min(p) AS s, max(p) + 49 AS e FROM (SELECT doc_id, p, sum(new) OVER (PARTITION BY doc_id ORDER BY p) AS k FROM step) GROUP BY doc_id, k),
piece AS (
  SELECT doc_id, lag(e, 1, 0) OVER (PARTITION BY doc_id ORDER BY s) + 1 AS a, s - 1 AS b FROM run
  UNION ALL SELECT h.doc_id, coalesce(max(run.e), 0) + 1, len(any_value(h.h)) // 2 FROM h LEFT JOIN run USING (doc_id) GROUP BY 1),
kept AS (SELECT doc_id, string_agg(substr(h.h, 2 * a - 1, 2 * (b - a + 1)), '' ORDER BY a) AS k FROM piece JOIN h USING (doc_id) WHERE b >= a GROUP BY 1),
total AS (SELECT doc_id, sum(e - s + 1) AS removed, count(*) AS spans FROM run GROUP BY 1)
SELECT h.doc_id, CAST(len(h.h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(k, ''))) AS kept_sha256
FROM h LEFT JOIN total USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

OP9 = f"""
WITH RECURSIVE words AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
sets AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY 1),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM sets a JOIN sets b USING (g) WHERE a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * i >= 90 * (x.n + y.n - i)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(doc_id, r) AS (SELECT doc_id, doc_id FROM documents UNION SELECT e.a, reach.r FROM reach JOIN both_ways e ON e.b = reach.doc_id)
SELECT d.doc_id, CAST(coalesce(any_value(n), 0) AS BIGINT) AS n_shingles, min(r) AS component_id FROM reach d LEFT JOIN sizes USING (doc_id) GROUP BY 1
"""

OP13 = f"""
WITH line AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS p FROM documents),
keyed AS (SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{_UPPER}', '{_LOWER}') AS k FROM line),
common AS (SELECT k, max(doc_id) AS holder FROM keyed WHERE length(k) >= 20 GROUP BY 1 HAVING count(DISTINCT doc_id) >= 3),
judged AS (SELECT doc_id, p, line, common.k IS NOT NULL AND doc_id IS DISTINCT FROM holder AS gone FROM keyed LEFT JOIN common USING (k))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped, sha256(coalesce(string_agg(line, chr(10) ORDER BY p) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY 1
"""

_CRC = "xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(string_split({0}, ''), lambda ch: CAST(ord(ch) AS BIGINT))), lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda a, i: xor(a >> 1, 3988292384 * (a & 1)))))"


def _code(branch: str, name: str) -> str:
    return _CRC.format(f"'{branch}:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || {name}") + " % 11"


def _cell(col: str, code: str) -> str:
    return f"CASE {code} WHEN 0 THEN '' WHEN 1 THEN {col} || '!' WHEN 2 THEN {col} || '?' ELSE {col} END"


OP12 = f"""
WITH plain AS (SELECT DISTINCT doc_id, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
base AS (SELECT *, row_number() OVER () AS r, {_code("L", "'row'")} AS l_row, {_code("R", "'row'")} AS r_row,
  {_cell("lang", _code("L", "'lang'"))} AS l_lang, {_cell("lang", _code("R", "'lang'"))} AS r_lang, {_cell("source", _code("L", "'source'"))} AS l_source, {_cell("source", _code("R", "'source'"))} AS r_source FROM plain),
line AS (SELECT r, doc_id, unnest(string_split(text, chr(10))) AS v, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS p FROM base),
coded AS (SELECT *, {_code("L", "p")} AS l, {_code("R", "p")} AS r2 FROM line),
part AS (
  SELECT r, p, l < 5 AS l_new, r2 < 5 AS r_new,
    CASE WHEN l < 3 AND r2 < 3 AND l <> r2 THEN v ELSE CASE CASE WHEN l < 3 THEN l WHEN r2 < 3 THEN r2 ELSE 9 END WHEN 0 THEN NULL WHEN 1 THEN v || '!' WHEN 2 THEN v || '?' ELSE v END END AS a,
    CASE WHEN l IN (3, 4) AND r2 IN (3, 4) AND l <> r2 THEN NULL WHEN l = 3 OR r2 = 3 THEN '!' WHEN l = 4 OR r2 = 4 THEN '?' END AS b,
    CASE WHEN l < 3 AND r2 < 3 AND l <> r2 THEN CASE WHEN l = 0 OR r2 = 0 THEN 3 ELSE 2 END WHEN l < 3 OR r2 < 3 THEN 1 ELSE 0 END AS k,
    CASE WHEN l IN (3, 4) AND r2 IN (3, 4) AND l <> r2 THEN 4 WHEN l IN (3, 4) OR r2 IN (3, 4) THEN 1 ELSE 0 END AS j
  FROM coded),
cell AS (SELECT r, bool_or(l_new) AS l_new, bool_or(r_new) AS r_new, string_agg(concat_ws(chr(10), a, b), chr(10) ORDER BY p) FILTER (WHERE a IS NOT NULL OR b IS NOT NULL) AS text,
  {", ".join(f"sum(CASE WHEN k = {i} THEN 1 ELSE 0 END + CASE WHEN j = {i} THEN 1 ELSE 0 END) AS n{i}" for i in (1, 2, 3, 4))} FROM part GROUP BY 1),
met AS (SELECT base.*, cell.text AS merged, n1, n2, n3, n4,
  l_new OR l_lang <> lang OR l_source <> source AS l_new, r_new OR r_lang <> lang OR r_source <> source AS r_new,
  CASE WHEN l_lang <> lang AND r_lang <> lang AND l_lang <> r_lang THEN 2 WHEN l_lang <> lang OR r_lang <> lang THEN 1 ELSE 0 END AS k_lang,
  CASE WHEN l_source <> source AND r_source <> source AND l_source <> r_source THEN 2 WHEN l_source <> source OR r_source <> source THEN 1 ELSE 0 END AS k_source
  FROM base JOIN cell USING (r)),
fate AS (SELECT *, CASE WHEN l_row <> 0 AND r_row <> 0 THEN 'merged' WHEN (l_row <> 0 AND l_new) OR (r_row <> 0 AND r_new) THEN 'saved' ELSE 'gone' END AS fate FROM met),
old AS (SELECT doc_id,
  CASE fate WHEN 'merged' THEN CASE WHEN k_lang <> 1 THEN lang WHEN l_lang <> lang THEN l_lang ELSE r_lang END WHEN 'saved' THEN lang END AS lang,
  CASE fate WHEN 'merged' THEN CASE WHEN k_source <> 1 THEN source WHEN l_source <> source THEN l_source ELSE r_source END WHEN 'saved' THEN source END AS source,
  CASE fate WHEN 'merged' THEN coalesce(merged, '') WHEN 'saved' THEN text END AS text,
  CASE fate WHEN 'merged' THEN n1 + CASE k_lang WHEN 1 THEN 1 ELSE 0 END + CASE k_source WHEN 1 THEN 1 ELSE 0 END WHEN 'gone' THEN 1 ELSE 0 END AS n_clean,
  CASE fate WHEN 'merged' THEN n2 + CASE k_lang WHEN 2 THEN 1 ELSE 0 END + CASE k_source WHEN 2 THEN 1 ELSE 0 END ELSE 0 END AS n_edit_edit,
  CASE fate WHEN 'merged' THEN n3 WHEN 'saved' THEN 1 ELSE 0 END AS n_edit_delete, CASE fate WHEN 'merged' THEN n4 ELSE 0 END AS n_insert_insert FROM fate),
added AS (
  SELECT -1 - doc_id AS doc_id, 'L' AS side, min(struct_pack(l := lang, s := source, t := CASE l_row WHEN 3 THEN '!' ELSE '?' END)) AS v FROM base WHERE l_row IN (3, 4) AND doc_id IS NOT NULL GROUP BY 1
  UNION ALL SELECT -2 - doc_id, 'R', min(struct_pack(l := lang, s := source, t := CASE r_row WHEN 3 THEN '!' ELSE '?' END)) FROM base WHERE r_row IN (3, 4) AND doc_id IS NOT NULL GROUP BY 1),
new AS (SELECT doc_id, min(v) AS v, min(v) = max(v) AS ok FROM added GROUP BY 1),
rows_of AS (
  SELECT * FROM old UNION ALL
  SELECT doc_id, CASE WHEN ok THEN v.l END, CASE WHEN ok THEN v.s END, CASE WHEN ok THEN v.t END, CASE WHEN ok THEN 1 ELSE 0 END, 0, 0, CASE WHEN ok THEN 0 ELSE 1 END FROM new)
SELECT doc_id, lang, source, sha256(text) AS text_sha256, {", ".join(f"CAST({c} AS BIGINT) AS {c}" for c in ("n_clean", "n_edit_edit", "n_edit_delete", "n_insert_insert"))} FROM rows_of
"""

SQL = {"op12_merge": OP12, "op2_repeats": OP2, "op9_jaccard": OP9, "op13_lines": OP13}
