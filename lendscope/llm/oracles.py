"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

EXACT_DEDUP = r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body FROM documents)
SELECT doc_id,
       min(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       doc_id = min(doc_id) OVER same AS kept,
       sha256(body) AS text_sha256
FROM t
WINDOW same AS (PARTITION BY body)
"""

LINE_DEDUP = r"""
WITH t AS (SELECT doc_id, text, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
w AS (
  SELECT doc_id, pos, lines[pos + 1 : pos + 3] AS run
  FROM (SELECT doc_id, lines, unnest(range(0, len(lines) - 2)) AS pos FROM t WHERE len(lines) >= 3)
),
firsts AS (
  SELECT run, min(doc_id) AS first_doc, arg_min(pos, (doc_id, pos)) AS first_at FROM w GROUP BY run HAVING count(*) > 1
),
later AS (
  SELECT doc_id, pos, CASE WHEN doc_id = first_doc THEN first_at END AS home
  FROM w JOIN firsts USING (run)
  WHERE NOT (doc_id = first_doc AND pos = first_at)
),
gone AS (
  SELECT DISTINCT doc_id, line
  FROM (SELECT doc_id, home, unnest(range(pos, pos + 3)) AS line FROM later)
  WHERE home IS NULL OR line >= home + 3
),
lists AS (SELECT doc_id, list(line) AS removed FROM gone GROUP BY doc_id)
SELECT t.doc_id,
       CAST(len(lines) AS BIGINT) AS n_lines,
       coalesce(len(removed), 0) AS n_removed,
       CASE WHEN removed IS NULL THEN text
            ELSE coalesce(array_to_string([lines[k + 1] for k in range(0, len(lines)) if NOT list_contains(removed, k)], chr(10)), '')
       END AS text
FROM t LEFT JOIN lists ON t.doc_id = lists.doc_id
"""

DECONTAMINATE = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
i AS (SELECT item_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
runs AS (
  SELECT DISTINCT item_id, size, array_to_string(ws[pos + 1 : pos + size], ' ') AS run
  FROM (SELECT item_id, ws, least(10, len(ws)) AS size, unnest(range(0, greatest(len(ws) - 9, 1))) AS pos FROM i WHERE len(ws) > 0)
),
places AS (
  SELECT doc_id, size, pos, array_to_string(ws[pos + 1 : pos + size], ' ') AS run
  FROM (SELECT doc_id, ws, size, unnest(range(0, len(ws) - size + 1)) AS pos
        FROM d CROSS JOIN (SELECT DISTINCT size FROM runs) WHERE len(ws) >= size)
),
found AS (SELECT doc_id, item_id, places.size, pos FROM places JOIN runs USING (size, run)),
words AS (SELECT doc_id, count(DISTINCT word) AS n_hit FROM (SELECT doc_id, unnest(range(pos, pos + size)) AS word FROM found) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id
)
SELECT d.doc_id,
       CAST(len(ws) AS BIGINT) AS n_words,
       CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(listed, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""


def licenses_sql() -> str:
    """The scan over files named by source, language and id."""
    from lendscope.llm import licenses as L

    rows = ", ".join("({}, '{}', '{}')".format(k, name, text.replace("'", "''")) for k, (name, text) in enumerate(L.TEMPLATES))
    return rf"""
WITH template(k, license, line) AS (VALUES {rows}),
f AS (
  SELECT doc_id, concat_ws('/', coalesce(source, '_'), coalesce(lang, '_'), CAST(doc_id AS VARCHAR)) AS path, coalesce(text, '') AS text
  FROM documents
),
held AS (
  SELECT doc_id, path, length(text) AS chars, line
  FROM (SELECT DISTINCT doc_id, path, text, trim(unnest(string_split(text, chr(10))), ' ') AS line FROM f)
  WHERE regexp_matches(line, '{L.NOTICE}')
),
lines AS (SELECT line, count(*) AS n FROM held GROUP BY line),
df AS (
  SELECT token, sum(n) AS df
  FROM (SELECT n, unnest(list_distinct(regexp_extract_all(lower(line), '{L.TOKEN}'))) AS token FROM lines
        UNION ALL SELECT 1, unnest(list_distinct(regexp_extract_all(lower(line), '{L.TOKEN}'))) FROM template)
  GROUP BY token
),
total AS (SELECT coalesce(sum(n), 0) + {len(L.TEMPLATES)} AS n FROM lines),
v AS (
  SELECT line, token, count(*) * (ln(((SELECT n FROM total) + 1) / (any_value(df) + 1)) + 1) AS weight
  FROM (SELECT line, unnest(regexp_extract_all(lower(line), '{L.TOKEN}')) AS token FROM lines) JOIN df USING (token)
  GROUP BY line, token
),
tv AS (
  SELECT k, license, token, count(*) * (ln(((SELECT n FROM total) + 1) / (any_value(df) + 1)) + 1) AS weight
  FROM (SELECT k, license, unnest(regexp_extract_all(lower(line), '{L.TOKEN}')) AS token FROM template) JOIN df USING (token)
  GROUP BY k, license, token
),
scored AS (
  SELECT line, license, round(sum(v.weight * tv.weight) / any_value(norm) / any_value(size), 6) AS cosine
  FROM v JOIN tv USING (token)
  JOIN (SELECT line, sqrt(sum(weight * weight)) AS norm FROM v GROUP BY line) USING (line)
  JOIN (SELECT k, sqrt(sum(weight * weight)) AS size FROM tv GROUP BY k) USING (k)
  GROUP BY line, k, license
),
matched AS (
  SELECT line, license, cosine FROM scored WHERE cosine >= {L.LEAST_COSINE}
  QUALIFY row_number() OVER (PARTITION BY line ORDER BY cosine DESC, license) = 1
),
own AS (
  SELECT doc_id, path, license, cosine, is_file
  FROM (SELECT doc_id, path, license, cosine,
               sum(length(line)) OVER (PARTITION BY doc_id) >= {L.FILE_SHARE} * chars AS is_file,
               row_number() OVER (PARTITION BY doc_id ORDER BY cosine DESC, license) AS r
        FROM held JOIN matched USING (line))
  WHERE r = 1
),
dirs AS (
  SELECT regexp_replace(path, '/[^/]*$', '') AS dir, path, license, cosine FROM own WHERE is_file
  QUALIFY row_number() OVER (PARTITION BY dir ORDER BY cosine DESC, path) = 1
)
SELECT f.doc_id, f.path,
       CASE WHEN own.doc_id IS NOT NULL THEN own.license ELSE coalesce(a.license, b.license) END AS license,
       CASE WHEN own.doc_id IS NOT NULL THEN own.cosine ELSE coalesce(a.cosine, b.cosine) END AS cosine,
       CASE WHEN own.is_file THEN 'file' WHEN own.doc_id IS NOT NULL THEN 'header' WHEN coalesce(a.path, b.path) IS NOT NULL THEN 'inherited' END AS origin,
       CASE WHEN own.doc_id IS NULL THEN coalesce(a.path, b.path) END AS from_path
FROM f
LEFT JOIN own USING (doc_id)
LEFT JOIN dirs a ON a.dir = regexp_replace(f.path, '/[^/]*$', '')
LEFT JOIN dirs b ON b.dir = regexp_replace(f.path, '/.*$', '')
"""


ORACLES: dict[str, str] = {
    "op2_licenses": licenses_sql(),
    "op4_line_dedup": LINE_DEDUP,
    "op6_decontaminate": DECONTAMINATE,
    "op10_exact_dedup": EXACT_DEDUP,
}
