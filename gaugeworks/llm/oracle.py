"""DuckDB SQL of the queries that SQL can say whole."""

from __future__ import annotations

LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
TERMS = rf"regexp_extract_all(translate(text, {LOWER}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

RANKED = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {TERMS} AS terms FROM documents WHERE text IS NOT NULL),
size AS (SELECT count(*) FILTER (len(terms) > 0) AS n, CAST(sum(len(terms)) AS BIGINT) AS l FROM d),
tf AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(terms) AS term FROM d) GROUP BY r, term),
i AS (SELECT row_number() OVER () AS q, item_id, {TERMS} AS terms FROM benchmark WHERE text IS NOT NULL),
asked AS (SELECT DISTINCT q, unnest(terms) AS term FROM i),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * n + 2) / (2 * df + 1))) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), size
),
lengths AS (SELECT r, doc_id, 50 + (50 * len(terms) * n) // l AS m FROM d, size),
scored AS (
  SELECT q, r, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
  FROM asked JOIN tf USING (term) JOIN weights USING (term) JOIN lengths USING (r) GROUP BY q, r
),
ranked AS (
  SELECT q, doc_id, score, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST) AS rank
  FROM scored JOIN lengths USING (r) WHERE score > 0
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked JOIN i USING (q) WHERE rank <= 50
"""

LINES = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT r, doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS i FROM d),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), {LOWER}) AS key FROM l),
shared AS (SELECT key, min(doc_id) AS least FROM k WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) > 1),
m AS (SELECT k.*, coalesce(doc_id <> least, false) AS dropped FROM k LEFT JOIN shared USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT dropped), '')) AS kept_sha256
FROM m GROUP BY r, doc_id
"""


def statements() -> dict[str, str]:
    return {"op11_ranked_search": RANKED, "op13_line_dedup": LINES}
