"""Query of the rule ledger."""

from __future__ import annotations

from lexspark.llm.common import read
from lexspark.llm.quality_rules import judged
from lexspark.llm.queries import query

#: The same measurements and verdict, written with unnested words and lines.
LEDGER_SQL = r"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
listed AS (SELECT doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM docs),
spots AS (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS p FROM listed WHERE len(ws) > 0),
word AS (SELECT doc_id, p, ws[p] AS w, CASE WHEN p + 2 <= len(ws) THEN ws[p] || ' ' || ws[p + 1] || ' ' || ws[p + 2] END AS tri FROM spots),
counted AS (SELECT doc_id, p, w, tri IS NOT NULL AND count(*) OVER (PARTITION BY doc_id, tri) > 1 AS again FROM word),
covered AS (
  SELECT doc_id, w, again
      OR coalesce(lag(again, 1) OVER (PARTITION BY doc_id ORDER BY p), false)
      OR coalesce(lag(again, 2) OVER (PARTITION BY doc_id ORDER BY p), false) AS repeated
  FROM counted
),
per_word AS (
  SELECT doc_id, count(*) AS n_words, sum(length(w))::BIGINT AS word_chars, count(*) FILTER (repeated) AS n_repeat_words
  FROM covered GROUP BY doc_id
),
lines AS (
  SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM docs)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id
),
measured AS (
  SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0) AS word_chars,
         len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
         coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines,
         len(regexp_extract_all(t, '\p{Lu}')) AS n_upper, len(regexp_extract_all(t, '!!')) AS n_bangs
  FROM docs d LEFT JOIN per_word USING (doc_id) LEFT JOIN lines USING (doc_id)
),
judged AS (
  SELECT *, CAST(CASE WHEN n_words < 50 THEN 1 ELSE 0 END
    + CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END
    + CASE WHEN 100 * n_symbols > 10 * n_words THEN 4 ELSE 0 END
    + CASE WHEN 100 * n_dup_lines > 50 * n_lines THEN 8 ELSE 0 END
    + CASE WHEN 100 * n_upper > 40 * word_chars THEN 16 ELSE 0 END
    + CASE WHEN 100 * n_bangs > 40 * n_words THEN 32 ELSE 0 END
    + CASE WHEN word_chars < 2 * n_words OR word_chars > 15 * n_words THEN 64 ELSE 0 END AS BIGINT) AS failed
  FROM measured
)
"""


@query("op5_quality_rules", LEDGER_SQL + """
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failed & 3 <> 0 AS base_failed,
       failed = 0 AS kept, failed, n_lines, n_upper, n_bangs
FROM judged""")
def op5(spark, sf_dir):
    return judged(read(spark, sf_dir, "documents"))
