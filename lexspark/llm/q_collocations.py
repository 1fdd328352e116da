"""Query of the phrase collocations, and its SQL: all phrases counted, without growth or bounds."""

from __future__ import annotations

from lexspark.llm.collocations import collocations
from lexspark.llm.common import read
from lexspark.llm.queries import query

COLLOCATIONS_SQL = r"""
WITH docs AS (
  SELECT coalesce(lang, 'und') AS lang, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents WHERE text IS NOT NULL
),
piece AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS p FROM docs),
listed AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS ws FROM piece),
size AS (SELECT unnest([1, 2, 3, 4]) AS k),
grams AS (
  SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS phrase
  FROM (SELECT lang, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM listed, size WHERE len(ws) >= k)
),
f AS (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL),
total AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
cand AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS ws FROM f WHERE k > 1 AND f >= 30),
cuts AS (SELECT lang, k, phrase, a, ws, unnest(range(1, k)) AS cut FROM cand),
scored AS (
  SELECT c.*, x.f AS l, y.f AS r, CAST((2000000::HUGEINT * a) // (x.f + y.f) AS BIGINT) AS score
  FROM cuts c
  JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.ws[1:c.cut], ' ')
  JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.ws[c.cut + 1:c.k], ' ')
),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
inner_part AS (
  SELECT lang, a, array_to_string(ws[i:i + m - 1], ' ') AS phrase
  FROM (SELECT lang, a, k, ws, m, unnest(range(1, k - m + 2)) AS i FROM cand, (SELECT unnest([2, 3]) AS m) WHERE m < k)
),
longer AS (SELECT lang, phrase, max(a) AS most FROM inner_part GROUP BY ALL),
kept AS (
  SELECT b.* FROM best b LEFT JOIN longer USING (lang, phrase)
  WHERE most IS NULL OR 100::HUGEINT * most < 80::HUGEINT * b.a
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM kept JOIN total USING (lang)
QUALIFY rank <= 2000
"""


@query("op12_collocations", COLLOCATIONS_SQL)
def op12(spark, sf_dir):
    return collocations(read(spark, sf_dir, "documents"))
