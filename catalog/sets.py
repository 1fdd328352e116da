"""Set operations."""

from pyspark.sql import functions as F

from catalog import inputs as I
from catalog import query
from catalog.joins import PROCEDURES
from lexspark.operators import sets as S
from lexspark.operators.graph import match_keywords, resolve_procedures


@query("q_union_ids", """
SELECT celex_id FROM works_src WHERE k % 3 = 0
UNION
SELECT CASE WHEN a.work IS NULL THEN d.proposal ELSE a.work END
FROM (SELECT proposal FROM dossiers_src JOIN
        (SELECT y || '/' || lpad(CAST(c AS varchar), 4, '0') || '/COD' AS p FROM range(1995, 2002) a(y), range(60) b(c))
        ON contains(ref, p) WHERE NOT contains(proposal, '(')) d
LEFT JOIN adopts_src a USING (proposal)""", "works_src dossiers_src adopts_src")
def union_ids(spark, sf):
    listed = I.works(spark, sf).filter("k % 3 = 0")
    resolved = resolve_procedures(I.dossiers(spark, sf), I.adopts(spark, sf), PROCEDURES)
    return S.union_ids(listed, resolved)


@query("q_distinct_ids", "SELECT DISTINCT celex_target AS celex_id FROM relations_src", "relations_src")
def distinct_ids(spark, sf):
    return S.distinct_ids(I.relations(spark, sf).withColumnRenamed("celex_target", "celex_id"))


@query("q_review_diff", """
SELECT uri, CASE WHEN NOT fetched THEN 'added' WHEN NOT reviewed THEN 'removed' ELSE 'kept' END AS status
FROM (SELECT uri, bool_or(contains(lower(label), 'red')) AS fetched,
             bool_or(scheme = 1 AND (contains(lower(label), 'red') OR contains(lower(label), 'ring'))) AS reviewed
      FROM labels_src GROUP BY uri) WHERE fetched OR reviewed""", "labels_src")
def review_diff(spark, sf):
    labels = I.labels(spark, sf)
    fetched = match_keywords(labels, ["red"])
    reviewed = match_keywords(labels.filter("scheme = 1"), ["red", "ring"])
    return S.review_diff(fetched, reviewed)
