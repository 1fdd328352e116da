"""Table checks, row ids and the dataset profile."""

from datetime import date

from pyspark.sql import functions as F

from catalog import inputs as I
from catalog import query
from catalog.aggregates import COUNTS, built_tables
from catalog.filters import SPEC
from catalog.scans import matches
from lexspark import model as M
from lexspark.operators import tables as T
from lexspark.plans.dataset import build_dataset
from lexspark.plans.graph_inputs import inputs_from_graph
from lexspark.spec import JobSpec, ListSpec, Metadata

ORDER = ["celex_source", "celex_target", "relation_type", "pos"]


@query("q_surrogate_ids", f"""
SELECT row_number() OVER (ORDER BY {', '.join(ORDER)}) AS id, {', '.join(ORDER)} FROM relations_src""", "relations_src")
def surrogate_ids(spark, sf):
    return T.with_ids(I.relations(spark, sf).select(*ORDER), ORDER)


@query("q_constraint_violations", """
SELECT 'works' AS table_name, 'not_null' AS rule, 'title' AS column_name,
       (SELECT count(*) FROM works_src WHERE k % 30 = 0) + (SELECT count(*) FROM works_src WHERE k % 150 = 0) AS n_violations
UNION ALL SELECT 'works', 'not_null', 'celex_id', 0
UNION ALL SELECT 'works', 'unique', 'celex_id', (SELECT count(DISTINCT celex_id) FROM works_src WHERE k % 50 = 0)""",
       "works_src")
def violations(spark, sf):
    w = I.works(spark, sf).withColumn("title", F.when(F.col("k") % 30 != 0, F.col("celex_id")))
    return T.constraint_violations(
        w.unionByName(w.filter("k % 50 = 0")), "works", unique=["celex_id"], not_null=["celex_id", "title"]
    )


JOB = JobSpec(data=SPEC, metadata=Metadata(project_name="Check", date_created=date(2024, 1, 31), author="A"))


@query("q_dataset_profile", f"""
SELECT * FROM (VALUES ('metadata', 'project_name', 'Check'), ('metadata', 'author', 'A'),
  ('metadata', 'description', 'A dataset of structured legal documents.'),
  ('metadata', 'date_created', '2024-01-31'), ('metadata', 'version', '1.0'), ('selection', 'mode', 'discover'),
  ('selection', 'document_types', 'directive, regulation'), ('selection', 'start_date', '1995-03-01'),
  ('selection', 'end_date', '1998-09-02'), ('selection', 'keywords', 'RED, ring'), ('selection', 'corrigenda', 'no'),
  ('selection', 'consolidated_texts', 'yes'), ('selection', 'national_transpositions', 'no'),
  ('extraction', 'recitals', 'yes'), ('extraction', 'articles', 'yes'), ('extraction', 'annexes', 'yes'),
  ('relations', 'include_relations', 'yes'), ('relations', 'include_original_act_relations', 'no'),
  ('output', 'formats', 'csv, parquet'), ('output', 'include_raw_full_text', 'no')) v(section, item, value)
UNION ALL SELECT 'statistics', 'n_' || table_name, CAST(n_rows AS varchar) FROM ({COUNTS})
UNION ALL SELECT 'statistics', 'avg_' || table_name, printf('%.2f', n_rows / (SELECT count(*) FROM works_src WHERE k >= 0))
  FROM ({COUNTS}) WHERE table_name <> 'works'
UNION ALL SELECT 'documents', celex_id, CAST((SELECT greatest(count(DISTINCT celex_id) - 10, 0) FROM works_src WHERE k >= 0) AS varchar)
  FROM (SELECT DISTINCT celex_id FROM works_src WHERE k >= 0 ORDER BY 1 LIMIT 10)
UNION ALL SELECT 'concepts', keyword || ' | ' || label, uri FROM
  (SELECT *, row_number() OVER (PARTITION BY keyword ORDER BY label, uri) AS rank FROM
    (SELECT keyword, uri, min(label) AS label FROM matches_src GROUP BY keyword, uri)) WHERE rank <= 5
UNION ALL SELECT 'concept_counts', keyword, CAST(count(DISTINCT uri) AS varchar) FROM matches_src GROUP BY keyword""",
       "works_src all_units relations_src matches_src")
def profile(spark, sf):
    tables = built_tables(spark, sf)
    concepts = matches(spark, sf).groupBy("keyword", "uri").agg(F.min("label").alias("label"))
    return T.dataset_profile(tables, JOB, ids=tables["works"], concepts=concepts)


@query("q_build_from_graph", """
SELECT w.celex_id,
       CASE WHEN k % 4 = 0 THEN '[Unavailable]' WHEN k % 11 = 0 THEN 'Act X ' || w.celex_id ELSE 'Act ' || w.celex_id END AS title,
       CAST(CASE WHEN k % 13 = 0 THEN d + INTERVAL 1 DAY ELSE d END AS date) AS date_adopted,
       coalesce(r.n, 0) AS n_relations, coalesce(r.n_cites, 0) AS n_cites
FROM works_src w LEFT JOIN (
  SELECT celex_source, count(*) AS n, count(*) FILTER (relation_type = 'cites') AS n_cites
  FROM (SELECT DISTINCT celex_source, celex_target, relation_type FROM relations_src WHERE celex_target <> '') GROUP BY ALL
) r ON r.celex_source = w.celex_id
WHERE k >= 0""", "works_src relations_src")
def build_from_graph(spark, sf):
    """Works and relations built from triples alone; some works have two dates, some two titles, some no English one."""
    triples = I.triples(spark, sf)
    number = F.regexp_extract("s", r"(\d+)$", 1).cast("long")
    second = triples.filter((F.col("p") == M.P_TITLE) & (number % 11 == 0))
    second = second.select("s", "p", F.concat(F.lit("Act X "), F.substring("o", F.lit(5), F.length("o"))).alias("o"))
    inputs = inputs_from_graph(triples.unionByName(second), I.manifestations(spark, sf))
    ids = inputs.properties.select("celex_id").distinct()
    tables = build_dataset(inputs, JobSpec(data=ListSpec(celex_ids=frozenset({"32016R0679"}))), ids)
    counts = tables["relations"].groupBy(F.col("celex_source").alias("celex_id")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("relation_type") == "cites").alias("n_cites")
    )
    return tables["works"].join(counts, "celex_id", "left").select(
        "celex_id", "title", "date_adopted", F.coalesce("n", F.lit(0)).alias("n_relations"),
        F.coalesce("n_cites", F.lit(0)).alias("n_cites"),
    )
