"""Aggregations."""

from pyspark.sql import functions as F

from catalog import inputs as I
from catalog import query
from catalog.ctes import CELEX
from catalog.scans import matches
from lexspark.functions.ids import is_valid_celex
from lexspark.functions.markup import MANUAL_CLASSES, structure_of
from lexspark.operators import graph as G
from lexspark.operators import tables as T
from lexspark.operators.sequence import concat_ordered
from lexspark.operators import tokens as K
from lexspark.operators.tokens import html_tokens
from lexspark.operators.units import ALL_TYPES, extract_units


@query("q_label_sets", """
SELECT keyword, uri, string_agg(DISTINCT label, '|' ORDER BY label) AS labels FROM matches_src GROUP BY keyword, uri""",
       "matches_src")
def label_sets(spark, sf):
    return G.label_sets(matches(spark, sf)).withColumn("labels", F.array_join("labels", "|"))


@query("q_merge_labels", """
SELECT keyword, uri, string_agg(DISTINCT label, '|' ORDER BY label) AS labels, count(DISTINCT label) AS n
FROM matches_src GROUP BY keyword, uri""", "matches_src")
def merge_labels(spark, sf):
    merged = G.merge_labels(matches(spark, sf, "pref"), matches(spark, sf, "alt"))
    return merged.select("keyword", "uri", F.array_join("labels", "|").alias("labels"), F.size("labels").alias("n"))


@query("q_label_map", """
SELECT keyword, 0 AS part, string_agg(uri || '=' || labels, ';' ORDER BY uri) AS concepts
FROM (SELECT keyword, uri, string_agg(DISTINCT label, '|' ORDER BY label) AS labels FROM matches_src GROUP BY keyword, uri)
GROUP BY keyword""", "matches_src")
def label_map(spark, sf):
    entries = F.transform(
        F.array_sort(F.map_entries("concepts")),
        lambda e: F.concat_ws("=", e["key"], F.array_join(e["value"], "|")),
    )
    return G.label_map(matches(spark, sf)).withColumn("concepts", F.array_join(entries, ";"))


@query("q_pivot_properties", """
SELECT celex_id, arg_max(value, (pos, value)) FILTER (data_type = 'title') AS title,
       arg_max(value, (pos, value)) FILTER (data_type = 'date') AS date
FROM (SELECT celex_id, CASE WHEN l_linenumber % 2 = 1 THEN 'title' ELSE 'date' END AS data_type,
             'v' || l_partkey AS value, l_linenumber AS pos FROM lineitem JOIN works_src ON k = l_orderkey)
GROUP BY celex_id""", "works_src")
def pivot_properties(spark, sf):
    lines = I.table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("pos"),
        F.concat(F.lit("v"), F.col("l_partkey").cast("string")).alias("value"),
    )
    rows = lines.join(I.main_works(spark, sf).select("k", "celex_id"), "k").select(
        "celex_id", F.when(F.col("pos") % 2 == 1, "title").otherwise("date").alias("data_type"), "value", "pos"
    )
    return G.pivot_properties(rows)


@query("q_relation_map", """
SELECT celex_source, 0 AS part, string_agg(relation_type || '=' || targets, ';' ORDER BY relation_type) AS relations
FROM (SELECT celex_source, relation_type, string_agg(celex_target, ',' ORDER BY pos, celex_target) AS targets
      FROM relations_src GROUP BY celex_source, relation_type) GROUP BY celex_source""", "relations_src")
def relation_map(spark, sf):
    entries = F.transform(
        F.array_sort(F.map_entries("relations")),
        lambda e: F.concat_ws("=", e["key"], F.array_join(e["value"], ",")),
    )
    return G.relation_map(I.relations(spark, sf)).withColumn("relations", F.array_join(entries, ";"))


def built_tables(spark, sf):
    pages = I.legal_pages(spark, sf).withColumn("structure", structure_of(F.col("html"))).withColumn(
        "want", F.lit(ALL_TYPES)
    )
    return {
        "works": I.main_works(spark, sf),
        "text_units": extract_units(pages, ["doc_id"], "html", partitioned=True),
        "relations": I.relations(spark, sf).filter("celex_target <> ''"),
    }


COUNTS = """
SELECT 'works' AS table_name, count(*) AS n_rows FROM works_src WHERE k >= 0
UNION ALL SELECT 'text_units', count(*) FROM all_units WHERE kind = doc_id % 3
UNION ALL SELECT 'relations', count(*) FROM relations_src WHERE celex_target <> ''"""


@query("q_table_counts", COUNTS, "works_src all_units relations_src")
def table_counts(spark, sf):
    t = built_tables(spark, sf)
    return T.table_counts(t["works"], t["text_units"], t["relations"])


@query("q_dataset_stats", f"""
SELECT *, n_text_units / n_works AS avg_text_units, n_relations / n_works AS avg_relations FROM (
  SELECT max(n_rows) FILTER (table_name = 'works') AS n_works, max(n_rows) FILTER (table_name = 'text_units') AS n_text_units,
         max(n_rows) FILTER (table_name = 'relations') AS n_relations FROM ({COUNTS}))""",
       "works_src all_units relations_src")
def dataset_stats(spark, sf):
    t = built_tables(spark, sf)
    return T.dataset_stats(t["works"], t["text_units"], t["relations"])


@query("q_concept_counts", """
SELECT keyword, count(DISTINCT uri) AS n_concepts, (SELECT count(DISTINCT uri) FROM matches_src) AS n_unique
FROM matches_src GROUP BY keyword""", "matches_src")
def concept_counts(spark, sf):
    m = matches(spark, sf)
    return G.concept_counts(m).crossJoin(F.broadcast(G.unique_concepts(m)))  # one row


@query("q_concat_ordered", """
SELECT conv_id, string_agg(text, ' ' ORDER BY turn, text) AS text FROM conversations GROUP BY conv_id""")
def concat(spark, sf):
    return concat_ordered(I.table(spark, sf, "conversations"), ["conv_id"], "turn", "text")


@query("q_structure_flags", """
SELECT doc_id, doc_id % 3 = 0 AS is_standard, doc_id % 3 = 1 AS is_manual, doc_id % 3 = 2 AS is_plain FROM documents""")
def structure_flags(spark, sf):
    t = html_tokens(I.legal_pages(spark, sf), ["doc_id"], "html", partitioned=True)
    return K.structure_flags(t, ["doc_id"])


@query("q_outcome_counts", f"""
SELECT CASE WHEN regexp_matches(celex_id, '{CELEX}') THEN 'successful' ELSE 'failed' END AS status, count(*) AS n
FROM works_src GROUP BY 1""", "works_src")
def outcomes(spark, sf):
    status = F.when(is_valid_celex(F.col("celex_id")), "successful").otherwise("failed")
    return T.outcome_counts(I.works(spark, sf).withColumn("status", status))
