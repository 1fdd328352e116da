"""Document selection filters."""

from datetime import date

from pyspark.sql import functions as F

from catalog import inputs as I
from catalog import query
from lexspark.model import P_IN_SCHEME
from lexspark.operators import filters as X
from lexspark.operators.graph import match_keywords
from lexspark.operators.units import extract_units, type_bits
from lexspark.functions.markup import structure_of
from lexspark.plans.discover import discover_works, keyword_concepts
from lexspark.spec import DiscoverSpec

START, END = date(1995, 3, 1), date(1998, 9, 2)


@query("q_date_range", """
SELECT celex_id, d AS date FROM works_src WHERE d > DATE '1995-03-01' AND d < DATE '1998-09-02'""", "works_src")
def date_range(spark, sf):
    return X.between_exclusive(I.props(spark, sf), "date", START, END).select("celex_id", "date")


@query("q_type_filter", "SELECT celex_id, ty AS type FROM works_src WHERE ty IN ('R', 'PC')", "works_src")
def type_filter(spark, sf):
    return X.type_filter(I.props(spark, sf), ["R", "PC"]).select("celex_id", "type")


@query("q_sector_filter", "SELECT celex_id, sector FROM works_src WHERE sector IN ('3', '0', '7')", "works_src")
def sector_filter(spark, sf):
    return X.sector_filter(I.props(spark, sf), consolidated=True, transpositions=True).select("celex_id", "sector")


@query("q_corrigenda_filter", "SELECT celex_id FROM works_src WHERE celex_id NOT LIKE '%(01)'", "works_src")
def corrigenda(spark, sf):
    return X.corrigenda_filter(I.props(spark, sf)).select("celex_id")


@query("q_concept_filter", """
SELECT celex_id FROM works_src WHERE celex_id IN
 (SELECT celex_id FROM tags_src WHERE uri IN (SELECT uri FROM matches_src WHERE keyword = 'RED'))""",
       "works_src tags_src matches_src")
def concept(spark, sf):
    uris = match_keywords(I.labels(spark, sf), ["RED"]).select("uri")
    return X.concept_filter(I.props(spark, sf), I.tags(spark, sf), uris).select("celex_id")


@query("q_lang_filter", """
SELECT uri, kind, label, lang FROM labels_src WHERE lower(lang) = 'en' OR lower(lang) LIKE 'en-%'""", "labels_src")
def lang(spark, sf):
    return X.language_filter(I.labels(spark, sf)).select("uri", "kind", "label", "lang")


@query("q_in_scheme", "SELECT uri, kind, label FROM labels_src WHERE scheme = 1", "labels_src")
def scheme(spark, sf):
    labels = I.labels(spark, sf)
    facts = labels.select(
        F.col("uri").alias("s"), F.lit(P_IN_SCHEME).alias("p"), F.col("scheme").cast("string").alias("o")
    )
    return X.in_scheme(labels, facts, "1", key="uri").select("uri", "kind", "label")


SPEC = DiscoverSpec(
    start_date=START, end_date=END, document_types=frozenset({"regulation", "directive"}),
    filter_keywords=frozenset({"RED", "ring"}), include_consolidated_texts=True,
)


@query("q_discover_works", """
SELECT DISTINCT celex_id FROM works_src
WHERE d > DATE '1995-03-01' AND d < DATE '1998-09-02' AND ty IN ('R', 'L') AND sector IN ('3', '0')
  AND NOT regexp_matches(celex_id, '\\([0-9]{2}\\)$')
  AND (celex_id IN (SELECT celex_id FROM tags_src WHERE uri IN
        (SELECT uri FROM labels_src WHERE scheme = 1 AND (lower(lang) = 'en' OR lower(lang) LIKE 'en-%')
           AND (contains(lower(label), 'red') OR contains(lower(label), 'ring')))))""", "works_src tags_src labels_src")
def discover(spark, sf):
    uris = keyword_concepts(I.labels(spark, sf), SPEC, scheme="1")
    return discover_works(I.props(spark, sf), SPEC, I.tags(spark, sf), uris)


@query("q_drop_empty_targets", """
SELECT celex_source, celex_target, relation_type FROM relations_src WHERE celex_target <> ''""", "relations_src")
def drop_empty(spark, sf):
    return X.drop_empty(I.relations(spark, sf), "celex_target").select("celex_source", "celex_target", "relation_type")


@query("q_project_works", """
SELECT celex_id, 'x' AS document_type, celex_id AS title, d AS date_adopted, 'eng' AS language FROM works_src""",
       "works_src")
def project(spark, sf):
    works = I.works(spark, sf).select(
        "celex_id", F.lit("x").alias("document_type"), F.col("celex_id").alias("title"),
        F.col("d").alias("date_adopted"), F.lit("eng").alias("language"), F.lit("<p/>").alias("full_text_html"),
    )
    return X.project_works(works, include_raw=False)


@query("q_unit_type_toggle", """
SELECT u.doc_id, type, number, text FROM all_units u WHERE u.kind = u.doc_id % 3 AND type IN ('recital', 'annex')""",
       "all_units")
def toggle(spark, sf):
    pages = I.legal_pages(spark, sf).withColumn("structure", structure_of(F.col("html"))).withColumn(
        "want", F.lit(type_bits(["recital", "annex"]))
    )
    return X.select_unit_types(
        extract_units(pages, ["doc_id"], "html", partitioned=True), ["recital", "annex"]
    ).select("doc_id", "type", "number", "text")


@query("q_invalid_ids", r"""
SELECT DISTINCT 'id' AS entry_kind, celex_id AS value FROM works_src WHERE celex_id LIKE '%(01)'
UNION SELECT DISTINCT 'procedure', ' ' || year(d) || '/' || lpad(CAST(ck % 10000 AS varchar), 4, '0') || '/COD'
FROM works_src WHERE ty = 'PC' AND k % 2 = 0""", "works_src")
def invalid(spark, sf):
    w = I.works(spark, sf)
    ids = w.select(F.concat(F.lit(" "), F.lower("celex_id")).alias("celex_id"))
    number = F.concat(
        F.when(F.col("k") % 2 == 0, " ").otherwise(""), F.year("d").cast("string"), F.lit("/"),
        F.lpad((F.col("ck") % 10000).cast("string"), 4, "0"), F.lit("/COD"),
    )
    return X.invalid_ids(ids, w.filter("ty = 'PC'").select(number.alias("procedure")))
