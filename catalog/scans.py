"""Scans and sources."""

from pyspark.sql import functions as F

from catalog import inputs as I
from catalog import query
from catalog.ctes import CELEX
from lexspark.functions.ids import resource_url
from lexspark.functions.markup import is_missing
from lexspark.operators.graph import match_keywords
from lexspark.sources.landed import (
    drop_incomplete, inline, notice_fields, parse_listing, read_bindings, read_manifestations,
)


@query("q_scan_manifestations", """
SELECT celex_id, role, fmt, true AS has_body, md5(html || tail) AS body_md5
FROM body_facts JOIN page_html USING (doc_id, kind)""", "body_facts page_html")
def scan_manifestations(spark, sf):
    """Bodies that were landed as files, through the reader."""
    bodies = read_manifestations(spark, I.landed(I.manifestations(spark, sf)))
    return bodies.select(
        "celex_id", "role", "fmt", (~is_missing(F.col("body"))).alias("has_body"), F.md5("body").alias("body_md5")
    )


def relation_bindings(spark, sf):
    r = I.relations(spark, sf).select(
        "sk", F.col("celex_source").alias("source"),
        F.when(F.col("tk") % 7 != 0, F.col("celex_target")).alias("target"),
        F.col("relation_type").alias("relation"),
        F.struct("pos", "tk").alias("o"),
    )
    return I.bindings(r, ["source", "target", "relation"], F.col("sk"), "o")


@query("q_decode_bindings", """
SELECT sk AS doc, celex_source AS source, CASE WHEN tk % 7 <> 0 THEN celex_target END AS target,
       relation_type AS relation FROM relations_src""", "relations_src")
def decode_bindings(spark, sf):
    return read_bindings(
        relation_bindings(spark, sf), "json", ["source", "target", "relation"], keep=["doc"]
    ).drop("pos")


@query("q_skip_incomplete", """
SELECT sk AS doc, celex_source AS source, celex_target AS target, relation_type AS relation
FROM relations_src WHERE tk % 7 <> 0""", "relations_src")
def skip_incomplete(spark, sf):
    names = ["source", "target", "relation"]
    rows = read_bindings(relation_bindings(spark, sf), "json", names, keep=["doc"]).drop("pos")
    return drop_incomplete(rows, names)


@query("q_notice_fields", """
SELECT celex_id, coalesce(notice_title, '') AS notice_title, notice_date FROM notices_src""", "notices_src")
def notices(spark, sf):
    return notice_fields(I.notices(spark, sf), "xml").select("celex_id", "notice_title", "notice_date")


LISTING = """
SELECT doc, pos, 'http://example.org/doc?p=' || l_partkey || '&l=' || l_linenumber AS url,
       CASE l_returnflag WHEN 'A' THEN '1_EN_ACT_part1.html' WHEN 'N' THEN '1_EN_annexe.html' ELSE '1_EN_cover.html' END AS stream_name,
       CASE WHEN l_linenumber IN (5, 6) THEN 999 ELSE l_linenumber END AS stream_order
FROM (SELECT l_orderkey AS doc, *, row_number() OVER (PARTITION BY l_orderkey
        ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_returnflag) - 1 AS pos FROM lineitem)
WHERE l_linenumber <> 7"""


@query("q_parse_listing", LISTING)
def listing(spark, sf):
    return parse_listing(I.listings(spark, sf), "html", ["doc"])


@query("q_inline_values", """
SELECT uri, count(*) AS n FROM tags_src
WHERE uri IN (SELECT 'http://example.org/concept/' || x FROM range(100) r(x)) GROUP BY uri""", "tags_src")
def inline_values(spark, sf):
    values = inline(spark, [I.CONCEPT + str(i) for i in range(100)], "uri")
    return (
        I.tags(spark, sf).join(F.broadcast(values), "uri")  # 100 parameters
        .groupBy("uri").agg(F.count(F.lit(1)).alias("n"))
    )


@query("q_resource_url", f"""
SELECT k, CASE WHEN regexp_matches(celex_id, '{CELEX}')
          THEN 'http://publications.europa.eu/resource/celex/' || celex_id END AS url FROM works_src WHERE k >= 0""",
       "works_src")
def urls(spark, sf):
    padded = F.concat(F.lit("  "), F.lower("celex_id"), F.lit("\t"))
    return I.main_works(spark, sf).select("k", resource_url(padded).alias("url"))


def matches(spark, sf, kind=None):
    labels = I.labels(spark, sf)
    if kind:
        labels = labels.filter(F.col("kind") == kind)
    return match_keywords(labels, I.KEYWORDS)
