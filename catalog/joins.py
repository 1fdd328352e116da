"""Joins over graph facts and tables."""

from pyspark.sql import functions as F

from catalog import inputs as I
from catalog import query
from catalog.ctes import CONSOLIDATED
from catalog.scans import matches
from lexspark import model as M
from lexspark.operators import graph as G
from lexspark.operators.tables import orphans
from lexspark.operators.tokens import html_tokens, pair_elements, tokens_in_spans

PATTERN = [(M.P_DATE, "date"), (M.P_TYPE, "type"), (M.P_CELEX, "celex_id"), (M.P_SECTOR, "sector")]


@query("q_graph_pattern", """
SELECT 'http://example.org/work/' || k AS s, CAST(d + to_days(CAST(x AS int)) AS date)::varchar AS date, ty AS type, celex_id, sector
FROM works_src, range(2) r(x) WHERE k >= 0 AND k % 19 <> 0 AND (x = 0 OR k % 13 = 0)""", "works_src")
def graph_pattern(spark, sf):
    return G.match_pattern(I.triples(spark, sf), PATTERN)


@query("q_relation_hop", """
SELECT DISTINCT 'http://example.org/work/' || sk AS s, relation_type, celex_target AS value
FROM relations_src WHERE celex_target <> ''""", "relations_src")
def relation_hop(spark, sf):
    return G.relation_hop(I.triples(spark, sf))


@query("q_tagged_union", """
SELECT DISTINCT 'http://example.org/work/' || sk AS s, relation_type AS data_type, celex_target AS value
FROM relations_src WHERE celex_target <> ''
UNION ALL
SELECT 'http://example.org/work/' || k, 'date', CAST(d + to_days(CAST(x AS int)) AS date)::varchar
FROM works_src, range(2) r(x) WHERE k >= 0 AND (x = 0 OR k % 13 = 0)
UNION ALL
SELECT 'http://example.org/work/' || k, 'title', 'Act ' || celex_id FROM works_src WHERE k >= 0 AND k % 4 <> 0""",
       "relations_src")
def tagged_union(spark, sf):
    return G.all_properties(I.triples(spark, sf))


@query("q_keyword_theta_join", "SELECT keyword, uri, kind, label FROM matches_src", "matches_src")
def keyword_join(spark, sf):
    return matches(spark, sf).select("keyword", "uri", "kind", "label")


@query("q_optional_join", """
SELECT DISTINCT d.proposal, coalesce(a.work, '') AS work FROM dossiers_src d LEFT JOIN adopts_src a USING (proposal)""",
       "dossiers_src adopts_src")
def optional_join(spark, sf):
    return G.with_acts(I.dossiers(spark, sf).select("proposal").distinct(), I.adopts(spark, sf))


@query("q_exists_semi", """
SELECT 'http://example.org/expression/' || k AS s, 'Act ' || celex_id AS title
FROM works_src WHERE k >= 0 AND k % 4 <> 0""", "works_src")
def exists_semi(spark, sf):
    t = I.triples(spark, sf)
    english = t.filter((F.col("p") == M.P_LANGUAGE) & F.endswith("o", F.lit("ENG")))
    titles = t.filter(F.col("p") == M.P_TITLE).select("s", F.col("o").alias("title"))
    return G.having_language(titles, english, "s")


@query("q_consolidated_lookup", f"""
SELECT c.celex_id, '3' || substr(c.celex_id, 2, 9) AS original_id, o.d AS original_date
FROM works_src c LEFT JOIN (SELECT * FROM works_src WHERE k >= 0) o ON o.celex_id = '3' || substr(c.celex_id, 2, 9)
WHERE c.sector = '0'""", "works_src")
def lookup(spark, sf):
    w = I.works(spark, sf)
    dates = w.filter("k >= 0").select("celex_id", F.col("d").alias("original_date"))
    return G.with_original(w.filter("sector = '0'").select("celex_id"), dates).select(
        "celex_id", "original_id", "original_date"
    )


@query("q_original_relations", f"""
SELECT celex_source, celex_target, relation_type FROM relations_src WHERE celex_target <> ''
UNION ALL
SELECT r.celex_source, r.celex_target, r.relation_type FROM works_src c JOIN relations_src r
  ON r.celex_source = '3' || substr(c.celex_id, 2, 9)
WHERE regexp_matches(c.celex_id, '{CONSOLIDATED}') AND r.celex_target <> ''""", "works_src relations_src")
def original_relations(spark, sf):
    rel = I.relations(spark, sf).filter("celex_target <> ''").select("celex_source", "celex_target", "relation_type")
    return G.relations_with_original(rel, I.works(spark, sf))


PROCEDURES = [f"{y}/{c:04d}/COD" for y in range(1995, 2002) for c in range(60)]


@query("q_resolve_procedures", """
SELECT DISTINCT CASE WHEN a.work IS NULL THEN d.proposal ELSE a.work END AS celex_id
FROM (SELECT proposal FROM dossiers_src JOIN
        (SELECT y || '/' || lpad(CAST(c AS varchar), 4, '0') || '/COD' AS p FROM range(1995, 2002) a(y), range(60) b(c))
        ON contains(ref, p) WHERE contains(proposal, 'PC') AND NOT contains(proposal, '(')) d
LEFT JOIN adopts_src a USING (proposal)""", "dossiers_src adopts_src")
def resolve_procedures(spark, sf):
    return G.resolve_procedures(I.dossiers(spark, sf), I.adopts(spark, sf), PROCEDURES)


@query("q_orphan_check", """
SELECT celex_source, celex_target, relation_type FROM relations_src
WHERE celex_source NOT IN (SELECT celex_id FROM works_src WHERE sector = '3')""", "relations_src")
def orphan_check(spark, sf):
    parents = I.works(spark, sf).filter("sector = '3'")
    return orphans(I.relations(spark, sf), parents, "celex_source").select(
        "celex_source", "celex_target", "relation_type"
    )


SPANS = r"""
SELECT doc_id, id, text FROM (
  SELECT doc_id, 'rct_' || i AS id, x AS text FROM lines WHERE i % 3 = 0
  UNION ALL SELECT doc_id, 'art_' || i, unnest(['Article ' || i, substr(x, 1, 20), x]) FROM lines WHERE i % 3 = 1
  UNION ALL SELECT doc_id, 'anx_' || i, unnest(['ANNEX ' || i, substr(x, 1, 20), x]) FROM lines WHERE i % 3 = 2)
WHERE regexp_matches(text, '[^\s\x{00A0}]')"""


def section_texts(spark, sf):
    tokens = html_tokens(I.pages_of_kind(spark, sf, 0), ["doc_id"], "html", partitioned=True)
    spans = pair_elements(tokens, ["doc_id"]).filter(F.col("id") != "")
    return tokens_in_spans(tokens, spans, ["doc_id"])


@query("q_tokens_in_spans", SPANS, "lines")
def in_spans(spark, sf):
    return section_texts(spark, sf).select("doc_id", "id", "text")
