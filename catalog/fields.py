"""Field resolution, works and relations."""

from pyspark.sql import functions as F

from catalog import inputs as I
from catalog import query
from catalog.ctes import CELEX, CONSOLIDATED, nrm
from catalog.units import NAMES, valid_manifestations
from lexspark.functions.markup import structure_of
from lexspark.operators import resolve as R
from lexspark.operators.graph import relation_map
from lexspark.operators.tables import outcome_counts
from lexspark.plans.dataset import Inputs, checked_dataset
from lexspark.sources.landed import notice_fields
from lexspark.spec import JobSpec, ListSpec

TITLES = f"""
SELECT w.celex_id, coalesce({nrm('g.title')}, {nrm('n.notice_title')}, b.title, '[Unavailable]') AS title,
       CASE WHEN g.title IS NOT NULL THEN 'graph' WHEN n.notice_title IS NOT NULL THEN 'notice'
            WHEN b.title IS NOT NULL THEN 'html' ELSE 'none' END AS title_source, w.k
FROM works_src w LEFT JOIN graph_src g USING (celex_id) LEFT JOIN notices_src n USING (celex_id)
LEFT JOIN (SELECT celex_id, 'Page ' || doc_id || ' title' AS title FROM body_facts
           WHERE role = 'main' AND fmt = 'xhtml' AND ok AND regexp_matches(celex_id, '{CELEX}')) b USING (celex_id)"""
TITLE_CTES = "works_src graph_src notices_src body_facts"


def _inputs(spark, sf):
    notices = notice_fields(I.notices(spark, sf), "xml").select("celex_id", "notice_title", "notice_date")
    return I.works(spark, sf).select("celex_id"), I.graph_facts(spark, sf).drop("k"), notices


@query("q_resolve_title", f"SELECT celex_id, title, title_source FROM ({TITLES})", TITLE_CTES)
def title(spark, sf):
    ids, graph, notices = _inputs(spark, sf)
    return R.resolve_title(ids, graph, notices, valid_manifestations(spark, sf))


DATES = f"""
SELECT w.celex_id, coalesce(g.date, n.notice_date, t.d) AS date_adopted,
       CASE WHEN g.date IS NOT NULL THEN 'graph' WHEN n.notice_date IS NOT NULL THEN 'notice'
            WHEN t.d IS NOT NULL THEN 'title' ELSE 'none' END AS date_source
FROM (SELECT celex_id, k, CASE WHEN regexp_matches(celex_id, '{CONSOLIDATED}') THEN '3' || substr(celex_id, 2, 9)
             ELSE celex_id END AS oid FROM works_src) w
LEFT JOIN graph_src g ON g.celex_id = w.oid LEFT JOIN notices_src n ON n.celex_id = w.oid
LEFT JOIN (SELECT celex_id, d FROM titles_src WHERE k % 9 <> 0) t ON t.celex_id = w.celex_id"""
DATE_CTES = "works_src graph_src notices_src titles_src"


@query("q_resolve_date", DATES, DATE_CTES)
def dates(spark, sf):
    ids, graph, notices = _inputs(spark, sf)
    titles = ids.join(I.titles(spark, sf).select("celex_id", "title"), "celex_id", "left").withColumn(
        "title", F.coalesce("title", F.lit(R.UNAVAILABLE))
    )
    return R.resolve_date(titles, graph, notices)


@query("q_resolve_html", f"""
SELECT celex_id, {NAMES.format('kind')} AS structure, NOT ok AS is_broken, md5(flat || tail) AS html_md5
FROM body_facts JOIN page_html USING (doc_id, kind) WHERE role = 'main'
QUALIFY row_number() OVER (PARTITION BY celex_id ORDER BY CASE fmt WHEN 'xhtml' THEN 0 ELSE 1 END) = 1""", "body_facts page_html")
def html(spark, sf):
    page = F.col("full_text_html")
    return R.resolve_html(I.manifestations(spark, sf)).select(
        "celex_id", structure_of(page).alias("structure"), page.endswith("</html><br><p>").alias("is_broken"), F.md5(page).alias("html_md5")
    )


@query("q_build_relations", """
SELECT celex_source, celex_target, relation_type FROM relations_src WHERE celex_target <> ''""", "relations_src")
def relations(spark, sf):
    bag = relation_map(I.relations(spark, sf)).withColumnRenamed("celex_source", "celex_id")
    return R.build_relations(bag).select("celex_source", "celex_target", "relation_type")


def built_works(spark, sf):
    ids, graph, notices = _inputs(spark, sf)
    titles = R.resolve_title(ids, graph, notices, valid_manifestations(spark, sf))
    return R.build_works(ids, titles, R.resolve_date(titles, graph, notices))


WORKS = f"""
SELECT t.celex_id, CASE WHEN w.ty = 'X' THEN 'Unknown' ELSE CASE WHEN w.sector = '0' THEN 'consolidated ' ELSE '' END
  || CASE w.ty WHEN 'R' THEN 'regulation' WHEN 'L' THEN 'directive' WHEN 'D' THEN 'decision' ELSE 'proposal' END END
  AS document_type, t.title, coalesce(g.date, n.notice_date) AS date_adopted, 'eng' AS language
FROM ({TITLES}) t
JOIN (SELECT *, CASE WHEN regexp_matches(celex_id, '{CONSOLIDATED}') THEN '3' || substr(celex_id, 2, 9)
                ELSE celex_id END AS oid FROM works_src) w ON w.celex_id = t.celex_id
LEFT JOIN graph_src g ON g.celex_id = w.oid LEFT JOIN notices_src n ON n.celex_id = w.oid"""


@query("q_build_works", WORKS, TITLE_CTES)
def works(spark, sf):
    return built_works(spark, sf).drop("full_text_html")


@query("q_quarantine", f"""
SELECT celex_id, 'no date' AS reason FROM ({WORKS}) WHERE date_adopted IS NULL""", TITLE_CTES)
def quarantine(spark, sf):
    return R.with_quarantine(built_works(spark, sf))[1].select("celex_id", "reason")


@query("q_build_outcomes", f"""
SELECT status, reason, count(*) AS n, sum(n_relations)::BIGINT AS n_relations FROM (
  SELECT w.celex_id, CASE WHEN date_adopted IS NULL THEN 'failed' ELSE 'successful' END AS status,
         CASE WHEN date_adopted IS NULL THEN 'no date' END AS reason,
         CASE WHEN date_adopted IS NULL THEN 0 ELSE coalesce(r.n, 0) END AS n_relations
  FROM ({WORKS}) w LEFT JOIN (SELECT celex_source, count(*) AS n FROM relations_src WHERE celex_target <> '' GROUP BY 1) r
    ON r.celex_source = w.celex_id) GROUP BY ALL""", TITLE_CTES + " relations_src")
def build_outcomes(spark, sf):
    """The ledger of a whole build, and what it let into the relations."""
    ids, graph, notices = _inputs(spark, sf)
    inputs = Inputs(manifestations=I.manifestations(spark, sf), properties=graph, notices=notices, relations=I.relations(spark, sf))
    tables = checked_dataset(inputs, JobSpec(data=ListSpec(celex_ids=frozenset({"32016R0679"}))), ids)
    kept = tables["relations"].groupBy(F.col("celex_source").alias("celex_id")).agg(F.count(F.lit(1)).alias("m"))
    return tables["outcomes"].join(kept, "celex_id", "left").groupBy("status", "reason").agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("m"), F.lit(0)).alias("n_relations")
    )
