"""Scalar functions."""

from pyspark.sql import functions as F

from catalog import inputs as I
from catalog import query
from catalog.ctes import CELEX, CONSOLIDATED, nrm
from lexspark.functions import ids as D
from lexspark.functions import text as X


@query("q_normalize_text", f"SELECT doc_id, {nrm('text')} AS text FROM documents")
def normalize_text(spark, sf):
    return I.table(spark, sf, "documents").select("doc_id", X.normalize_text(F.col("text")).alias("text"))


@query("q_normalize_celex", "SELECT k, celex_id FROM works_src", "works_src")
def normalize_celex(spark, sf):
    padded = F.concat(F.lit(" \n"), F.lower("celex_id"), F.lit("\t "))
    return I.works(spark, sf).select("k", D.normalize_celex(padded).alias("celex_id"))


@query("q_valid_celex", f"SELECT celex_id, regexp_matches(celex_id, '{CELEX}') AS valid FROM works_src", "works_src")
def valid_celex(spark, sf):
    return I.works(spark, sf).select("celex_id", D.is_valid_celex(F.col("celex_id")).alias("valid"))


@query("q_is_consolidated", f"""
SELECT celex_id, regexp_matches(celex_id, '{CONSOLIDATED}') AS consolidated FROM works_src""", "works_src")
def consolidated(spark, sf):
    return I.works(spark, sf).select("celex_id", D.is_consolidated(F.col("celex_id")).alias("consolidated"))


@query("q_original_celex", f"""
SELECT celex_id, CASE WHEN regexp_matches(celex_id, '{CONSOLIDATED}') THEN '3' || substr(celex_id, 2, 9)
       ELSE celex_id END AS original_id FROM works_src""", "works_src")
def original(spark, sf):
    return I.works(spark, sf).select("celex_id", D.original_celex(F.col("celex_id")).alias("original_id"))


@query("q_normalize_procedure", """
SELECT k, year(d) || '/' || lpad(CAST(ck % 10000 AS varchar), 4, '0') || '/COD' AS procedure FROM works_src""",
       "works_src")
def normalize_procedure(spark, sf):
    raw = F.concat(
        F.lit(" "), F.year("d").cast("string"), F.lit("/"), F.lpad((F.col("ck") % 10000).cast("string"), 4, "0"),
        F.lit("(cod) "),
    )
    return I.works(spark, sf).select("k", D.normalize_procedure(raw).alias("procedure"))


@query("q_valid_procedure", "SELECT k, k % 4 IN (1, 2) AS valid FROM works_src WHERE k >= 0", "works_src")
def valid_procedure(spark, sf):
    core = F.concat(F.year("d").cast("string"), F.lit("/"), F.lpad((F.col("ck") % 10000).cast("string"), 4, "0"))
    raw = (
        F.when(F.col("k") % 4 == 0, F.concat(F.lit(" "), core, F.lit("/COD")))
        .when(F.col("k") % 4 == 1, F.concat(core, F.lit("/cod")))
        .when(F.col("k") % 4 == 2, F.concat(core, F.lit("(COD)")))
        .otherwise(core)
    )
    return I.main_works(spark, sf).select("k", D.is_valid_procedure(raw).alias("valid"))


@query("q_document_type", """
SELECT celex_id, CASE WHEN ty = 'X' THEN 'Unknown' ELSE CASE WHEN sector = '0' THEN 'consolidated ' ELSE '' END
  || CASE ty WHEN 'R' THEN 'regulation' WHEN 'L' THEN 'directive' WHEN 'D' THEN 'decision' ELSE 'proposal' END END
  AS document_type FROM works_src""", "works_src")
def document_type(spark, sf):
    return I.works(spark, sf).select("celex_id", D.document_type(F.col("celex_id")).alias("document_type"))


XSD = "http://www.w3.org/2001/XMLSchema#"


@query("q_decode_literal", """
SELECT k,
  CASE k % 9 WHEN 0 THEN 'boolean' WHEN 1 THEN 'integer' WHEN 2 THEN 'double' WHEN 3 THEN 'date' WHEN 4 THEN 'timestamp'
    WHEN 5 THEN 'year' WHEN 6 THEN 'bad' ELSE 'string' END AS v_kind,
  CASE WHEN k % 9 = 0 THEN k % 2 = 0 END AS v_bool,
  CASE k % 9 WHEN 1 THEN k WHEN 5 THEN year(d) END AS v_long,
  CASE WHEN k % 9 = 2 THEN k + 0.5::double END AS v_double,
  CASE WHEN k % 9 = 3 THEN d END AS v_date,
  CASE WHEN k % 9 = 4 THEN CAST(epoch(CAST(d AS timestamp)) AS bigint) - 3600 END AS v_unix,
  CASE k % 9 WHEN 7 THEN CAST(d AS varchar) || 'Tx' WHEN 8 THEN 'http://example.org/' || k END AS v_text
FROM works_src WHERE k >= 0""", "works_src")
def decode_literal(spark, sf):
    k, d = F.col("k"), F.col("d").cast("string")
    case = k % 9
    value = (
        F.when(case == 0, F.when(k % 2 == 0, "True").otherwise("0"))
        .when(case == 1, k.cast("string"))
        .when(case == 2, F.concat(k.cast("string"), F.lit(".5")))
        .when(case == 3, d)
        .when(case == 4, F.concat(d, F.lit("T00:00:00+01:00")))
        .when(case == 5, F.year("d").cast("string"))
        .when(case == 6, "12.5")
        .when(case == 7, F.concat(d, F.lit("Tx")))
        .otherwise(F.concat(F.lit("http://example.org/"), k.cast("string")))
    )
    types = ["boolean", "positiveInteger", "double", "date", "dateTime", "gYear", "integer", "dateTime"]
    datatype = F.get(F.array(*[F.lit(XSD + t) for t in types]), case)
    kind = F.when(case == 8, "uri").otherwise("literal")
    v = X.decode_literal(F.col("value"), F.col("kind"), F.col("datatype"))
    rows = I.main_works(spark, sf).select("k", value.alias("value"), kind.alias("kind"), datatype.alias("datatype"))
    return rows.select("k", v.alias("v")).select(
        "k", "v.v_kind", "v.v_bool", "v.v_long", "v.v_double", "v.v_date",
        F.unix_seconds("v.v_time").alias("v_unix"), "v.v_text",
    )


@query("q_date_from_title", """
SELECT celex_id, CASE WHEN k % 9 = 0 THEN NULL ELSE d END AS title_date FROM titles_src""", "titles_src")
def date_from_title(spark, sf):
    return I.titles(spark, sf).select("celex_id", X.date_from_title(F.col("title")).alias("title_date"))


@query("q_contains_ci", "SELECT uri, kind, contains(lower(label), 'econ') AS hit FROM labels_src", "labels_src")
def contains_ci(spark, sf):
    return I.labels(spark, sf).select("uri", "kind", X.contains_ci(F.col("label"), F.lit("ECON")).alias("hit"))


@query("q_recital_number", """
SELECT o_orderkey AS k, CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE CAST(o_orderkey AS varchar) END AS number FROM orders""")
def recital_number(spark, sf):
    k = F.col("o_orderkey")
    label = F.when(k % 3 == 0, F.concat(F.lit("no ("), F.col("o_orderpriority"), F.lit(")"))).otherwise(
        F.concat(F.lit("(x) ("), k.cast("string"), F.lit(") (7)"))
    )
    return I.table(spark, sf, "orders").select(k.alias("k"), X.recital_number(label).alias("number"))


@query("q_article_number", """
SELECT o_orderkey AS k, CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE CAST(o_orderkey AS varchar) || (o_orderkey % 10) END AS number
FROM orders""")
def article_number(spark, sf):
    k = F.col("o_orderkey")
    label = F.concat(
        F.when(k % 5 == 0, "Section ").otherwise("see ARTICLE  "), k.cast("string"), F.lit(" "),
        (k % 10).cast("string"),
    )
    return I.table(spark, sf, "orders").select(k.alias("k"), X.article_number(label).alias("number"))


ROMAN = "CASE p_size % 5 WHEN 0 THEN 'I' WHEN 1 THEN 'iv' WHEN 2 THEN 'XII' WHEN 3 THEN 'C' ELSE 'IX' END"


def _roman():
    return F.get(F.array(*[F.lit(r) for r in ("I", "iv", "XII", "C", "IX")]), F.col("p_size") % 5)


@query("q_annex_heading", f"""
SELECT p_partkey, CASE WHEN p_size % 7 = 0 THEN '' ELSE {ROMAN} END AS number,
       CASE WHEN p_size % 7 = 0 THEN '' ELSE p_name END AS title FROM part""")
def annex_heading(spark, sf):
    line = F.concat(
        F.when(F.col("p_size") % 7 == 0, "Schedule ").otherwise("The Annex "), _roman(), F.lit(" "), F.col("p_name")
    )
    return I.table(spark, sf, "part").select("p_partkey", X.annex_heading(line).alias("h")).select("p_partkey", "h.*")


@query("q_annex_heading_plain", r"""
SELECT p_partkey, regexp_extract(line, '(?i)^ANNEX\s*([IVXLCDM0-9]*)(.*)', 1) AS number,
       trim(regexp_extract(line, '(?i)^ANNEX\s*([IVXLCDM0-9]*)(.*)', 2)) AS title
FROM (SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN 'Annex ' || p_name WHEN 1 THEN 'ANNEX' || p_size || ' ' || p_name
             WHEN 2 THEN 'ANNEX IV' ELSE 'The ANNEX' END AS line FROM part)""")
def annex_heading_plain(spark, sf):
    size = F.col("p_size")
    line = (
        F.when(size % 4 == 0, F.concat(F.lit("Annex "), F.col("p_name")))
        .when(size % 4 == 1, F.concat(F.lit("ANNEX"), size.cast("string"), F.lit(" "), F.col("p_name")))
        .when(size % 4 == 2, "ANNEX IV").otherwise("The ANNEX")
    )
    return I.table(spark, sf, "part").select(
        "p_partkey", X.annex_heading_plain(line).alias("h")
    ).select("p_partkey", "h.*")


@query("q_section_key", """
SELECT p_partkey, CASE p_partkey % 6 WHEN 0 THEN 'recital' WHEN 1 THEN 'article' WHEN 2 THEN 'annex' WHEN 3 THEN 'recital' END AS kind,
  CASE p_partkey % 6 WHEN 0 THEN CAST(p_size AS varchar) WHEN 1 THEN p_size || 'a' WHEN 2 THEN 'iX' WHEN 3 THEN p_size || '.x' END AS number
FROM part""")
def section_key(spark, sf):
    n = F.col("p_size").cast("string")
    case = F.col("p_partkey") % 6
    name = (
        F.when(case == 0, F.concat(F.lit("rct_"), n)).when(case == 1, F.concat(F.lit("art_"), n, F.lit("a")))
        .when(case == 2, "anx_iX").when(case == 3, F.concat(F.lit("rct_"), n, F.lit(".x")))
        .when(case == 4, F.concat(F.lit("art_"), n, F.lit("_para_2"))).otherwise("anx_q")
    )
    return I.table(spark, sf, "part").select("p_partkey", X.section_key(name).alias("s")).select(
        "p_partkey", "s.kind", "s.number"
    )


@query("q_unescape", "SELECT doc_id, text FROM documents")
def unescape(spark, sf):
    t = F.col("text")
    for plain, coded in (("&", "&amp;"), ("é", "&eacute;"), ("è", "&#232;"), ("x", "&#x78;"), ('"', "&quot;")):
        t = F.replace(t, F.lit(plain), F.lit(coded))
    return I.table(spark, sf, "documents").select("doc_id", t.alias("t")).select(
        "doc_id", X.unescape(F.col("t")).alias("text")
    )


@query("q_first_nonempty", """
SELECT g.celex_id, coalesce(g.title, n.notice_title) AS title
FROM graph_src g JOIN notices_src n USING (celex_id)""", "graph_src notices_src")
def first_nonempty(spark, sf):
    g = I.graph_facts(spark, sf).select("celex_id", "k", F.coalesce("title", F.lit("")).alias("title"))
    notice = F.when(F.col("k") % 5 == 0, "").otherwise(F.concat(F.lit("Notice ,of "), "celex_id", F.lit(" ")))
    return g.select("celex_id", X.first_nonempty(F.col("title"), notice).alias("title"))


@query("q_decode_body", "SELECT doc_id, CASE WHEN doc_id % 5 <> 0 THEN text END AS text FROM documents")
def decode_body(spark, sf):
    raw = F.when(
        F.col("doc_id") % 5 == 0, F.concat(F.encode("text", "UTF-8"), F.unhex(F.lit("FF")))
    ).otherwise(F.encode("text", "UTF-8"))
    return I.table(spark, sf, "documents").select("doc_id", X.decode_body(raw).alias("text"))
