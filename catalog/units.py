"""Markup, page structure and text units."""

from pyspark.sql import functions as F

from catalog import inputs as I
from catalog import query
from catalog.ctes import nrm
from catalog.ordering import TOKENS
from lexspark.functions.ids import is_valid_celex
from lexspark.functions.markup import flatten_wrappers, structure_of
from lexspark.operators.choose import choose_body
from lexspark.operators.tokens import extract_text, html_tokens
from lexspark.operators.units import extract_manual, extract_plain, extract_standard, wants
from lexspark.plans.dataset import build_text_units, unit_sources

NAMES = "CASE {} WHEN 0 THEN 'standard' WHEN 1 THEN 'manual' ELSE 'plain' END"
ENTITIES = ("copy", "©"), ("middot", "·"), ("nbsp", " "), ("lt", "<"), ("gt", ">"), ("quot", '"'), ("amp", "&")


def _decoded(x: str) -> str:
    for name, char in ENTITIES:
        x = f"replace({x}, '&{name};', '{char}')"
    return x


@query("q_html_tokens", rf"""
SELECT page_id, pos,
  CASE WHEN left(raw, 1) <> '<' THEN 'text' WHEN left(raw, 2) = '</' THEN 'close'
       WHEN raw LIKE '%/>' OR regexp_matches(raw, '(?i)^<(br|meta|img|hr|input|link|col)\b') THEN 'void' ELSE 'open' END AS kind,
  lower(regexp_extract(raw, '^</?([A-Za-z][A-Za-z0-9]*)', 1)) AS tag,
  CASE WHEN left(raw, 2) <> '</' AND left(raw, 1) = '<' THEN regexp_extract(raw, '\sid="([^"]*)"', 1) ELSE '' END AS id,
  CASE WHEN left(raw, 2) <> '</' AND left(raw, 1) = '<' THEN regexp_extract(raw, '\sclass="([^"]*)"', 1) ELSE '' END AS class,
  CASE WHEN left(raw, 1) <> '<' THEN {_decoded('raw')} ELSE '' END AS text
FROM ({TOKENS}) WHERE NOT regexp_matches(raw, '(?i)^<(!|\?|script\b|style\b)')
  AND (left(raw, 1) = '<' OR regexp_matches({_decoded('raw')}, '[^\s\x{{00A0}}]'))""")
def tokens(spark, sf):
    return html_tokens(I.table(spark, sf, "pages"), ["page_id"], "html")


@query("q_flatten_wrappers", f"""
SELECT doc_id, count(*) FILTER (i % 12 = 0) AS n_before, 0 AS n_after,
  {nrm("'Page ' || doc_id || ' title ' || string_agg(t, ' ' ORDER BY i)")} AS text
FROM (SELECT doc_id, i, CASE i % 3 WHEN 0 THEN x WHEN 1 THEN 'Article ' || i || ' ' || substr(x, 1, 20) || ' ' || x
             ELSE 'ANNEX ' || i || ' ' || substr(x, 1, 20) || ' ' || x END AS t FROM lines) GROUP BY doc_id""", "lines")
def flatten(spark, sf):
    pages = I.pages_of_kind(spark, sf, 0)
    count = lambda c: F.regexp_count(c, F.lit('class="content"'))
    flat = pages.select(
        "doc_id", count(F.col("html")).alias("n_before"), flatten_wrappers(F.col("html")).alias("html")
    ).withColumn("n_after", count(F.col("html")))
    keys = ["doc_id", "n_before", "n_after"]
    t = html_tokens(flat, ["doc_id"], "html", carry=keys[1:], partitioned=True)
    return t.groupBy(*keys).agg(extract_text().alias("text"))


@query("q_classify_structure", f"SELECT doc_id, {NAMES.format('doc_id % 3')} AS structure FROM documents")
def classify(spark, sf):
    return I.legal_pages(spark, sf).select("doc_id", structure_of(F.col("html")).alias("structure"))


def _register(kind: int, name: str, cte: str, extract) -> None:
    for unit, plural in (("recital", "recitals"), ("article", "articles"), ("annex", "annexes")):
        sql = f"SELECT doc_id, number, title, text FROM {cte} WHERE type = '{unit}'"

        def fn(spark, sf, unit=unit):
            units = extract(I.pages_of_kind(spark, sf, kind), ["doc_id"], "html", [unit], partitioned=True)
            return units.select("doc_id", "number", "title", "text")

        query(f"q_{name}_{plural}", sql, cte)(fn)


_register(0, "standard", "std_units", extract_standard)
_register(1, "manual", "man_units", extract_manual)
_register(2, "plain", "plain_units", extract_plain)


def valid_manifestations(spark, sf):
    return I.manifestations(spark, sf).filter(is_valid_celex(F.col("celex_id")))


@query("q_choose_body", f"""
SELECT celex_id, role, fmt, {NAMES.format('kind')} AS structure FROM own_choice""", "own_choice")
def choose(spark, sf):
    return choose_body(valid_manifestations(spark, sf))


def _source(unit: str) -> str:
    return f"""
SELECT celex_id, CASE source WHEN 'original' THEN '3' || substr(celex_id, 2, 9) ELSE celex_id END AS src_id,
       CASE source WHEN 'annex' THEN 'annex' ELSE 'main' END AS role, {NAMES.format('src_kind')} AS structure
FROM routes WHERE type = '{unit}'"""


def _sources(spark, sf, unit):
    ids = I.works(spark, sf).select("celex_id")
    return unit_sources(ids, I.manifestations(spark, sf)).filter(wants(F.col("want"), unit)).select(
        "celex_id", "src_id", "role", "structure"
    )


@query("q_recital_source", _source("recital"), "routes")
def recital_source(spark, sf):
    return _sources(spark, sf, "recital")


@query("q_annex_source", _source("annex"), "routes")
def annex_source(spark, sf):
    return _sources(spark, sf, "annex")


@query("q_build_text_units", "SELECT celex_id, type, number, title, text FROM built_units", "built_units")
def text_units(spark, sf):
    ids = I.works(spark, sf).select("celex_id")
    return build_text_units(ids, I.manifestations(spark, sf)).select("celex_id", "type", "number", "title", "text")
