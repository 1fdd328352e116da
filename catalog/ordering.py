"""Choice of the best row, ordered work inside a document, previews."""

from pyspark.sql import functions as F

from catalog import inputs as I
from catalog import query
from catalog.joins import SPANS, section_texts
from catalog.scans import LISTING, matches
from lexspark.operators import sequence as S
from lexspark.operators.choose import select_annex, select_manifestation
from lexspark.operators.graph import order_labels
from lexspark.operators.tokens import html_tokens, pair_elements
from lexspark.sources.landed import parse_listing


def _choice(out: str, bonus: str) -> str:
    return f"""
SELECT doc, url, stream_name, stream_order FROM (SELECT *, ({out}) AS out FROM ({LISTING}))
QUALIFY row_number() OVER (PARTITION BY doc ORDER BY out,
  CASE WHEN out THEN 0 ELSE stream_order - CASE WHEN {bonus} THEN 1000 ELSE 0 END END, pos) = 1"""


@query("q_select_manifestation", _choice(
    "stream_name ILIKE '%annex%' OR stream_name ILIKE '%cover%'", "stream_name ILIKE '%act%'"))
def main_choice(spark, sf):
    return select_manifestation(parse_listing(I.listings(spark, sf), "html", ["doc"]), "doc")


@query("q_select_annex", _choice(
    "stream_name ILIKE '%act%' OR stream_name ILIKE '%cover%'", "stream_name ILIKE '%annex%'"))
def annex_choice(spark, sf):
    return select_annex(parse_listing(I.listings(spark, sf), "html", ["doc"]), "doc")


@query("q_running_number", """
SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS number
FROM conversations WHERE role = 'user'""")
def running_number(spark, sf):
    return S.number_in_order(
        I.table(spark, sf, "conversations").filter("role = 'user'"), ["conv_id"], "turn"
    ).select("conv_id", "turn", "number")


@query("q_section_by_headings", """
SELECT conv_id, turn, sum(CASE WHEN role = 'user' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn
  ROWS UNBOUNDED PRECEDING) AS section FROM conversations""")
def sections(spark, sf):
    return S.section_by_headings(
        I.table(spark, sf, "conversations"), ["conv_id"], "turn", F.col("role") == "user"
    ).select("conv_id", "turn", "section")


TOKENS = r"""
SELECT page_id, unnest(range(len(t))) AS pos, unnest(t) AS raw FROM (SELECT page_id, regexp_extract_all(html,
 '(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!\[CDATA\[.*?\]\]>|<[a-z/!?][^>"'']*(?:(?:"[^"]*"|''[^'']*'')[^>"'']*)*>|[^<]+|<') AS t
 FROM pages)"""


@query("q_pair_elements", rf"""
WITH tok AS ({TOKENS}),
tag AS (SELECT page_id, pos, raw, raw NOT LIKE '</%' AS opens FROM tok WHERE regexp_matches(raw, '(?i)^</?div\b')),
dep AS (SELECT *, sum(CASE WHEN opens THEN 1 ELSE -1 END) OVER (PARTITION BY page_id ORDER BY pos) AS depth FROM tag),
lev AS (SELECT *, CASE WHEN opens THEN depth ELSE depth + 1 END AS level FROM dep)
SELECT page_id, regexp_extract(raw, 'class="([^"]*)"', 1) AS class, CAST(level AS int) AS level, pos AS open,
       (SELECT min(c.pos) FROM lev c WHERE c.page_id = o.page_id AND c.level = o.level AND NOT c.opens AND c.pos > o.pos) AS close
FROM lev o WHERE opens""")
def pairs(spark, sf):
    tokens = html_tokens(I.table(spark, sf, "pages"), ["page_id"], "html")
    return pair_elements(tokens, ["page_id"]).select("page_id", "class", "level", "open", "close")


@query("q_first_in_span", f"""
SELECT doc_id, id, text FROM ({SPANS}) WHERE id LIKE 'rct%' OR text LIKE 'Article%' OR text LIKE 'ANNEX%'""", "lines")
def first_in_span(spark, sf):
    return S.first_in_group(section_texts(spark, sf), ["doc_id", "id"], "pos", ["text"])


@query("q_next_sibling", """
SELECT class, next_class, count(*) AS n FROM (
  SELECT class, lead(class) OVER (PARTITION BY doc_id ORDER BY i, o) AS next_class FROM man_paragraphs) GROUP BY 1, 2""",
       "man_paragraphs")
def next_sibling(spark, sf):
    pages = I.pages_of_kind(spark, sf, 1)
    p = html_tokens(pages, ["doc_id"], "html", partitioned=True).filter("tag = 'p' AND kind = 'open'")
    return S.with_next(p, ["doc_id"], "pos", ["class"]).groupBy("class", "next_class").agg(
        F.count(F.lit(1)).alias("n")
    )


@query("q_order_labels", "SELECT keyword, label, uri, kind FROM matches_src ORDER BY 1, 2, 3", "matches_src")
def ordered(spark, sf):
    return order_labels(matches(spark, sf).select("keyword", "label", "uri", "kind"))


@query("q_preview_ids", """
SELECT celex_id, greatest((SELECT count(DISTINCT celex_id) FROM works_src) - 10, 0) AS n_more
FROM (SELECT DISTINCT celex_id FROM works_src) ORDER BY celex_id LIMIT 10""", "works_src")
def preview_ids(spark, sf):
    return S.preview_ids(I.works(spark, sf))


@query("q_preview_concepts", """
SELECT keyword, uri, label, rank, n_more FROM (
  SELECT *, row_number() OVER (PARTITION BY keyword ORDER BY label, uri) AS rank,
         greatest(count(*) OVER (PARTITION BY keyword) - 5, 0) AS n_more
  FROM (SELECT keyword, uri, min(label) AS label FROM matches_src GROUP BY keyword, uri)) WHERE rank <= 5""",
       "matches_src")
def preview_concepts(spark, sf):
    concepts = matches(spark, sf).groupBy("keyword", "uri").agg(F.min("label").alias("label"))
    return S.preview_concepts(concepts)
