"""Recitals, articles and annexes of three page structures, in one pass.

token -> element -> section -> unit. A page is cut once, whatever unit types
are asked for, and all steps after the cut keep the document partitioning.

* standard pages: every section div is a unit of its own;
* manual pages: sibling elements; heading paragraphs open a section;
* plain pages: paragraphs of one div; heading lines open a section, with one
  reading for articles and another for annexes.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexspark.functions import markup as M
from lexspark.functions.text import (
    PLAIN_ANNEX, PLAIN_ARTICLE, annex_heading, annex_heading_plain, article_number,
    let, normalize_text, recital_number, section_key, strip,
)
from lexspark.model import UNIT_TYPES
from lexspark.operators.scale import by_key
from lexspark.operators.sequence import running
from lexspark.operators.tokens import first_mark, frames, html_tokens, in_mark, with_levels

# Element classes of the three page structures.
TITLE_CLASS = "eli-title"
ARTICLE_SKIP = ("eli-title", "oj-ti-art")
ANNEX_TITLE = "oj-doc-ti"
RECITAL_CLASS = "li ManualConsidrant"
ARTICLE_CLASS = "Titrearticle"
ANNEX_CLASS = "Annexetitre"
STOP_CLASSES = ("Titrearticle", "Annexetitre", "Fait", "Fichefinanciretitre")
CENTERED = "NormalCentered"
PLAIN_BODY = "TexteOnly"
RECITAL_WORD = "Whereas"

ALL_TYPES = 7  # one bit per unit type: recital 1, article 2, annex 4


def type_bits(types: Sequence[str]) -> int:
    return sum(1 << i for i, t in enumerate(UNIT_TYPES) if t in types)


def wants(bits: Column, kind: str) -> Column:
    return bits.bitwiseAND(F.lit(1 << UNIT_TYPES.index(kind))) != 0


def element_table(
    docs: DataFrame, keys: Sequence[str], html: str, partitioned: bool = False, alone: Column | None = None
) -> DataFrame:
    """One row per element at the section level of each page. ``docs`` has
    ``structure`` and ``want`` (type bits) columns next to the keys; ``alone`` as in ``html_tokens``."""
    carry = ["structure", "want"]
    known = docs.filter(F.col("structure").isNotNull() & (F.col("want") != 0))
    tokens = with_levels(
        html_tokens(known, keys, html, carry, partitioned, comments=True, loose=True, alone=alone), keys
    )
    standard, manual, plain = (F.col("structure") == s for s in M.STRUCTURES)
    want = F.col("want")
    wanted = lambda id_: F.coalesce(*[F.when(section_key(id_)["kind"] == k, wants(want, k)) for k in UNIT_TYPES])
    section = F.coalesce(
        (standard & (F.col("tag") == "div") & wanted(F.col("id")))
        | (manual & (F.col("tag") == "p") & F.col("class").isin(*M.MANUAL_CLASSES))
        | (plain & (F.col("tag") == "p")),
        F.lit(False),
    )
    mark = (
        F.when(standard, (F.col("tag") == "div") & (F.col("class") == TITLE_CLASS))
        .when(F.col("el_class") == RECITAL_CLASS, (F.col("tag") == "span") & (F.col("class") == "num"))
        .otherwise(F.col("tag") == "span")
    )
    body = plain & (F.col("tag") == "div") & (F.col("id") == PLAIN_BODY)
    t = frames(tokens, keys, section, inner_tags=("div", "span", "br"), mark=mark, body=body, bound=plain)
    el_kind = section_key(F.col("el_id"))["kind"]
    # what no wanted unit is made of is left out before it is sorted and put together
    is_section = (
        F.when(standard, (F.col("el_tag") == "div") & wanted(F.col("el_id")))
        .when(plain, (F.col("el_tag") == "p") & F.col("in_body"))
        .otherwise(wants(want, "article") | wants(want, "annex") | (F.col("el_class") == RECITAL_CLASS))
    )
    t = t.filter(is_section)

    # text by child first, then by element
    el_cols = [*keys, *carry, "frame", "el"]
    told = ["parent", "el_tag", "el_id", "el_class"]  # the same in all rows of an element
    part = F.when(standard & (el_kind == "recital"), F.col("el")).otherwise(F.col("child"))
    t = t.withColumn("part", part)
    run = F.when((F.col("kind") == "text") | ((F.col("kind") == "leaf") & (F.col("text") != "")), F.struct("pos", "text"))
    heading = F.col("el_class").isin(ARTICLE_CLASS, CENTERED)
    first_hit, ends = first_mark()
    parts = t.groupBy(*el_cols, "part").agg(
        *[F.first(c).alias(c) for c in told],
        F.max(F.when(F.col("pos") == F.col("part"), F.col("class"))).alias("part_class"),
        F.sort_array(F.collect_list(run)).alias("runs"),
        first_hit.alias("hit"),
        ends.alias("ends"),
        F.min(F.when((F.col("tag") == "br") & (F.col("level") > F.col("frame")), F.col("pos"))).alias("br"),
    ).withColumn(
        "part_text",
        F.when(standard | heading, normalize_text(_joined(F.col("runs"), " "))),
    )
    skip = (
        F.when(el_kind == "article", F.col("part_class").isin(*ARTICLE_SKIP))
        .when(el_kind == "annex", F.col("part_class") == ANNEX_TITLE)
        .otherwise(False)
    )
    doc_title = (
        (el_kind == "annex") & (F.col("part_class") == ANNEX_TITLE)
        & ~F.col("part_text").rlike(r"(?iU)^ANNEX\s*[IVXLCDM]*")
    )
    has_part = F.col("part").isNotNull()
    return parts.groupBy(*el_cols).agg(
        *[F.first(c).alias(c) for c in told],
        F.sort_array(F.flatten(F.collect_list("runs"))).alias("runs"),
        F.min("hit").alias("hit"),
        F.flatten(F.collect_list("ends")).alias("ends"),
        F.min("br").alias("br"),
        F.max_by(F.when(doc_title, F.col("part_text")), F.when(doc_title, F.col("part"))).alias("doc_title"),
        F.sort_array(F.collect_list(
            F.when(has_part & ~skip, F.struct(F.col("part").alias("pos"), F.col("part_text").alias("text")))
        )).alias("parts"),
    ).select(
        *el_cols,
        *told,
        F.when(~standard, normalize_text(_joined(F.col("runs"), " "))).alias("text"),
        normalize_text(_joined(in_mark(F.col("runs"), F.col("hit"), F.col("ends")), " ")).alias("mark_text"),
        F.col("br").isNotNull().alias("has_br"),
        _joined(F.filter("runs", lambda r: r["pos"] < F.col("br")), " ").alias("before_br"),
        _joined(F.filter("runs", lambda r: r["pos"] > F.col("br")), " ").alias("after_br"),
        F.coalesce("doc_title", F.lit("")).alias("doc_title"),
        strip(_joined(F.col("parts"), " ")).alias("parts_text"),
    )


def _joined(runs: Column, sep: str) -> Column:
    return F.array_join(F.transform(runs, lambda r: r["text"]), sep)


def units_from_elements(elements: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows (keys, pos, structure, type, number, title, text)."""
    standard, manual, plain = (F.col("structure") == s for s in M.STRUCTURES)
    want = F.col("want")
    text = F.col("text")
    # which readings of the page an element takes part in
    none = F.array().cast("array<string>")
    one = lambda test, name: F.when(F.coalesce(test, F.lit(False)), F.array(F.lit(name))).otherwise(none)
    readings = F.concat(
        one(standard, "unit"),
        one(manual & (F.col("el_tag") == "p") & (F.col("el_class") == RECITAL_CLASS) & wants(want, "recital"),
            "recital"),
        one(manual & (wants(want, "article") | wants(want, "annex")), "heading"),
        one(plain & F.startswith(text, F.lit(RECITAL_WORD)) & wants(want, "recital"), "recital"),
        one(plain & wants(want, "article"), "article"),
        one(plain & wants(want, "annex"), "annex"),
    )
    rows = elements.withColumn("reading", F.explode(readings))
    reading = F.col("reading")
    is_annex = text.rlike(PLAIN_ANNEX)
    boundary = (
        F.when(reading.isin("unit", "recital"), True)
        .when(reading == "heading", F.col("el_class").isin(*STOP_CLASSES))
        .when(reading == "article", text.rlike(PLAIN_ARTICLE) | is_annex)
        .otherwise(is_annex)
    )
    # siblings share a parent on manual pages; plain pages are read line by line
    rows = rows.withColumns({
        "_g1": F.when(manual, F.col("frame")).otherwise(0),
        "_g2": F.when(manual, F.col("parent")).otherwise(0),
        "_opens": boundary,
    })
    group = [*keys, "structure", "want", "reading", "_g1", "_g2"]
    rows = rows.withColumn(
        "section", F.sum(F.when(F.col("_opens"), 1).otherwise(0)).over(running(group, "el"))
    ).filter(F.col("section") > 0)

    head = F.struct(
        "el_tag", "el_class", "el_id", "text", "mark_text", "has_br", "before_br", "after_br",
        "doc_title", "parts_text",
    )
    member = F.struct(
        F.col("el"), F.col("el_class").alias("cls"), F.col("text"),
        F.col("parts_text").alias("children"),
    )
    sections = rows.groupBy(*group, "section").agg(
        F.min("el").alias("pos"),
        F.min_by(head, F.col("el")).alias("head"),
        F.sort_array(F.collect_list(F.when(~F.col("_opens"), member))).alias("body"),
    )
    w = Window.partitionBy(*group).orderBy("section")
    sections = sections.withColumns({
        "next_head": F.lead(F.struct("head.el_class", "head.parts_text")).over(w),
        "next_body": F.lead(F.when(reading == "heading", F.col("body"))).over(w),
    })
    h, body = F.col("head"), F.col("body")
    texts = lambda arr, sep: F.array_join(F.transform(arr, lambda m: m["text"]), sep)
    alone = F.size(body) == 0
    no_next = alone & F.col("next_head").isNull()

    # manual article: title after the break, or in the next heading paragraph
    title_0 = F.when(h["has_br"], strip(h["after_br"])).otherwise("")
    takes_next = (title_0 == "") & alone & F.coalesce(
        F.col("next_head")["el_class"] == ARTICLE_CLASS, F.lit(False)
    )
    art_number = F.when(h["has_br"], article_number(h["before_br"])).otherwise(article_number(h["mark_text"]))
    art_title = normalize_text(F.when(takes_next, F.col("next_head")["parts_text"]).otherwise(title_0))
    art_body = F.when(takes_next, F.coalesce("next_body", body)).otherwise(body)
    art_text = normalize_text(strip(texts(art_body, "")))
    # manual annex: title on the line, or in the next centred paragraph
    anx = annex_heading(h["text"])
    takes_first = (anx["title"] == "") & ~alone & (F.get(body, F.lit(0))["cls"] == CENTERED)
    anx_title = F.when(takes_first, F.get(body, F.lit(0))["children"]).otherwise(anx["title"])
    anx_rest = F.when(takes_first, F.slice(body, F.lit(2), F.greatest(F.size(body), F.lit(1)))).otherwise(body)
    anx_text = strip(texts(anx_rest, " "))

    is_p = h["el_tag"] == "p"
    kind = (
        F.when(reading == "unit", section_key(h["el_id"])["kind"])
        .when(reading == "recital", "recital")
        .when((reading == "heading") & is_p & (h["el_class"] == ARTICLE_CLASS), "article")
        .when((reading == "heading") & is_p & (h["el_class"] == ANNEX_CLASS), "annex")
        .when((reading == "article") & h["text"].rlike(PLAIN_ARTICLE), "article")
        .when(reading == "annex", "annex")
    )
    out = sections.withColumn("type", kind).filter(F.col("type").isNotNull())
    out = out.filter(
        F.when(F.col("type") == "recital", wants(want, "recital"))
        .when(F.col("type") == "article", wants(want, "article"))
        .otherwise(wants(want, "annex"))
    )
    kind = F.col("type")
    by_heading = reading == "heading"
    plain_anx = annex_heading_plain(h["text"])
    number = (
        F.when(reading == "unit", section_key(h["el_id"])["number"])
        .when((reading == "recital") & manual, recital_number(h["mark_text"]))
        .when(reading == "recital", F.col("section").cast("string"))
        .when(by_heading & (kind == "article"), art_number)
        .when(by_heading, anx["number"])
        .when(kind == "article", F.regexp_extract(h["text"], PLAIN_ARTICLE, 1))
        .otherwise(plain_anx["number"])
    )
    title = (
        F.when(kind == "recital", F.lit(None).cast("string"))
        .when((reading == "unit") & (kind == "article"), h["mark_text"])
        .when(reading == "unit", h["doc_title"])
        .when(by_heading & (kind == "article"), art_title)
        .when(by_heading, anx_title)
        .when(kind == "article", F.lit(""))
        .otherwise(normalize_text(plain_anx["title"]))
    )
    unit_text = (
        F.when(reading == "unit", h["parts_text"])
        .when(reading == "recital", normalize_text(h["text"]))
        .when(by_heading & (kind == "article"), art_text)
        .when(by_heading, anx_text)
        .otherwise(normalize_text(strip(texts(body, " "))))
    )
    # a heading without title that is the last sibling ends the reading of its
    # type: the units found before it stay, it and the later ones do not
    stuck = by_heading & no_next & F.when(kind == "article", title_0 == "").otherwise(anx["title"] == "")
    out = out.withColumn(
        "_stop", F.min(F.when(stuck, F.col("pos"))).over(Window.partitionBy(*keys, "reading", "type"))
    ).filter(F.col("_stop").isNull() | (F.col("pos") < F.col("_stop")))
    return out.select(
        *keys, "pos", "structure", "want", "type",
        number.alias("number"), title.alias("title"), unit_text.alias("text"),
    ).filter(~((F.col("structure") == "manual") & (F.col("type") == "article") & (F.col("number") == "")))


def extract_units(
    docs: DataFrame, keys: Sequence[str], html: str, partitioned: bool = False, unique: bool = False
) -> DataFrame:
    """Units of all pages of ``docs`` (keys, structure, want, html). ``unique`` tells that no two rows have the same keys;
    else the keys are counted, which reads nothing but them."""
    if unique:
        return units_from_elements(element_table(docs, keys, html, partitioned, F.lit(True)), keys)
    return _counted(with_copies(docs, keys, partitioned), keys, html)


def with_copies(docs: DataFrame, keys: Sequence[str], partitioned: bool) -> DataFrame:
    """``docs``, partitioned by the keys, with ``_copies``: the rows of their keys, NULL for a key with a NULL."""
    if not partitioned:
        docs = by_key(docs, keys)
    given = reduce(and_, [F.col(k).isNotNull() for k in keys])
    return docs.withColumn("_copies", F.when(given, F.count(F.lit(1)).over(Window.partitionBy(*keys))))


def _counted(docs: DataFrame, keys: Sequence[str], html: str) -> DataFrame:
    alone = F.coalesce(F.col("_copies") == 1, F.lit(False))
    return units_from_elements(element_table(docs, keys, html, True, alone), keys)


def _extract(docs, keys, html, structure, types, partitioned):
    def pick(page: Column) -> Column:
        row = F.struct(page.alias("html"), F.lit(structure).alias("structure"), F.lit(type_bits(types)).alias("want"))
        return F.when(M.structure_of(page) == structure, F.array(row))

    picked = with_copies(docs.select(*keys, html), keys, partitioned).select(
        *keys, "_copies", F.inline(let(F.col(html), pick))
    )
    return _counted(picked, keys, "html").drop("structure", "want")


def extract_standard(
    docs: DataFrame, keys: Sequence[str], html: str, types: Sequence[str] = UNIT_TYPES, partitioned: bool = False
) -> DataFrame:
    return _extract(docs, keys, html, "standard", types, partitioned)


def extract_manual(
    docs: DataFrame, keys: Sequence[str], html: str, types: Sequence[str] = UNIT_TYPES, partitioned: bool = False
) -> DataFrame:
    return _extract(docs, keys, html, "manual", types, partitioned)


def extract_plain(
    docs: DataFrame, keys: Sequence[str], html: str, types: Sequence[str] = UNIT_TYPES, partitioned: bool = False
) -> DataFrame:
    return _extract(docs, keys, html, "plain", types, partitioned)
