"""Title, date and raw text of documents through ordered fallbacks, with the
source that gave the value."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexspark.functions.ids import document_type
from lexspark.functions.markup import flatten_wrappers, is_missing, reads_as_xhtml
from lexspark.functions.text import date_from_title, first_nonempty, normalize_text
from lexspark.model import LANGUAGE
from lexspark.operators.graph import with_original
from lexspark.operators.choose import body_mark
from lexspark.operators.scale import by_key, materialize, may_have_key
from lexspark.operators.sequence import join_ordered
from lexspark.operators.tokens import html_tokens, inside_first, with_levels

UNAVAILABLE = "[Unavailable]"


def html_titles(manifestations: DataFrame, wanted: DataFrame | None = None) -> DataFrame:
    """Text of the first main-title div of the XHTML body, for the wanted ids
    only: just the pages that may be wanted are parsed and shuffled, once."""
    pages = manifestations.filter(
        (F.col("role") == "main") & (F.col("fmt") == "xhtml") & F.col("body").contains("eli-main-title")
    ).select("celex_id", "body")
    keys = ["celex_id"]
    if wanted is not None:
        pages = may_have_key(pages, wanted.select("celex_id"))
    # inline, not a filter: a filter would be pushed below the pruning
    pages = by_key(pages.select("celex_id", F.inline(F.when(reads_as_xhtml(F.col("body")), F.array(F.struct("body"))))), keys)
    if wanted is not None:
        # same partitioning on both sides, which the join keeps for the tokens. Not a left-semi join: the optimizer moves one
        # below the pruning, and then all pages are shuffled
        pages = pages.join(by_key(wanted.select("celex_id"), keys).distinct(), "celex_id")
    pages = pages.groupBy("celex_id").agg(F.min_by("body", body_mark(F.col("body"))).alias("body"))
    pages = pages.withColumn("html", flatten_wrappers(F.col("body")))
    tokens = with_levels(html_tokens(pages, keys, "html", partitioned=True, loose=True), keys)
    inner = inside_first(tokens, keys, (F.col("tag") == "div") & (F.col("class") == "eli-main-title"))
    runs = inner.filter(F.col("kind") == "text").withColumn("text", normalize_text(F.col("text")))
    return runs.groupBy("celex_id").agg(join_ordered("pos", F.col("text"), " ").alias("html_title"))


def one_per_id(facts: DataFrame, *fields: str) -> DataFrame:
    """One row (celex_id, fields) per id: of several values of a field the
    greatest, so a work given twice stays one work, and a re-run agrees."""
    return facts.groupBy("celex_id").agg(*[F.max(c).alias(c) for c in fields])


def resolve_title(
    ids: DataFrame, graph: DataFrame, notices: DataFrame, manifestations: DataFrame | None = None
) -> DataFrame:
    """(celex_id, title, title_source). ``graph``: celex_id, title; ``notices``:
    celex_id, notice_title. Graph, then notice, then page, then a fixed text."""
    known = (
        ids.select("celex_id")
        .join(graph.select("celex_id", F.col("title").alias("graph_title")), "celex_id", "left")
        .join(notices.select("celex_id", "notice_title"), "celex_id", "left")
    )
    early = first_nonempty(F.col("graph_title"), F.col("notice_title"))
    if manifestations is None:
        known = known.withColumn("html_title", F.lit(None).cast("string"))
    else:
        known = materialize(known)  # narrow; used for the pruning, for the pages and for the result
        known = known.join(html_titles(manifestations, known.filter(early.isNull())), "celex_id", "left")
    return known.select(
        "celex_id",
        F.coalesce(
            normalize_text(early), F.nullif(F.col("html_title"), F.lit("")), F.lit(UNAVAILABLE)
        ).alias("title"),
        F.when(F.nullif("graph_title", F.lit("")).isNotNull(), "graph")
        .when(F.nullif("notice_title", F.lit("")).isNotNull(), "notice")
        .when(F.nullif("html_title", F.lit("")).isNotNull(), "html")
        .otherwise("none").alias("title_source"),
    )


def resolve_date(titles: DataFrame, graph: DataFrame, notices: DataFrame) -> DataFrame:
    """(celex_id, date_adopted, date_source). Graph and notice dates are those
    of the original act; the title date is the document's own.
    ``graph``: celex_id, date; ``notices``: celex_id, notice_date."""
    facts = graph.select("celex_id", F.col("date").alias("graph_date")).join(
        notices.select("celex_id", "notice_date"), "celex_id", "full"
    )
    known = with_original(titles.select("celex_id", "title"), facts)
    own = F.when(F.col("title") != UNAVAILABLE, date_from_title(F.col("title")))
    return known.select(
        "celex_id",
        F.coalesce("graph_date", "notice_date", own).alias("date_adopted"),
        F.when(F.col("graph_date").isNotNull(), "graph")
        .when(F.col("notice_date").isNotNull(), "notice")
        .when(own.isNotNull(), "title")
        .otherwise("none").alias("date_source"),
    )


def resolve_html(manifestations: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """(celex_id, full_text_html), one row per id: the XHTML, else the plain
    HTML, wrappers flattened; page structure does not matter here. The choice is
    made on narrow rows; only bodies that may be chosen are shuffled."""
    main = manifestations.filter((F.col("role") == "main") & ~is_missing(F.col("body")))
    main = main.select("celex_id", "fmt", "body")
    if ids is not None:
        main = may_have_key(main, ids.select("celex_id"))
    rank = F.struct(F.when(F.col("fmt") == "xhtml", 0).otherwise(1).alias("rank"), "mark")
    facts = main.select("celex_id", "fmt", body_mark(F.col("body")).alias("mark"))
    chosen = facts.groupBy("celex_id").agg(F.min_by(F.struct("fmt", "mark"), rank).alias("c")).select("celex_id", "c.*")
    if ids is not None:
        chosen = chosen.join(ids.select("celex_id").distinct(), "celex_id", "left_semi")
    bodies = main.join(chosen, ["celex_id", "fmt"]).filter(body_mark(F.col("body")) == F.col("mark"))
    bodies = bodies.dropDuplicates(["celex_id", "fmt"])
    return bodies.select("celex_id", flatten_wrappers(F.col("body")).alias("full_text_html"))


def build_relations(bag: DataFrame, include: bool = True) -> DataFrame:
    """Relation rows of property bags (celex_id, relations map of lists);
    empty targets are dropped."""
    kinds = bag.select(
        F.col("celex_id").alias("celex_source"), F.explode("relations").alias("relation_type", "_targets")
    )
    rows = kinds.select(
        "celex_source", F.explode("_targets").alias("celex_target"), "relation_type"
    ).filter(F.length("celex_target") > 0)
    return rows if include else rows.filter(F.lit(False))


def build_works(
    ids: DataFrame, titles: DataFrame, dates: DataFrame, bodies: DataFrame | None = None
) -> DataFrame:
    """The works table. Bodies are joined last, so no other join carries them."""
    rows = (
        ids.select("celex_id").distinct()
        .join(titles.select("celex_id", "title"), "celex_id", "left")
        .join(dates.select("celex_id", "date_adopted"), "celex_id", "left")
        .select(
            "celex_id",
            document_type(F.col("celex_id")).alias("document_type"),
            F.coalesce("title", F.lit(UNAVAILABLE)).alias("title"),
            "date_adopted",
            F.lit(LANGUAGE).alias("language"),
        )
    )
    if bodies is None:
        return rows.withColumn("full_text_html", F.lit(None).cast("string"))
    return rows.join(bodies, "celex_id", "left")


def quarantine_reason(works: DataFrame) -> DataFrame:
    """Adds ``reason``: why a work is not fit for the final table, or NULL. A
    work without a title keeps its placeholder and is fit."""
    return works.withColumn(
        "reason",
        F.when(F.col("date_adopted").isNull(), "no date"),
    )


def with_quarantine(works: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good, bad): one bad document does not stop the run."""
    marked = quarantine_reason(works)
    return marked.filter("reason IS NULL").drop("reason"), marked.filter("reason IS NOT NULL")


