"""The token table: one row per tag or text run of a document.

All windows here are partitioned by document, and a document is one input
value, so a partition is never larger than one body. Bodies are shuffled by
document *before* they are cut into tokens; Spark keeps that partitioning
through the explode, so the token table itself, which is much larger, is only
sorted and never shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexspark.functions import markup as M
from lexspark.functions.text import is_blank, let, normalize_text, unescape
from lexspark.operators.scale import by_key
from lexspark.operators.sequence import join_ordered, latest, running

SPAN_BLOCK = 256
STARTS = ("open", "void", "leaf")


def html_tokens(
    df: DataFrame, keys: Sequence[str], html: str, carry: Sequence[str] = (),
    partitioned: bool = False, comments: bool = False, loose: bool = False, alone: Column | None = None,
) -> DataFrame:
    """Rows (keys, pos, kind, tag, id, class, text). Comments, scripts, styles,
    declarations and blank text are dropped; text is decoded. With ``comments``
    comment rows stay (they count as empty children); with ``loose`` each row
    says whether its tag is unbalanced in the page. With ``loose`` and ``alone``, a column of documents that is true where
    no other row has the keys, an element that holds one text alone is one row of kind ``leaf`` with its text (blank text
    is ''), if all tags of the page pair up: rows cost far more than what is in them.

    ``carry`` names document columns to repeat on every token. ``partitioned``
    tells that ``df`` is already partitioned by the keys.
    """
    fuse = loose and alone is not None
    bodies = df.select(*keys, *carry, F.col(html).alias("_html"), *([alone.alias("_alone")] if fuse else []))
    if not partitioned:
        bodies = by_key(bodies, keys)
    keys = [*keys, *carry]
    page = F.col("_html")
    if fuse:
        def cuts(tags: Column) -> Column:
            leaves = F.col("_alone") & (F.size(tags) == 0)
            raws = F.when(leaves, M.leaf_tokens(page)).otherwise(M.raw_tokens(page))
            return F.array(F.struct(raws.alias("_raws"), tags.alias("_loose_tags"), leaves.alias("_leaves")))

        # inline, so that the tags are counted once
        cut = bodies.select(*keys, F.inline(let(M.loose_tags(page), cuts)))
    else:
        tags = [M.loose_tags(page).alias("_loose_tags")] if loose else []
        cut = bodies.select(*keys, M.raw_tokens(page).alias("_raws"), *tags)
    extra = (["_loose_tags"] if loose else []) + (["_leaves"] if fuse else [])
    raw = F.col("raw")
    # the outer form on purpose: for the inner one the optimizer adds a test of
    # the array's size below, and the page would be cut once more for it. The
    # filter that follows drops the NULL token of an empty page.
    rows = cut.select(*keys, *extra, F.posexplode_outer("_raws").alias("pos", "raw"))
    # filters look at the raw token only: one on a computed column would compute
    # that column a second time
    drop = M.is_skipped(raw) | (~F.startswith(raw, F.lit("<")) & is_blank(raw))
    if not comments:
        drop = drop | F.startswith(raw, F.lit("<!--"))
    # a text of references only may be blank too
    rows = rows.filter(~drop).filter(~raw.rlike(r"^[\s&]") | ~F.contains(raw, F.lit("&")) | ~is_blank(unescape(raw)))
    # the name is cut once: kind and tag both refer to it
    cdata = F.regexp_extract(raw, r"(?is)^<!\[CDATA\[(.*)\]\]>$", 1)
    kind = M.token_kind(raw, F.col("_name"))
    if fuse:
        kind = F.when(F.col("_leaves") & M.is_leaf(raw), "leaf").otherwise(kind)
    rows = rows.withColumn("_name", M.tag_name(raw)).withColumn("kind", kind)
    is_tag = F.col("kind").isin("open", "close", "void", "leaf")
    starts = F.col("kind").isin(*STARTS)
    text = F.when(
        F.col("kind") == "text", F.when(F.startswith(raw, F.lit("<![CDATA[")), cdata).otherwise(unescape(raw))
    )
    if fuse:
        # the text is cut out once, and decoded once: each step refers to the column before
        rows = rows.withColumn("_cut", F.when(F.col("kind") == "leaf", M.leaf_text(raw)))
        rows = rows.withColumn("_inner", unescape(F.col("_cut")))
        text = text.when((F.col("kind") == "leaf") & ~is_blank(F.col("_inner")), F.col("_inner"))
    out = rows.select(
        *keys,
        *extra,
        "pos",
        "kind",
        F.when(is_tag, F.col("_name")).otherwise("").alias("tag"),
        F.when(starts, M.attribute(raw, "id")).otherwise("").alias("id"),
        F.when(starts, M.attribute(raw, "class")).otherwise("").alias("class"),
        text.otherwise("").alias("text"),
    )
    if loose:
        out = out.withColumn("loose", F.array_contains("_loose_tags", F.col("tag"))).withColumn(
            "loose_p", F.array_contains("_loose_tags", F.lit("p"))
        ).drop(*extra)
    return out


def with_levels(tokens: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Adds ``level``: the depth of an element for its start and end tag, the
    depth of the enclosing element for text.

    Repair of unbalanced pages: an unbalanced tag other than p does not nest;
    in a page with unbalanced p, an open p ends at the next block tag.
    """
    w = running(keys, "pos")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    kind, tag = F.col("kind"), F.col("tag")
    block = tag.isin(*M.BLOCK_TAGS)
    is_p = tag == "p"
    flat = F.col("loose") & ~is_p
    t = tokens.withColumn(
        "kind", F.when(flat & (kind == "open"), "void").when(flat & (kind == "close"), "skip").otherwise(kind)
    ).filter(kind != "skip")
    t = t.withColumn(
        "_in_p",
        F.when(
            F.col("loose_p"),
            F.coalesce(latest(F.when(block, is_p & (kind == "open")), before), F.lit(False)),
        ).otherwise(F.lit(False)),
    )
    stray = F.col("loose_p") & ~F.col("_in_p") & is_p & (kind == "close")
    t = t.filter(~stray)
    ends_p = F.col("_in_p") & block & ~(is_p & (kind == "close"))
    delta = (
        F.when(kind == "open", 1).when(kind == "close", -1).otherwise(0)
        - F.when(ends_p, 1).otherwise(0)
    )
    t = t.withColumn("_depth", F.sum(delta).over(w))
    level = F.col("_depth") + F.when(kind.isin("close", "void", "comment", "leaf"), 1).otherwise(0)
    return t.withColumn("level", level.cast("int")).drop("_in_p", "_depth", "loose", "loose_p")


def frames(
    tokens: DataFrame, keys: Sequence[str], section: Column,
    inner_tags: Sequence[str] = (), mark: Column | None = None,
    body: Column | None = None, bound: Column | None = None,
) -> DataFrame:
    """Tokens seen from the levels at which sections sit.

    ``section`` picks start tags. For every level at which a document has a
    section (one, as a rule; more when sections nest), each token at or below
    that level appears once, with

    * ``el``, ``el_tag``, ``el_id``, ``el_class``: the enclosing element at the
      section level (its position and attributes),
    * ``child``: position of the enclosing child of that element, or NULL,
    * ``parent``: position of the parent of that element,
    * ``hit``: a start tag below ``el`` that satisfies ``mark``, which may use
      the ``el_*`` columns (see ``first_mark``),
    * ``in_body``: the token lies in the first element of the document whose
      start tag satisfies ``body``. Where ``bound``, a column of documents, is
      true, levels that are not below that element do not count.

    A ``leaf`` is a start tag and a text; ``body`` never picks one, since no div is.

    ``inner_tags`` names the tags ``mark`` looks at, and others to keep below
    the child level. The rows grow with the result only: no token is compared
    with a section it does not belong to, and no join is needed. Two windows do
    it, one over the document and one over its rows at a level: a window copies
    every row, so what can be told per element is left to its aggregate.
    """
    kind, level, pos = F.col("kind"), F.col("level"), F.col("pos")
    starts = kind.isin(*STARTS)
    body = F.lit(False) if body is None else body & (kind == "open")
    whole = Window.partitionBy(*keys)
    t = tokens.withColumns({
        "_levels": F.collect_set(F.when(section & starts, level)).over(whole),
        "_body": F.min(F.when(body, F.struct("pos", "level"))).over(whole),
    }).withColumn("frame", F.explode("_levels")).drop("_levels")
    frame = F.col("frame")
    if bound is not None:
        t = t.filter(~bound | (frame > F.col("_body.level")))
    inner = F.col("tag").isin(*inner_tags) if inner_tags else F.lit(False)
    ends_body = F.coalesce((kind == "close") & (level == F.col("_body.level")) & (pos > F.col("_body.pos")), F.lit(False))
    t = t.filter(
        (kind.isin("text", "leaf") & (level >= frame))
        | (starts & level.between(frame - 1, frame + 1))
        | ((kind == "comment") & level.between(frame, frame + 1))
        | (inner & (level > frame))
        | ends_body
    )
    w = running([*keys, "frame"], "pos")
    is_el = (starts | (kind == "comment")) & (level == frame)
    is_child = (starts | (kind == "comment")) & (level == frame + 1)
    t = t.withColumns({
        "parent": F.coalesce(latest(F.when(starts & (level == frame - 1), pos), w), F.lit(-1)),
        "_el": latest(F.when(is_el, F.struct("pos", "tag", "id", "class")), w),
        "child": latest(F.when(is_el, F.lit(-1)).when(is_child, pos), w),
        "_out": F.sum(F.when(ends_body, 1).otherwise(0)).over(w),
    }).filter((F.col("_el.pos") > F.col("parent")) & (level >= frame))
    t = t.withColumns({
        "el": F.col("_el.pos"), "el_tag": F.col("_el.tag"), "el_id": F.col("_el.id"),
        "el_class": F.col("_el.class"),
        "child": F.when((F.col("child") >= 0) & (level > frame), F.col("child")),
        "in_body": F.coalesce((pos >= F.col("_body.pos")) & (F.col("_out") == 0), F.lit(False)),
    }).drop("_el", "_body", "_out")
    # an end of the body kept for the count alone
    t = t.filter((kind != "close") | (inner & (level > frame)))
    return t.withColumn("hit", F.lit(False) if mark is None else F.coalesce(mark & starts & (level > frame), F.lit(False)))


def first_mark() -> tuple[Column, Column]:
    """Aggregates over rows of one element of ``frames``: the first start tag that is a ``hit``, and the end tags."""
    kind = F.col("kind")
    at = F.struct("pos", "level", kind.isin("open", "leaf").alias("opens"), (kind == "leaf").alias("leaf"))
    return F.min(F.when(F.col("hit"), at)), F.collect_list(F.when(F.col("kind") == "close", F.struct("pos", "level")))


def in_mark(runs: Column, first: Column, ends: Column) -> Column:
    """The runs inside the element that ``first`` opens, up to its end tag if there is one; none inside a void tag."""
    after = F.filter(ends, lambda e: (e["level"] == first["level"]) & (e["pos"] > first["pos"]))
    end = F.array_min(F.transform(after, lambda e: e["pos"]))
    inside = F.filter(runs, lambda r: F.when(first["leaf"], r["pos"] == first["pos"]).otherwise(
        (r["pos"] > first["pos"]) & (end.isNull() | (r["pos"] < end))
    ))
    return F.when(first["opens"] & (first["level"] > 0), inside).otherwise(F.slice(runs, 1, 0))


def inside_first(tokens: DataFrame, keys: Sequence[str], mark: Column) -> DataFrame:
    """Tokens inside the first element of each document that satisfies ``mark``."""
    w = running(keys, "pos")
    kind, level = F.col("kind"), F.col("level")
    hit = mark & (kind == "open")
    t = tokens.withColumn("_n", F.sum(F.when(hit, 1).otherwise(0)).over(w))
    t = t.withColumn("_level", latest(F.when(hit & (F.col("_n") == 1), level), w))
    t = t.withColumn(
        "_out", F.sum(F.when((kind == "close") & (level == F.col("_level")), 1).otherwise(0)).over(w)
    )
    return t.filter((F.col("_n") >= 1) & (F.col("_out") == 0)).drop("_n", "_level", "_out")


def pair_elements(tokens: DataFrame, keys: Sequence[str], tag: str = "div") -> DataFrame:
    """Each start tag with its end tag: (keys, id, class, level, open, close).
    Depth counts the one tag only, so other tags may be unbalanced. Start and
    end tags alternate within a level, so the partner is the next row."""
    only = tokens.filter((F.col("tag") == tag) & F.col("kind").isin("open", "close"))
    w = running(keys, "pos")
    opens = F.col("kind") == "open"
    t = only.withColumn("_depth", F.sum(F.when(opens, 1).otherwise(-1)).over(w))
    t = t.withColumn("level", F.when(opens, F.col("_depth")).otherwise(F.col("_depth") + 1).cast("int"))
    at_level = Window.partitionBy(*keys, "level").orderBy("pos")
    t = t.withColumns({"close": F.lead("pos").over(at_level), "_next": F.lead("kind").over(at_level)})
    return t.filter(opens).select(
        *keys, "id", "class", "level", F.col("pos").alias("open"),
        F.when(F.col("_next") == "close", F.col("close")).alias("close"),
    )


def tokens_in_spans(tokens: DataFrame, spans: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Text tokens within [open, close] of each span; nested spans both get
    them. Positions are cut into blocks, and the equi-join on (document, block)
    meets only spans that reach into the block, so a long document is spread
    over tasks and tokens are not tried against far spans."""
    texts = tokens.filter(F.col("kind") == "text").select(*keys, "pos", "text").withColumn(
        "_block", F.floor(F.col("pos") / SPAN_BLOCK)
    )
    covers = spans.filter(F.col("close").isNotNull()).withColumn(
        "_block",
        F.explode(F.sequence(F.floor(F.col("open") / SPAN_BLOCK), F.floor(F.col("close") / SPAN_BLOCK))),
    )
    return texts.join(covers, [*keys, "_block"]).filter(
        F.col("pos").between(F.col("open"), F.col("close"))
    ).drop("_block")


def extract_text(order: str = "pos", when: Column | None = None) -> Column:
    """Aggregate: text runs of a group in order, one space between, normalised."""
    text = F.when(F.col("kind") == "text", F.col("text"))
    if when is not None:
        text = F.when(when, text)
    return normalize_text(join_ordered(order, text, " "))


def structure_flags(tokens: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Which page structures each document's tokens show: is_standard,
    is_manual, is_plain. One aggregate on the token table."""
    div, p = F.col("tag") == "div", F.col("tag") == "p"
    return tokens.groupBy(*keys).agg(
        F.bool_or(div & F.col("id").rlike("^(rct|art)_")).alias("is_standard"),
        F.bool_or(p & F.col("class").isin(*M.MANUAL_CLASSES)).alias("is_manual"),
        F.bool_or(div & (F.col("id") == "TexteOnly")).alias("is_plain"),
    )
