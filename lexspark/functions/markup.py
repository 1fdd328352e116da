"""Markup as row-local expressions: tokens, wrapper removal, page structure."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexspark.functions.text import let

# One token per comment, script, style, CDATA section, tag or text run. Every
# character belongs to exactly one token, so the tokens rebuild the page.
# The rest of a tag: quoted values may hold '>'. Possessive, so that the engine
# runs it as a loop and no tag, however long or broken, deepens the stack.
_REST = r"(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>"
TOKEN = (
    r"(?is)<!--.*?-->"
    r"|<script\b.*?</script\s*>"
    r"|<style\b.*?</style\s*>"
    r"|<!\[CDATA\[.*?\]\]>"
    r"|<[a-z/!?]" + _REST +
    r"|[^<]++|<"
)
VOID_TAGS = (
    "area", "base", "br", "col", "embed", "hr", "img", "input", "link",
    "meta", "param", "source", "track", "wbr",
)
# Tags that end an open paragraph.
BLOCK_TAGS = (
    "address", "article", "aside", "blockquote", "body", "center", "dd", "div",
    "dl", "dt", "fieldset", "footer", "form", "h1", "h2", "h3", "h4", "h5",
    "h6", "header", "html", "li", "main", "nav", "ol", "p", "pre", "section",
    "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
)
# A start tag, its text without markup and its end tag. Divs and void elements stay apart; so does a text with '=', which
# might read like an attribute.
LEAF = (
    r"<(?!(?:div|script|style|" + "|".join(VOID_TAGS) + r")[^a-z0-9])([a-z][a-z0-9]*+)"
    r"(?:\s(?:[^<>\"']++|\"[^\"<>]*+\"|'[^'<>]*+')*+)?+(?<!/)>[^<>=]++</\1>"
)
_OR_TAG = r"|<[a-z/!?]"
LEAF_TOKEN = TOKEN.replace(_OR_TAG, "|" + LEAF + _OR_TAG, 1)
# Names that need no lower-casing.
LOWER_NAMES = ("p", "div", "span", "br", "td", "tr", "table", "tbody", "a", "b", "i", "em", "li", "ul", "html", "body", "head")
STRUCTURES = ("standard", "manual", "plain")
MANUAL_CLASSES = ("li ManualConsidrant", "Titrearticle", "Annexetitre")

_OPAQUE = r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>"
_DIV = r"<(?:[a-z][\w.-]*+:)?div\b" + _REST
_DIV_CUT = _OPAQUE + r"|</?(?:[a-z][\w.-]*+:)?div\b" + _REST


def raw_tokens(html: Column) -> Column:
    return F.regexp_extract_all(html, F.lit(TOKEN), F.lit(0))


def leaf_tokens(html: Column) -> Column:
    """``raw_tokens`` where an element that holds one text alone is one token."""
    return F.regexp_extract_all(html, F.lit(LEAF_TOKEN), F.lit(0))


def is_leaf(raw: Column) -> Column:
    """Of ``leaf_tokens``: an element with its text. The pattern itself decides, since a quoted value may hold an end tag."""
    return F.contains(raw, F.lit("</")) & ~F.startswith(raw, F.lit("</")) & raw.rlike(rf"(?is)^{LEAF}\z")


def leaf_text(raw: Column) -> Column:
    return F.substring_index(F.substring_index(raw, "</", 1), ">", -1)


def token_kind(raw: Column, name: Column | None = None) -> Column:
    """open, close, void, text or comment, of a token that is not skipped. ``name``: its tag name, if it is there already."""
    head = F.substring(raw, 1, 2)
    name = tag_name(raw) if name is None else name
    return (
        F.when((F.substring(raw, 1, 1) != "<") | (raw == "<"), "text")
        .when(head == "</", "close")
        .when(F.startswith(raw, F.lit("<!--")), "comment")
        .when(F.startswith(raw, F.lit("<![CDATA[")), "text")
        .when(F.endswith(raw, F.lit("/>")) | name.isin(*VOID_TAGS), "void")
        .otherwise("open")
    )


def is_skipped(raw: Column) -> Column:
    """Declarations, scripts and styles, told from the start of the token."""
    return raw.rlike(r"(?i)^<(?:script\b|style\b|\?|!(?!--|\[CDATA\[))")


def tag_name(raw: Column) -> Column:
    """Local name, lower case."""
    name = F.regexp_extract(raw, r"^</?(?:[A-Za-z][\w.-]*:)?([A-Za-z][^\s/>:]*)", 1)
    return F.when(name.isin(*LOWER_NAMES), name).otherwise(F.lower(name))


def attribute(raw: Column, name: str) -> Column:
    """Value of an attribute, quoted or not, whatever the case of its name."""
    found = F.regexp_extract(raw, rf"(?is)\s{name}\s*=\s*(\"[^\"]*+\"|'[^']*+'|[^\s\"'=<>`]++)", 1)
    bare = let(found, lambda v: F.when(
        v.rlike("^[\"']"), F.substring(v, F.lit(2), F.length(v) - 2)
    ).otherwise(v))
    return F.when(F.contains(raw, F.lit("=")), bare).otherwise("")


_COMMENT = r"(?s)<!--.*?-->"
_OPEN_END = (
    r"(?i)<(?!meta\s+http-equiv\s*=\s*[\"']content-type[\"'])(?:" + "|".join(VOID_TAGS) + r")(?![\w.:-])"
)
_RAW_MARKUP = r"(?is)<(?:script|style)\b[^>]*+(?<!/)>[^<&]*+(?!</(?:script|style))"
_PROLOG = r"(?is)^\s*+(?:<\?xml.*?\?>)?\s*+(?:<!--.*?-->\s*+)*+"
_DOCTYPE = r"<!DOCTYPE[^>\[]*(?:\[.*?\])?\s*>"


def parses(body: Column) -> Column:
    """True when the body is one well-formed XML document. The body is put into
    a root of our own, so that content behind the end of its root is seen too.
    With a document type, named entities count as declared."""
    return let(body, _parses)


def _parses(body: Column) -> Column:
    core = F.regexp_replace(body, _PROLOG + "(?:" + _DOCTYPE + ")?", "")
    declared = body.rlike(_PROLOG + _DOCTYPE)
    named = r"&(?!(?:amp|lt|gt|quot|apos);)[A-Za-z][A-Za-z0-9]*;"
    core = F.when(declared, F.regexp_replace(core, named, " ")).otherwise(core)
    single = "count(/x/*) = 1 and not(/x/text()[normalize-space()])"

    def whole(wrapped: Column) -> Column:
        probe = F.from_xml(
            wrapped, T.StructType([T.StructField("_corrupt_record", T.StringType())]), {"mode": "PERMISSIVE"}
        )
        # the path is only tried on text that is known to be well-formed
        return F.when(probe["_corrupt_record"].isNotNull(), False).otherwise(
            F.xpath_boolean(wrapped, F.lit(single))
        )

    wrapped = F.concat(F.lit("<x>"), core, F.lit("</x>"))
    return F.when(is_missing(body), False).otherwise(let(wrapped, whole))


def reads_as_xhtml(body: Column) -> Column:
    """True when the body is one well-formed XML document, or becomes one by the repair of an HTML parser: unclosed and
    stray tags, bare ``&`` and unknown entities are mended by it. A void element stays without an end tag there (but a
    content-type meta is dropped), and scripts and styles keep their ``<`` and ``&``; a page with one of these is not
    repaired. Nothing, blanks and text without a tag are no document."""
    return let(body, lambda b: parses(b) | repairable(b))


def repairable(body: Column) -> Column:
    """The second part of ``reads_as_xhtml``."""
    page = lambda b: F.regexp_replace(b, _COMMENT, "")
    fits = lambda b: b.rlike("<[A-Za-z]") & ~b.rlike(_RAW_MARKUP) & ~_without_opaque(b).rlike(_OPEN_END)
    return F.coalesce(let(page(body), fits), F.lit(False))


def is_missing(body: Column) -> Column:
    return body.isNull() | ~body.rlike(r"\S")


def has_wrapper(html: Column) -> Column:
    """Some div of class 'content'. The cheap test decides for most pages."""
    divs = F.regexp_extract_all(html, F.lit("(?is)" + _DIV), F.lit(0))
    return html.rlike(r"(?i)class\s*=\s*[\"']?content\b") & F.exists(divs, lambda t: attribute(t, "class") == "content")


def flatten_wrappers(html: Column) -> Column:
    """Remove every div of class 'content' but keep its children. Text between
    the wrapper and its first child, and text right after the wrapper, is lost.
    The root element is never removed.

    Only pages that have a wrapper are rewritten. The page is cut at its div
    tags, a stack kept as a string of 0/1 says which end tag closes a wrapper,
    and the page is joined again; the work stays inside the row.
    """
    return let(html, lambda h: F.when(has_wrapper(h), _flatten(h)).otherwise(h))


def _flatten(html: Column) -> Column:
    both = F.struct(
        F.regexp_extract_all(html, F.lit(_DIV_CUT), F.lit(0)).alias("cuts"),
        F.split(html, _DIV_CUT, -1).alias("parts"),
    )
    return let(both, lambda b: _without_wrappers(b["cuts"], b["parts"]))


def _without_wrappers(cuts: Column, parts: Column) -> Column:
    is_open = lambda t: t.rlike(r"(?is)^<(?:[a-z][\w.-]*:)?div\b") & ~F.endswith(t, F.lit("/>"))
    is_close = lambda t: t.rlike(r"(?is)^</")
    is_wrap = lambda t: attribute(t, "class") == "content"
    rooted = parts[0].rlike(r"<[A-Za-z]")

    def step(acc: Column, t: Column) -> Column:
        stack, marks = acc["stack"], acc["marks"]
        not_root = rooted | (F.length(marks) > 0)
        top = F.substring(stack, 1, 1)
        rest = F.substring(stack, 2, 1 << 30)
        return (
            F.when(
                is_open(t),
                F.when(
                    is_wrap(t) & not_root,
                    F.struct(F.concat(F.lit("1"), stack).alias("stack"), F.concat(marks, F.lit("x")).alias("marks")),
                ).otherwise(
                    F.struct(F.concat(F.lit("0"), stack).alias("stack"), F.concat(marks, F.lit(".")).alias("marks"))
                ),
            )
            .when(
                is_close(t),
                F.struct(
                    rest.alias("stack"),
                    F.concat(marks, F.when(top == "1", "x").otherwise(".")).alias("marks"),
                ),
            )
            .otherwise(F.struct(stack.alias("stack"), F.concat(marks, F.lit(".")).alias("marks")))
        )

    start = F.struct(F.lit("").alias("stack"), F.lit("").alias("marks"))
    marks = F.split(F.aggregate(cuts, start, step, lambda acc: acc["marks"]), "")
    zipped = F.arrays_zip(
        cuts.alias("cut"),
        F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0))).alias("part"),
        marks.alias("mark"),
    )
    glued = F.transform(
        F.filter(zipped, lambda z: z["cut"].isNotNull()),
        lambda z: F.when(z["mark"] == "x", F.regexp_replace(z["part"], r"^[^<]+", "")).otherwise(
            F.concat(z["cut"], z["part"])
        ),
    )
    return F.concat(parts[0], F.array_join(glued, ""))


def _without_opaque(html: Column) -> Column:
    """The page without comments, scripts and styles. Most pages have none, and
    the test for it is cheap."""
    return let(html, lambda h: F.when(
        F.contains(h, F.lit("<!--")) | h.rlike("(?i)<s(?:cript|tyle)"), F.regexp_replace(h, _OPAQUE, "")
    ).otherwise(h))


_MARKED = r"rct_|art_|TexteOnly|" + "|".join(MANUAL_CLASSES)
_DIV_OR_P = r"(?is)<(?:[a-z][\w.-]*+:)?(?:div|p)\b" + _REST


def structure_of(html: Column) -> Column:
    """standard, manual, plain or NULL, tested in this order on the page's div
    and p tags, cut by the same rule as tokens. A page that only has annex
    sections is not a standard page."""

    def test(tags: Column) -> Column:
        some = lambda name, attr, good: F.exists(
            tags, lambda t: (tag_name(t) == name) & good(attribute(t, attr))
        )
        return (
            F.when(some("div", "id", lambda v: F.startswith(v, F.lit("rct_")) | F.startswith(v, F.lit("art_"))), "standard")
            .when(some("p", "class", lambda v: v.isin(*MANUAL_CLASSES)), "manual")
            .when(some("div", "id", lambda v: v == "TexteOnly"), "plain")
        )

    def marked(page: Column) -> Column:
        # only tags that can decide are looked at
        tags = F.filter(F.regexp_extract_all(page, F.lit(_DIV_OR_P), F.lit(0)), lambda t: t.rlike(_MARKED))
        return F.when(page.rlike(_MARKED), let(tags, test))

    return let(_without_opaque(html), marked)


_START_NAME = (
    r"<(?!(?:" + "|".join(VOID_TAGS) + r")\b)(?:[a-z][\w.-]*:)?([a-z][^\s/>:]*)(?:\s[^>]*)?(?<!/)>"
)
_CAPITAL = r"<[^>\sA-Z\x{80}-\x{10FFFF}]*+[A-Z\x{80}-\x{10FFFF}]"
_END_NAME = r"</(?:[a-z][\w.-]*:)?([a-z][^\s/>:]*)"


def loose_tags(html: Column) -> Column:
    """Names of the tags whose start and end tags do not pair up in this page."""
    names = lambda page: F.struct(
        F.regexp_extract_all(page, F.lit(_START_NAME), F.lit(1)).alias("o"),
        F.regexp_extract_all(page, F.lit(_END_NAME), F.lit(1)).alias("c"),
    )

    def differing(x: Column) -> Column:
        count = lambda side, n: F.size(F.filter(side, lambda v: v == n))
        return F.when(
            F.sort_array(x["o"]) == F.sort_array(x["c"]), F.array().cast("array<string>")
        ).otherwise(
            F.filter(F.array_union(x["o"], x["c"]), lambda n: count(x["o"], n) != count(x["c"], n))
        )

    # to lower a page with any letter beyond ASCII is slow; it changes nothing where no tag name has such or a capital
    low = lambda h: F.when(h.rlike(_CAPITAL), F.lower(h)).otherwise(h)
    return let(_without_opaque(html), lambda h: let(low(h), lambda low: let(names(low), differing)))
