"""Text functions. All are built from JVM-side expressions."""

from __future__ import annotations

import json
from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

# White space as Python's str knows it: NBSP, the other Unicode spaces and the
# four separator controls count. Written out, since (?U) tests every character
# by its Unicode properties; the range test in front keeps most letters away
# from the wide spaces.
_RARE = r"\t\n\x0B\f\r\x1c\x1d\x1e\x1f\x85\xA0"
_NARROW = _RARE + " "
_WIDE = r"[\u1680-\u3000&&[\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]]"
SPACE = f"[{_NARROW}{_WIDE}]"
NOT_SPACE = f"[^{_NARROW}{_WIDE}]"
_SPACES = "\t\n\x0b\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000" + "".join(map(chr, range(0x2000, 0x200B)))

_ENTITIES = json.dumps({"apos": "'", **{name: chr(code) for name, code in name2codepoint.items()}})

# English month names.
MONTHS = (
    "january", "february", "march", "april", "may", "june", "july",
    "august", "september", "october", "november", "december",
)


def let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once per row, however often it is
    used; a plain reference would be written out at every place."""
    return F.transform(F.array(value), use)[0]


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(_SPACES))


def is_blank(c: Column) -> Column:
    return strip(c) == ""


def normalize_text(c: Column) -> Column:
    """Space after closing punctuation, none before, single spaces elsewhere."""
    c = F.regexp_replace(c, rf"([,;:!?.)}}\]])({NOT_SPACE})", "$1 $2")
    c = F.regexp_replace(c, rf"{SPACE}+([,;:!?.])", "$1")
    # a single space is left as it is: most runs are one, and every replacement costs a copy
    return F.trim(F.regexp_replace(c, rf"[{_RARE}{_WIDE}]{SPACE}*+| {SPACE}++", " "))


def first_nonempty(*cols: Column) -> Column:
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in cols])


def decode_body(c: Column) -> Column:
    """Bytes to text; NULL when the bytes are not UTF-8."""
    return F.try_validate_utf8(c.cast("string"))


def contains_ci(text: Column, keyword: Column) -> Column:
    return F.contains(F.lower(text), F.lower(keyword))


def unescape(c: Column) -> Column:
    """Decode named and numeric character references."""
    names = F.from_json(F.lit(_ENTITIES), "map<string,string>")  # folded to a constant

    def from_code(n: Column) -> Column:
        ok = (n > 0) & (n <= 0x10FFFF) & ~n.between(0xD800, 0xDFFF)
        char = F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")
        return F.when(ok, char).otherwise(F.lit("�"))

    def piece(p: Column) -> Column:
        decimal = F.regexp_extract(p, r"^&#([0-9]{1,8});$", 1)
        hexa = F.regexp_extract(p, r"^&#[xX]([0-9a-fA-F]{1,7});$", 1)
        name = F.regexp_extract(p, r"^&([a-zA-Z][a-zA-Z0-9]*);$", 1)
        return (
            F.when(~F.startswith(p, F.lit("&")), p)
            .when(decimal != "", from_code(decimal.cast("bigint")))
            .when(hexa != "", from_code(F.conv(hexa, 16, 10).cast("bigint")))
            .otherwise(F.coalesce(F.try_element_at(names, name), p))
        )

    pieces = F.regexp_extract_all(c, F.lit(r"&#?[a-zA-Z0-9]+;|[^&]+|&"), F.lit(0))
    # the five names of XML alone need no cutting; the ampersand comes last, so nothing is decoded twice
    plain = c
    for name, char in (("lt", "<"), ("gt", ">"), ("quot", '"'), ("apos", "'"), ("amp", "&")):
        plain = F.replace(plain, F.lit(f"&{name};"), F.lit(char))
    return (
        F.when(~F.contains(c, F.lit("&")), c)
        .when(~c.rlike("&(?!(?:amp|lt|gt|quot|apos);)"), plain)
        .otherwise(F.array_join(F.transform(pieces, lambda p: piece(p)), ""))
    )


def date_from_title(c: Column) -> Column:
    """First 'day Month year' of a title; only a full English month name counts."""
    pattern = rf"(?U)(\d{{1,2}}){SPACE}([A-Za-z]{{3,9}}){SPACE}(\d{{4}})"
    months = F.create_map(*[F.lit(x) for i, m in enumerate(MONTHS, 1) for x in (m, str(i))])
    month = F.try_element_at(months, F.lower(F.regexp_extract(c, pattern, 2)))
    parts = [F.regexp_extract(c, pattern, 3), month, F.regexp_extract(c, pattern, 1)]
    return F.when(month.isNotNull(), F.try_to_date(F.concat_ws("-", *parts), "y-M-d"))


def date_from_parts(year: Column, month: Column, day: Column) -> Column:
    return F.when(
        year.isNotNull() & month.isNotNull() & day.isNotNull(),
        F.try_to_date(F.concat_ws("-", strip(year), strip(month), strip(day)), "y-M-d"),
    )


def decode_literal(value: Column, kind: Column, datatype: Column) -> Column:
    """Typed literal as a struct with one field per type and the name of the
    type that was set. ``v_kind`` is 'bad' when the text does not fit the type."""
    typed = (kind == "literal") & (F.coalesce(datatype, F.lit("")) != "")

    def has(*words: str) -> Column:
        test = F.lit(False)
        for w in words:
            test = test | F.contains(datatype, F.lit(w))
        return test

    family = (
        F.when(~F.coalesce(typed, F.lit(False)), "string")
        .when(has("boolean"), "boolean")
        .when(has("integer", "positiveInteger"), "integer")
        .when(has("decimal", "double", "float"), "double")
        .when(has("date") & ~has("dateTime"), "date")
        .when(has("dateTime"), "timestamp")
        .when(has("gYear"), "year")
        .otherwise("string")
    )
    text = F.coalesce(value, F.lit(""))
    whole = F.when(text.rlike(r"^\s*[+-]?[0-9]+\s*$"), F.trim(text).try_cast("bigint"))
    v_bool = F.when(family == "boolean", (F.lower(text) == "true") | (text == "1"))
    v_long = F.when(family.isin("integer", "year"), whole)
    v_double = F.when(family == "double", F.trim(text).try_cast("double"))
    v_date = F.when(
        family == "date",
        F.when(text.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), F.try_to_date(text, "y-M-d")),
    )
    dated = text.rlike(r"^\s*-?\d{4,}-\d{1,2}-\d{1,2}")  # a time alone would become today's
    v_time = F.when((family == "timestamp") & dated, text.try_cast("timestamp"))
    v_text = F.when((family == "string") | ((family == "timestamp") & v_time.isNull()), text)
    bad = (
        (family.isin("integer", "year") & v_long.isNull())
        | ((family == "double") & v_double.isNull())
        | ((family == "date") & v_date.isNull())
    )
    return F.struct(
        F.when(bad, "bad").when(v_text.isNotNull(), "string").otherwise(family).alias("v_kind"),
        v_bool.alias("v_bool"),
        v_long.alias("v_long"),
        v_double.alias("v_double"),
        v_date.alias("v_date"),
        v_time.alias("v_time"),
        v_text.alias("v_text"),
    )


def recital_number(c: Column) -> Column:
    return F.regexp_extract(c, r"\(([0-9]+)\)", 1)


def article_number(c: Column) -> Column:
    glued = F.regexp_replace(c, rf"(?U)(\d){SPACE}+(\d)", "$1$2")
    return F.regexp_extract(glued, rf"(?iU)Article{SPACE}+(\d+)", 1)


def annex_heading(c: Column) -> Column:
    """Number and title of 'ANNEX IV Rest of the line', anywhere in the text."""
    pattern = rf"(?isU)ANNEX{SPACE}+([IVXLCDM]+)(.*)$"
    return F.struct(
        F.regexp_extract(c, pattern, 1).alias("number"),
        strip(F.regexp_extract(c, pattern, 2)).alias("title"),
    )


PLAIN_ARTICLE = rf"(?iU)^Article{SPACE}+(\d+)"
PLAIN_ANNEX = rf"(?iU)^ANNEX{SPACE}*([IVXLCDM0-9]*)(.*)"


def annex_heading_plain(c: Column) -> Column:
    return F.struct(
        F.regexp_extract(c, PLAIN_ANNEX, 1).alias("number"),
        strip(F.regexp_extract(c, PLAIN_ANNEX, 2)).alias("title"),
    )


def section_key(c: Column) -> Column:
    """Kind and number of a section id; NULL for any other id.
    'rct_' is a prefix, the other two are whole-id patterns."""
    kind = (
        F.when(F.startswith(c, F.lit("rct_")), "recital")
        .when(c.rlike(r"^art_[0-9]+[a-z]*$"), "article")
        .when(c.rlike(r"^anx_[IVXLCDMivxlcdm0-9]+$"), "annex")
    )
    return F.when(
        kind.isNotNull(),
        F.struct(kind.alias("kind"), F.substring(c, 5, 1 << 30).alias("number")),
    )


def label_in_language(c: Column, tag: str = "en") -> Column:
    """Language range test of a label: the tag itself or one of its regions."""
    low = F.lower(c)
    return (low == tag) | F.startswith(low, F.lit(tag + "-"))


def expression_in_language(c: Column, suffix: str = "ENG") -> Column:
    return F.endswith(c, F.lit(suffix))
