"""Identifiers: document ids, consolidated ids, procedure numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexspark.functions.text import strip

# Identifier patterns and type codes.
CELEX = r"^[0-9CE][0-9]{4}[A-Z]{1,3}[0-9]{4,6}[A-Z]{0,3}[_\-]?[0-9]{0,9}$"
CONSOLIDATED = r"^(0)(\d{4}[RLD]\d{4})(-\d{8}$)"
PROCEDURE = r"^[0-9]{4}/[0-9]{4}(\([a-zA-Z]{3}\)|/[a-zA-Z]{3})$"
CORRIGENDUM = r"\([0-9]{2}\)$"
TYPE_NAMES = {
    "L": "directive",
    "R": "regulation",
    "D": "decision",
    "PC": "proposal",
    "DC": "other preparatory document",
}
RESOURCE_BASE = "http://publications.europa.eu/resource/celex/"


def normalize_celex(c: Column) -> Column:
    return F.upper(strip(c))


def is_valid_celex(c: Column) -> Column:
    return c.rlike(CELEX)


def is_consolidated(c: Column) -> Column:
    return c.rlike(CONSOLIDATED)


def original_celex(c: Column) -> Column:
    """Id of the original act of a consolidated text; any other id as it is."""
    return F.when(
        is_consolidated(c), F.concat(F.lit("3"), F.regexp_extract(c, CONSOLIDATED, 2))
    ).otherwise(c)


def normalize_procedure(c: Column) -> Column:
    return F.replace(F.replace(F.upper(strip(c)), F.lit("("), F.lit("/")), F.lit(")"), F.lit(""))


def is_valid_procedure(c: Column) -> Column:
    """Tested on the number as given, so padded input is rejected."""
    return c.rlike(PROCEDURE)


def is_corrigendum(c: Column) -> Column:
    return c.rlike(CORRIGENDUM)


def document_type(c: Column) -> Column:
    code = F.regexp_replace(F.substring(c, 6, 2), "[0-9]+$", "")
    names = F.create_map(*[F.lit(x) for pair in TYPE_NAMES.items() for x in pair])
    name = F.try_element_at(names, code)
    return (
        F.when(name.isNull() | (F.length(c) == 0), F.lit("Unknown"))
        .when(F.substring(c, 1, 1) == "0", F.concat(F.lit("consolidated "), name))
        .otherwise(name)
    )


def percent_encode(c: Column) -> Column:
    """Encode every reserved character; url_encode differs in three places."""
    out = F.replace(F.url_encode(c), F.lit("+"), F.lit("%20"))
    out = F.replace(out, F.lit("*"), F.lit("%2A"))
    return F.replace(out, F.lit("%7E"), F.lit("~"))


def resource_url(c: Column, base: str = RESOURCE_BASE) -> Column:
    """Address of a document; NULL when the normalised id is not valid."""
    n = normalize_celex(c)
    return F.when(is_valid_celex(n), F.concat(F.lit(base), percent_encode(n)))
