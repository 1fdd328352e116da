"""Row filters of the document selection."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexspark.functions.ids import is_corrigendum, is_valid_celex, is_valid_procedure, normalize_celex
from lexspark.functions.text import label_in_language
from lexspark.model import P_IN_SCHEME, UNIT_TYPES
from lexspark.operators.scale import broadcast_if_small, materialize


def between_exclusive(
    df: DataFrame, col: str, start: date | None = None, end: date | None = None
) -> DataFrame:
    """Both bounds are left out of the range; a missing bound does not filter."""
    if start is not None:
        df = df.filter(F.col(col) > F.lit(start))
    if end is not None:
        df = df.filter(F.col(col) < F.lit(end))
    return df


def type_filter(df: DataFrame, codes: Sequence[str], col: str = "type") -> DataFrame:
    """No filter at all when no code is chosen."""
    return df.filter(F.col(col).isin(*codes)) if codes else df


def sectors(proposals: bool = False, consolidated: bool = False, transpositions: bool = False) -> list[str]:
    out = ["3"]
    if proposals:
        out.append("5")
    if consolidated:
        out.append("0")
    if transpositions:
        out.append("7")
    return out


def sector_filter(df: DataFrame, col: str = "sector", **flags: bool) -> DataFrame:
    return df.filter(F.col(col).isin(*sectors(**flags)))


def corrigenda_filter(df: DataFrame, include: bool = False, col: str = "celex_id") -> DataFrame:
    return df if include else df.filter(~is_corrigendum(F.col(col)))


def concept_filter(
    df: DataFrame, tags: DataFrame, uris: DataFrame | Sequence[str] | None, key: str = "celex_id"
) -> DataFrame:
    """Keep rows tagged with at least one concept. ``uris`` is a list, or a
    table with a ``uri`` column; none, or an empty list or table, does not
    filter."""
    if uris is None:
        return df
    if not isinstance(uris, DataFrame):
        uris = df.sparkSession.createDataFrame([(u,) for u in set(uris)], "uri string")
    # written once: the match behind it is asked three times
    wanted = materialize(uris.select("uri").filter("uri is not null").distinct())
    if wanted.isEmpty():
        return df
    picked = tags.join(broadcast_if_small(wanted), "uri", "left_semi")
    # one row per key before the join: a popular concept does not travel
    return df.join(picked.select(key).distinct(), key, "left_semi")


def in_scheme(concepts: DataFrame, triples: DataFrame, scheme: str, key: str = "s") -> DataFrame:
    members = triples.filter((F.col("p") == P_IN_SCHEME) & (F.col("o") == scheme))
    return concepts.join(members.select(F.col("s").alias(key)).distinct(), key, "left_semi")


def language_filter(df: DataFrame, col: str = "lang", tag: str = "en") -> DataFrame:
    return df.filter(label_in_language(F.col(col), tag))


def drop_empty(df: DataFrame, col: str) -> DataFrame:
    return df.filter(F.length(col) > 0)


def select_unit_types(units: DataFrame, types: Sequence[str]) -> DataFrame:
    keep = [t for t in UNIT_TYPES if t in types]
    return units.filter(F.col("type").isin(*keep)) if keep else units.filter(F.lit(False))


def project_works(works: DataFrame, include_raw: bool = False) -> DataFrame:
    cols = ["celex_id", "document_type", "title", "date_adopted", "language"]
    return works.select(*cols, *(["full_text_html"] if include_raw else []))


def split_by(df: DataFrame, error: Column) -> tuple[DataFrame, DataFrame]:
    """Rows without and with an error text: (good, bad)."""
    marked = df.withColumn("_error", error)
    return marked.filter("_error IS NULL").drop("_error"), marked.filter("_error IS NOT NULL")


def invalid_ids(ids: DataFrame, procedures: DataFrame) -> DataFrame:
    """All malformed entries of a selection list, as rows (entry_kind, value).
    Ids are tested after normalisation, procedure numbers as given."""
    norm = normalize_celex(F.col("celex_id"))
    bad_ids = ids.filter(~is_valid_celex(norm)).select(F.lit("id").alias("entry_kind"), norm.alias("value"))
    bad_numbers = procedures.filter(~is_valid_procedure(F.col("procedure"))).select(
        F.lit("procedure").alias("entry_kind"), F.col("procedure").alias("value")
    )
    return bad_ids.unionByName(bad_numbers).distinct()
