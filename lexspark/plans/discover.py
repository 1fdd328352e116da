"""Selection of documents: listed, or discovered by their properties."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexspark.model import P_CELEX, P_DATE, P_SECTOR, P_TYPE
from lexspark.operators import filters as X
from lexspark.operators.graph import match_keywords, match_pattern, resolve_procedures
from lexspark.operators.sets import apply_review, union_ids
from lexspark.sources.landed import inline
from lexspark.spec import DiscoverSpec, ListSpec


def properties_of(triples: DataFrame) -> DataFrame:
    """(s, date, type, celex_id, sector) from graph facts."""
    rows = match_pattern(
        triples, [(P_DATE, "date"), (P_TYPE, "type"), (P_CELEX, "celex_id"), (P_SECTOR, "sector")]
    )
    return rows.withColumn("date", F.try_to_date("date", "yyyy-MM-dd"))


def discover_works(
    props: DataFrame, spec: DiscoverSpec, tags: DataFrame | None = None, uris=None
) -> DataFrame:
    """Distinct ids that pass all filters of the spec. ``props``: celex_id,
    date, type, sector; ``tags``: celex_id, uri. The filters are plain
    predicates, so they reach the scan; the concept test is a semi join."""
    df = X.between_exclusive(props, "date", spec.start_date, spec.end_date)
    df = X.type_filter(df, spec.type_codes)
    df = X.sector_filter(
        df,
        proposals="proposal" in spec.document_types,
        consolidated=spec.include_consolidated_texts,
        transpositions=spec.include_national_transpositions,
    )
    df = X.corrigenda_filter(df, spec.include_corrigenda)
    if uris is not None:
        if tags is None:
            raise ValueError("a concept filter needs the tags of the works")
        df = X.concept_filter(df, tags, uris)
    return df.select("celex_id").distinct()


def keyword_concepts(
    labels: DataFrame | None, spec: DiscoverSpec, reviewed: DataFrame | None = None,
    language: str = "en", scheme: str | None = None,
) -> DataFrame | None:
    """Concept ids of the spec's keywords, after review; None without keywords.
    Only labels in the language count (columns uri, label, lang), and with a
    scheme only those of its concepts (column scheme)."""
    if not spec.filter_keywords:
        return None
    if labels is None:
        raise ValueError("filter_keywords need the labels of the concepts")
    labels = X.language_filter(labels, tag=language)
    if scheme is not None:
        labels = labels.filter(F.col("scheme").cast("string") == scheme)
    return apply_review(match_keywords(labels, sorted(spec.filter_keywords)), reviewed)


def listed_works(
    spark: SparkSession, spec: ListSpec, dossiers: DataFrame | None = None, adopts: DataFrame | None = None
) -> DataFrame:
    ids = inline(spark, sorted(spec.celex_ids), "celex_id")
    if not spec.procedure_numbers:
        return ids
    if dossiers is None or adopts is None:
        raise ValueError("procedure_numbers need the dossiers and the adopted acts")
    return union_ids(ids, resolve_procedures(dossiers, adopts, sorted(spec.procedure_numbers)))
