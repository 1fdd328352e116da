"""From graph facts to the inputs of a build."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexspark.model import P_ALT_LABEL, P_CONCEPT, P_DOSSIER, P_IN_SCHEME, P_PREF_LABEL, RELATION_PREDICATES
from lexspark.operators.graph import relation_edges, star_facts
from lexspark.operators.scale import materialize
from lexspark.plans.dataset import Inputs


def inputs_from_graph(
    triples: DataFrame, manifestations: DataFrame, notices: DataFrame | None = None,
    language: str = "ENG", scheme: str | None = None,
) -> Inputs:
    """All inputs of a build but the bodies and notices, out of graph facts
    (s, p, o, and lang for labels).

    The facts of works, expressions and dossiers come from one fold (see
    ``star_facts``), which is narrow and written once; only edges are joined
    with it, and the relations made of them are written once too. ``properties`` has one row per document and date, since a search by
    date takes a work in by any of its dates; the build keeps the greatest value
    of each field. A work without a document id is left out, and so is an edge
    to one. Titles are those of expressions in the language.
    """
    star = materialize(star_facts(triples, language))
    works = star.filter("celex_id is not null")
    ids = works.select("s", "celex_id")
    spoken = star.filter("spoken and work is not null and title is not null")
    titles = spoken.groupBy(F.col("work").alias("s")).agg(F.max("title").alias("title"))
    properties = works.drop("title").join(titles, "s", "left").select(
        "celex_id", "title", F.explode_outer("dates").alias("date"), "type", "sector"
    ).distinct()

    def edges(predicate: str, name: str) -> DataFrame:
        """Edges of works, by document id."""
        rows = triples.filter(F.col("p") == predicate).select("s", F.col("o").alias(name))
        return rows.join(ids, "s").select("celex_id", name).distinct()

    # renamed alike, so that both joins read one shuffle of the ids
    targets = ids.withColumnsRenamed({"s": "target", "celex_id": "celex_target"})
    sources = ids.withColumnsRenamed({"s": "source", "celex_id": "celex_source"})
    # the type travels as a number. Rows come from the second join in order of their subject and are dealt out by it, so that
    # neighbours are alike and take little disk; equal rows meet. Written once: relations and adopts both read them
    kinds = F.array(*[F.lit(t) for t in RELATION_PREDICATES.values()])
    kind = F.array_position(kinds, F.col("relation_type")).cast("int").alias("_kind")
    coded = relation_edges(triples).select(F.col("s").alias("source"), kind, "target")
    pairs = coded.join(targets, "target").join(sources, "source").select("celex_source", "celex_target", "_kind")
    relations = materialize(pairs.repartition("celex_source").distinct().select(
        "celex_source", "celex_target", F.element_at(kinds, F.col("_kind")).alias("relation_type")
    ))
    refs = star.select(F.col("s").alias("dossier"), F.explode("refs").alias("ref"))
    return Inputs(
        manifestations=manifestations,
        properties=properties,
        relations=relations,
        notices=notices,
        tags=edges(P_CONCEPT, "uri"),
        labels=concept_labels(triples),
        dossiers=edges(P_DOSSIER, "dossier").join(refs, "dossier").select("ref", F.col("celex_id").alias("proposal")).distinct(),
        adopts=relations.filter("relation_type = 'adopts'").select(
            F.col("celex_source").alias("work"), F.col("celex_target").alias("proposal")
        ),
        scheme=scheme,
    )


def concept_labels(triples: DataFrame) -> DataFrame:
    """(uri, label, lang, scheme, kind) of concepts; without a column ``lang`` the language is unknown. A concept in
    several schemes has its labels in each."""
    lang = F.col("lang") if "lang" in triples.columns else F.lit(None).cast("string")
    kind = F.when(F.col("p") == P_PREF_LABEL, "pref").otherwise("alt")
    labels = triples.filter(F.col("p").isin(P_PREF_LABEL, P_ALT_LABEL)).select(
        F.col("s").alias("uri"), F.col("o").alias("label"), lang.alias("lang"), kind.alias("kind")
    )
    schemes = triples.filter(F.col("p") == P_IN_SCHEME).select(F.col("s").alias("uri"), F.col("o").alias("scheme"))
    return labels.join(schemes, "uri", "left").select("uri", "label", "lang", "scheme", "kind").distinct()
