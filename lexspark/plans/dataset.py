"""From landed inputs to the three output tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexspark.functions.ids import document_type, is_consolidated, is_valid_celex, original_celex
from lexspark.functions.markup import flatten_wrappers
from lexspark.model import UNIT_TYPES
from lexspark.operators.choose import body_mark, marked_choices
from lexspark.operators.graph import original_relations
from lexspark.operators.resolve import (
    build_works, one_per_id, quarantine_reason, resolve_date, resolve_html, resolve_title,
)
from lexspark.operators.scale import by_key, hot_keys, materialize, may_have_key
from lexspark.operators.units import extract_units, type_bits, wants
from lexspark.plans.discover import discover_works, keyword_concepts, listed_works
from lexspark.spec import ExtractionSpec, JobSpec, ListSpec

BODY_KEYS = ["celex_id", "role", "fmt"]
UNIT_ORDER = {"recital": 0, "article": 1, "annex": 2}


def unit_sources(ids: DataFrame, manifestations: DataFrame, spec: ExtractionSpec = ExtractionSpec()) -> DataFrame:
    """Which body gives which unit types to which document. Narrow rows
    (celex_id, src_id, role, fmt, structure, want).

    * recitals of a consolidated text come from the original act,
    * annexes of a proposal come from the separate annex body,
    * the own body gives all that is not borrowed. Without an own body a
      document has no units at all.
    """
    return marked_sources(ids, manifestations, spec).drop("mark")


def marked_sources(ids: DataFrame, manifestations: DataFrame, spec: ExtractionSpec) -> DataFrame:
    """``unit_sources`` with the mark of the body that counts."""
    given = ids.select("celex_id").filter(is_valid_celex(F.col("celex_id")))
    valid = given.distinct()
    # only bodies of the ids and of their original acts are parsed and tested; for the map an id may come twice
    acts = given.select(original_celex(F.col("celex_id")).alias("celex_id"))
    bodies = may_have_key(manifestations.filter(is_valid_celex(F.col("celex_id"))), given.unionByName(acts))
    # narrow, and used three times: without this the bodies would be parsed for each use
    choices = materialize(marked_choices(bodies))
    main = choices.filter(F.col("role") == "main")
    own = valid.join(main.filter(F.col("own").isNotNull()).select("celex_id", "own"), "celex_id")
    original = main.filter(F.col("lent").isNotNull()).select(
        F.col("celex_id").alias("original_id"), F.col("lent").alias("original")
    )
    annex = choices.filter((F.col("role") == "annex") & F.col("lent").isNotNull()).select(
        "celex_id", F.col("lent").alias("annex")
    )
    bits = type_bits(spec.unit_types)
    recital, annex_bit = bits & 1, bits & 4
    own = own.withColumn(
        "original_id", F.when(is_consolidated(F.col("celex_id")), original_celex(F.col("celex_id")))
    )
    wide = own.join(original, "original_id", "left").join(
        annex.filter(document_type(F.col("celex_id")) == "proposal"), "celex_id", "left"
    )
    borrows = F.col("original").isNotNull() & F.lit(recital != 0)
    splits = F.col("annex").isNotNull() & F.lit(annex_bit != 0)
    take = lambda test, bit: F.when(test, F.lit(bit)).otherwise(F.lit(0))
    row = lambda src, role, body, want: F.struct(
        src.alias("src_id"), F.lit(role).alias("role"), body["fmt"].alias("fmt"),
        body["structure"].alias("structure"), body["mark"].alias("mark"), want.cast("int").alias("want"),
    )
    sources = F.array(
        row(F.col("celex_id"), "main", F.col("own"), F.lit(bits) - take(borrows, recital) - take(splits, annex_bit)),
        row(F.col("original_id"), "main", F.col("original"), take(borrows, recital)),
        row(F.col("celex_id"), "annex", F.col("annex"), take(splits, annex_bit)),
    )
    return wide.select("celex_id", F.inline(sources)).filter(
        (F.col("want") != 0) & F.col("structure").isNotNull()
    )


def build_text_units(
    ids: DataFrame, manifestations: DataFrame, spec: ExtractionSpec = ExtractionSpec()
) -> DataFrame:
    """Rows (celex_id, type, number, title, text, type_rank, pos), ordered in a
    document by (type_rank, pos).

    The narrow source rows (written once) say which body gives which unit types
    to which document. Together they make one job per body: the types that any
    document takes from it. A body is pruned by key where it is read, shuffled
    once and cut once, and its units go to all their documents by a join that
    keeps the partitioning. An act with very many versions is dealt over salts,
    so its body is repeated a few times before the shuffle, and no other is.
    """
    sources = materialize(marked_sources(ids, manifestations, spec))
    route = sources.withColumnsRenamed({"celex_id": "doc_id", "src_id": "celex_id"})
    hot = hot_keys(route, BODY_KEYS)
    salts = F.coalesce("_salts", F.lit(1))
    route = route.join(hot, BODY_KEYS, "left").withColumn("_salt", F.pmod(F.xxhash64("doc_id"), salts).cast("int"))
    keys = [*BODY_KEYS, "_salt"]
    jobs = route.groupBy(*keys).agg(
        F.min("structure").alias("structure"), F.min("mark").alias("mark"), F.bit_or("want").alias("want")
    )
    bodies = may_have_key(manifestations.select(*BODY_KEYS, "body"), jobs.select(*BODY_KEYS))
    bodies = bodies.join(hot, BODY_KEYS, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("_salts")
    docs = by_key(bodies, keys).join(by_key(jobs, keys), keys).filter(body_mark(F.col("body")) == F.col("mark"))
    docs = docs.drop("mark").dropDuplicates(keys).withColumn("html", flatten_wrappers(F.col("body")))
    units = extract_units(docs, keys, "html", partitioned=True, unique=True).drop("structure", "want")
    units = units.join(by_key(route.select(*keys, "doc_id", "want"), keys), keys)
    given = F.lit(False)
    for kind in UNIT_TYPES:
        given = given | ((F.col("type") == kind) & wants(F.col("want"), kind))
    rank = F.array_position(F.array(*[F.lit(t) for t in UNIT_TYPES]), F.col("type")) - 1
    return units.filter(given).select(
        F.col("doc_id").alias("celex_id"), "type", "number", "title", "text", rank.cast("int").alias("type_rank"), "pos"
    )


@dataclass(frozen=True)
class Inputs:
    """Landed tables. Only ``manifestations`` and ``properties`` are needed;
    ``properties``: celex_id, title, date, type, sector; ``labels``: uri, label,
    lang, and scheme when ``scheme`` limits keywords to one. An input that the
    job asks for and that is missing is an error."""

    manifestations: DataFrame
    properties: DataFrame
    relations: DataFrame | None = None
    notices: DataFrame | None = None
    tags: DataFrame | None = None
    labels: DataFrame | None = None
    reviewed: DataFrame | None = None
    dossiers: DataFrame | None = None
    adopts: DataFrame | None = None
    scheme: str | None = None


def select_ids(inputs: Inputs, spec: JobSpec) -> DataFrame:
    if isinstance(spec.data, ListSpec):
        return listed_works(inputs.properties.sparkSession, spec.data, inputs.dossiers, inputs.adopts)
    uris = keyword_concepts(inputs.labels, spec.data, inputs.reviewed, scheme=inputs.scheme)
    return discover_works(inputs.properties, spec.data, inputs.tags, uris)


def build_dataset(inputs: Inputs, spec: JobSpec, ids: DataFrame | None = None) -> dict[str, DataFrame]:
    """The tables works, text_units and relations (without row ids). Narrow
    steps run here already (titles, body choices); the tables are lazy."""
    ids = select_ids(inputs, spec) if ids is None else ids
    notices = inputs.notices
    if notices is None:
        notices = inputs.properties.sparkSession.createDataFrame(
            [], "celex_id string, notice_title string, notice_date date"
        )
    # written once: titles and dates both read them, and notices are parsed for it
    graph = materialize(one_per_id(inputs.properties, "title", "date"))
    notices = materialize(one_per_id(notices, "notice_title", "notice_date"))
    # an id that is not valid (a corrigendum) has a work and relations, no body
    readable = inputs.manifestations.filter(is_valid_celex(F.col("celex_id")))
    # narrow, and used for the dates too: written once, pages are cut once for it and their shuffle is gone
    titles = materialize(resolve_title(ids, graph, notices, readable))
    dates = resolve_date(titles, graph, notices)
    bodies = resolve_html(readable, ids) if spec.output.include_raw_full_text else None
    tables = {
        "works": build_works(ids, titles, dates, bodies),
        "text_units": build_text_units(ids, readable, spec.extraction),
    }
    tables["relations"] = dataset_relations(ids, inputs.relations, spec)
    return tables


def checked_dataset(inputs: Inputs, spec: JobSpec, ids: DataFrame | None = None) -> dict[str, DataFrame]:
    """The build with an outcome for every selected document: one that is not fit for the final tables does not stop the
    run, and nothing of it gets in.

    Next to the three tables: ``outcomes`` (celex_id, status, reason; status is ``successful`` or ``failed``), one row
    per document, and ``rejected``, the works that failed with their reason. The ledger is narrow and written once; all
    tables are split by it. Relations go with the document that they are in the dataset for.
    """
    ids = materialize((select_ids(inputs, spec) if ids is None else ids).select("celex_id").distinct())
    tables = build_dataset(inputs, spec, ids)
    marked = quarantine_reason(tables["works"].drop("full_text_html")).select("celex_id", "reason")
    status = F.when(F.col("reason").isNull(), "successful").otherwise("failed")
    outcomes = materialize(marked.select("celex_id", status.alias("status"), "reason"))
    failed = outcomes.filter("status = 'failed'").select("celex_id", "reason")
    without = lambda df, key: df.join(failed.select(F.col("celex_id").alias(key)), key, "left_anti")
    relations = without(owned_relations(ids, inputs.relations, spec), "owner").drop("owner")
    return {
        "works": without(tables["works"], "celex_id").select(*tables["works"].columns),
        "text_units": without(tables["text_units"], "celex_id").select(*tables["text_units"].columns),
        "relations": relations,
        "rejected": tables["works"].join(failed, "celex_id"),
        "outcomes": outcomes,
    }


def dataset_relations(ids: DataFrame, relations: DataFrame | None, spec: JobSpec) -> DataFrame:
    return owned_relations(ids, relations, spec).drop("owner")


def owned_relations(ids: DataFrame, relations: DataFrame | None, spec: JobSpec) -> DataFrame:
    """The relation rows with ``owner``, the selected document that they are in
    the dataset for: the source itself, or the consolidated text that takes them
    over from its original act (the source stays the act)."""
    cols = ["celex_source", "celex_target", "relation_type"]
    if not spec.relations.include_relations or relations is None:
        return ids.sparkSession.createDataFrame([], ", ".join(f"{c} string" for c in [*cols, "owner"]))
    full = relations.select(*cols).filter(F.length("celex_target") > 0)
    sources = ids.select(F.col("celex_id").alias("celex_source")).distinct()
    own = full.join(sources, "celex_source", "left_semi").withColumn("owner", F.col("celex_source"))
    if not spec.relations.include_original_act_relations:
        return own
    # the original act's rows come from the full relation table: the act itself
    # need not be selected
    return own.unionByName(original_relations(full, ids).withColumnRenamed("_version", "owner"))
