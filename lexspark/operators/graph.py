"""Graph facts: pattern matching, relation hops, keyword concepts, procedures."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexspark.functions.ids import is_consolidated, original_celex
from lexspark.functions.text import expression_in_language
from lexspark.model import (
    P_CELEX, P_DATE, P_EXPRESSION_OF, P_LANGUAGE, P_REFERENCE, P_SECTOR, P_TITLE, P_TYPE, RELATION_PREDICATES,
)
from lexspark.operators.scale import may_have_key, salted_join


def match_pattern(triples: DataFrame, pattern: Sequence[tuple[str, str]]) -> DataFrame:
    """Subjects that have every predicate of the pattern, one column per value.
    Each branch reads only its own predicate (pushed to the scan); all joins
    share the subject, so each branch is shuffled once."""
    out = None
    for predicate, alias in pattern:
        branch = triples.filter(F.col("p") == predicate).select("s", F.col("o").alias(alias))
        out = branch if out is None else out.join(branch, "s")
    return out.distinct()


def relation_edges(
    triples: DataFrame, predicates: Mapping[str, str] = RELATION_PREDICATES
) -> DataFrame:
    """work --p--> other work, for all predicates in one scan."""
    names = F.create_map(*[F.lit(x) for pair in predicates.items() for x in pair])
    return triples.filter(F.col("p").isin(*predicates)).select(
        "s", names[F.col("p")].alias("relation_type"), F.col("o").alias("target")
    )


def star_facts(triples: DataFrame, language: str = "ENG") -> DataFrame:
    """The facts of every subject in one row, by one pass and one shuffle that
    combines first: no join per predicate. Columns s, celex_id, type, sector,
    title, work, spoken, and the lists dates and refs. Of several values of a
    single-valued fact the greatest counts, so a re-run agrees."""
    p, o = F.col("p"), F.col("o")
    given = lambda name: F.when(p == name, o)
    single = {"celex_id": P_CELEX, "type": P_TYPE, "sector": P_SECTOR, "title": P_TITLE, "work": P_EXPRESSION_OF}
    wanted = [*single.values(), P_DATE, P_REFERENCE, P_LANGUAGE]
    spoken = (p == P_LANGUAGE) & expression_in_language(o, language)
    return triples.filter(p.isin(*wanted)).groupBy("s").agg(
        *[F.max(given(name)).alias(alias) for alias, name in single.items()],
        F.array_sort(F.collect_set(F.try_to_date(given(P_DATE), "yyyy-MM-dd"))).alias("dates"),
        F.array_sort(F.collect_set(given(P_REFERENCE))).alias("refs"),
        F.bool_or(spoken).alias("spoken"),
    )


def relation_hop(
    triples: DataFrame, predicates: Mapping[str, str] = RELATION_PREDICATES
) -> DataFrame:
    """work --p--> other work --id--> document id. A work has one id, so a
    much-cited work only makes a large partition on the edge side, which
    adaptive execution splits."""
    ids = triples.filter(F.col("p") == P_CELEX).select(
        F.col("s").alias("target"), F.col("o").alias("value")
    )
    edges = relation_edges(triples, predicates)
    return edges.join(ids, "target").select("s", "relation_type", "value").distinct()


def all_properties(triples: DataFrame, language: str = "ENG") -> DataFrame:
    """Tagged union of title, date and the six relations of every work:
    rows (s, data_type, value), duplicates removed."""
    spoken = triples.filter(
        (F.col("p") == P_LANGUAGE) & expression_in_language(F.col("o"), language)
    ).select("s").distinct()
    titles = having_language(
        triples.filter(F.col("p") == P_TITLE).select("s", F.col("o").alias("value")), spoken, "s"
    )
    owners = triples.filter(F.col("p") == P_EXPRESSION_OF).select("s", F.col("o").alias("work"))
    title_rows = titles.join(owners, "s").select(
        F.col("work").alias("s"), F.lit("title").alias("data_type"), "value"
    )
    date_rows = triples.filter(F.col("p") == P_DATE).select(
        "s", F.lit("date").alias("data_type"), F.col("o").alias("value")
    )
    hops = relation_hop(triples).select("s", F.col("relation_type").alias("data_type"), "value")
    # the hops are distinct already, and no tag of theirs is title or date
    return title_rows.unionByName(date_rows).distinct().unionByName(hops)


def having_language(df: DataFrame, expressions: DataFrame, key: str) -> DataFrame:
    """Rows whose key has an expression in the wanted language."""
    return df.join(expressions.select(key), key, "left_semi")


GRAM = 3


def _grams(text: Column, sizes: Sequence[int]) -> Column:
    """The distinct grams of a text, of several lengths; the one of length 0 is in every text."""
    cut = lambda n: F.when(F.length(text) >= n, F.transform(
        F.sequence(F.lit(1), F.length(text) - n + 1), lambda i: F.substring(text, i, F.lit(n))
    )).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.flatten(F.array(*[cut(n) if n else F.array(F.lit("")) for n in sizes])))


def needle_index(needles: DataFrame, folded: Column) -> DataFrame:
    """(_needle, _folded, _gram): every needle under that of its grams that the fewest needles have, so that no key
    collects the needles of a common ending. Needles shorter than a gram stand under themselves."""
    size = F.least(F.length("_folded"), F.lit(GRAM))
    own = F.transform(
        F.sequence(F.lit(1), F.greatest(F.length("_folded") - size + 1, F.lit(1))), lambda i: F.substring(F.col("_folded"), i, size)
    )
    grams = needles.withColumn("_folded", folded).withColumn("_gram", F.explode(F.array_distinct(own)))
    held = grams.groupBy("_gram").agg(F.count(F.lit(1)).alias("_held"))
    return grams.join(held, "_gram").groupBy("_needle", "_folded").agg(F.min_by("_gram", F.struct("_held", "_gram")).alias("_gram"))


def contains_join(
    df: DataFrame, text: str, needles: Sequence[str] | DataFrame, name: str, ignore_case: bool = False
) -> DataFrame:
    """One row per (row of df, needle contained in its text); none for a NULL
    text. ``needles`` is a list or a table of one column, of any size.

    A gram index: every needle stands under one of its grams, a text meets the
    needles of its own grams by an equi-join, and the text is searched for these
    needles only. Grams that no needle stands under are dropped in the task that
    reads the text. Case is folded by Spark on both sides."""
    fold = F.lower if ignore_case else (lambda c: c)
    if isinstance(needles, DataFrame):
        table = needles.select(F.col(needles.columns[0]).alias("_needle")).filter("_needle is not null").distinct()
        sizes = [*range(GRAM + 1)]
    else:
        table = df.sparkSession.createDataFrame([(n,) for n in sorted(set(needles))], "_needle string")
        # folding may lengthen a needle, so all lengths from the shortest on
        sizes = [*range(min((len(n) for n in needles), default=GRAM), GRAM + 1)] or [GRAM]
    index = needle_index(table, fold(F.col("_needle")))
    texts = df.withColumn("_text", fold(F.col(text)))
    met = texts.withColumn("_gram", F.explode(F.when(F.col("_text").isNotNull(), _grams(F.col("_text"), sizes))))
    hits = may_have_key(met, index.select("_gram")).join(index, "_gram").filter(F.contains("_text", F.col("_folded")))
    return hits.select(*df.columns, F.col("_needle").alias(name))


def match_keywords(labels: DataFrame, keywords: Sequence[str], label: str = "label") -> DataFrame:
    """Labels that contain a keyword, whatever the case."""
    return contains_join(labels, label, keywords, "keyword", ignore_case=True)


def with_original(df: DataFrame, other: DataFrame, key: str = "celex_id") -> DataFrame:
    """Left join of ``other`` (unique on ``key``) on the id of the original act;
    a document that is not consolidated is its own original."""
    right = other.withColumnRenamed(key, "original_id")
    return df.withColumn("original_id", original_celex(F.col(key))).join(right, "original_id", "left")


def original_relations(relations: DataFrame, works: DataFrame) -> DataFrame:
    """The relations of the original act once for every consolidated text, named
    by ``_version``. The rows keep the original's id as source."""
    versions = works.filter(is_consolidated(F.col("celex_id"))).select(
        original_celex(F.col("celex_id")).alias("celex_source"), F.col("celex_id").alias("_version")
    )
    return salted_join(versions, relations, "celex_source", ["_version"]).select(*relations.columns, "_version")


def relations_with_original(relations: DataFrame, works: DataFrame) -> DataFrame:
    """The relations and those of the original acts added once for every
    consolidated text; duplicates stay."""
    return relations.unionByName(original_relations(relations, works).drop("_version"))


def with_acts(proposals: DataFrame, adopts: DataFrame) -> DataFrame:
    """Optional join: each proposal with every act that adopts it, or with an
    empty ``work`` when there is none."""
    acts = adopts.select("proposal", "work").distinct()
    return proposals.join(acts, "proposal", "left").withColumn("work", F.coalesce("work", F.lit("")))


def resolve_procedures(
    dossiers: DataFrame, adopts: DataFrame, procedures: Sequence[str]
) -> DataFrame:
    """Documents of procedure numbers: the adopted act when there is one, else
    the proposal. ``dossiers``: (ref, proposal); ``adopts``: (work, proposal).
    Decided per binding, so a proposal with one act gives the act only."""
    proposals = dossiers.filter(
        F.contains("proposal", F.lit("PC")) & ~F.contains("proposal", F.lit("("))
    )
    matched = contains_join(proposals, "ref", procedures, "procedure").select("procedure", "proposal").distinct()
    bound = with_acts(matched, adopts)
    return (
        bound.select(
            F.when(F.col("work") != "", F.col("work")).otherwise(F.col("proposal")).alias("celex_id")
        )
        .filter(F.length("celex_id") > 0)
        .distinct()
    )


def label_sets(matches: DataFrame) -> DataFrame:
    """Labels of each (keyword, concept), as a sorted set."""
    return (
        matches.groupBy("keyword", "uri")
        .agg(F.array_sort(F.collect_set("label")).alias("labels"))
    )


def merge_labels(preferred: DataFrame, alternative: DataFrame) -> DataFrame:
    """Union of two label tables per (keyword, concept); keys on one side stay."""
    cols = ["keyword", "uri", "label"]
    return label_sets(preferred.select(*cols).unionByName(alternative.select(*cols)))


def label_map(matches: DataFrame, parts: int = 1) -> DataFrame:
    """Map concept -> labels per keyword; with ``parts`` above 1 over so many
    rows per keyword (``part`` = hash of the concept), whatever their number."""
    entry = F.struct(F.col("uri").alias("k"), F.col("labels").alias("v"))
    part = F.pmod(F.xxhash64("uri"), F.lit(parts)).cast("int").alias("part")
    return label_sets(matches).groupBy("keyword", part).agg(
        F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("concepts")
    )


def relation_map(relations: DataFrame, span: int | None = None) -> DataFrame:
    """Map type -> list of targets per work, in ``pos`` order. With ``span``
    a row holds the targets of one range of that many positions (``part`` 0,
    1, ...), so the parts follow each other; without it a work is one row."""
    part = F.lit(0) if span is None else F.floor(F.col("pos") / F.lit(span)).cast("int")
    keys = ["celex_source", "relation_type", part.alias("part")]
    lists = relations.groupBy(*keys).agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("pos", "celex_target"))),
            lambda x: x["celex_target"],
        ).alias("targets")
    )
    return lists.groupBy("celex_source", "part").agg(
        F.map_from_entries(
            F.array_sort(F.collect_list(F.struct("relation_type", "targets")))
        ).alias("relations")
    )


def pivot_properties(properties: DataFrame, key: str = "celex_id") -> DataFrame:
    """Single-valued properties of each document: rows (key, data_type, value,
    pos) to (key, title, date). The binding with the highest pos wins."""
    last = lambda name: F.max_by(
        F.when(F.col("data_type") == name, F.col("value")),
        F.when(F.col("data_type") == name, F.struct("pos", "value")),
    )
    return (
        properties.filter(F.col("data_type").isin("title", "date"))
        .groupBy(key)
        .agg(last("title").alias("title"), last("date").alias("date"))
    )


def property_bag(properties: DataFrame, key: str = "celex_id") -> tuple[DataFrame, DataFrame]:
    """The two halves of a property bag: (single values, relation rows). The
    relation half stays in rows; relation_map nests it when a map is wanted."""
    relations = properties.filter(F.col("data_type").isin(*RELATION_PREDICATES.values())).select(
        F.col(key).alias("celex_source"), F.col("value").alias("celex_target"),
        F.col("data_type").alias("relation_type"), "pos",
    )
    return pivot_properties(properties, key), relations


def concept_counts(matches: DataFrame) -> DataFrame:
    """Concepts per keyword."""
    return matches.select("keyword", "uri").distinct().groupBy("keyword").agg(F.count(F.lit(1)).alias("n_concepts"))


def unique_concepts(matches: DataFrame) -> DataFrame:
    """One row: ``n_unique``, the concepts of all keywords together."""
    return matches.agg(F.count_distinct("uri").alias("n_unique"))


def order_labels(matches: DataFrame) -> DataFrame:
    return matches.orderBy("keyword", "label", "uri")
