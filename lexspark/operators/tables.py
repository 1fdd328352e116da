"""Checks, counts, the dataset profile and the sinks of the three tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexspark.model import RELATIONS, TEXT_UNITS, WORKS
from lexspark.operators.filters import project_works
from lexspark.operators.graph import concept_counts
from lexspark.operators.scale import number_rows
from lexspark.operators.sequence import preview_concepts, preview_ids
from lexspark.spec import DiscoverSpec, JobSpec, OutputSpec


def orphans(child: DataFrame, works: DataFrame, column: str = "celex_id") -> DataFrame:
    """Child rows without a parent work."""
    parents = works.select(F.col("celex_id").alias(column)).distinct()
    return child.join(parents, column, "left_anti")


def table_counts(works: DataFrame, units: DataFrame, relations: DataFrame) -> DataFrame:
    """One row per table: (table_name, n_rows)."""
    out = None
    for name, df in (("works", works), ("text_units", units), ("relations", relations)):
        row = df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        out = row if out is None else out.unionByName(row)
    return out


def dataset_stats(works: DataFrame, units: DataFrame, relations: DataFrame) -> DataFrame:
    """One row: the three counts and the averages per work (0 without works)."""
    n = table_counts(works, units, relations).agg(*[
        F.max(F.when(F.col("table_name") == t, F.col("n_rows"))).alias(f"n_{t}")
        for t in ("works", "text_units", "relations")
    ])
    average = lambda c: F.when(F.col("n_works") > 0, F.col(c) / F.col("n_works")).otherwise(F.lit(0.0))
    return n.select(
        "*", average("n_text_units").alias("avg_text_units"), average("n_relations").alias("avg_relations")
    )


def outcome_counts(df: DataFrame, column: str = "status") -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def constraint_violations(
    df: DataFrame, table: str, unique: Sequence[str] = (), not_null: Sequence[str] = ()
) -> DataFrame:
    """Rows (table_name, rule, column_name, n_violations) for every rule."""
    nulls = df.agg(*[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in not_null]) if not_null else None
    out = None
    if nulls is not None:
        pairs = F.array(*[
            F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n_violations")) for c in not_null
        ])
        out = nulls.select(F.inline(pairs)).select(
            F.lit(table).alias("table_name"), F.lit("not_null").alias("rule"), "column_name", "n_violations"
        )
    for c in unique:
        repeated = df.filter(F.col(c).isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        row = repeated.agg(F.count(F.lit(1)).alias("n_violations")).select(
            F.lit(table).alias("table_name"), F.lit("unique").alias("rule"),
            F.lit(c).alias("column_name"), "n_violations",
        )
        out = row if out is None else out.unionByName(row)
    return out


TABLE_RULES = {
    "works": {"unique": ["celex_id"], "not_null": ["celex_id", "document_type", "title", "language"]},
    "text_units": {"unique": ["id"], "not_null": ["type", "number", "text", "celex_id"]},
    "relations": {"unique": ["id"], "not_null": ["celex_source", "celex_target", "relation_type"]},
}


def check_constraints(tables: Mapping[str, DataFrame]) -> DataFrame:
    out = None
    for name, df in tables.items():
        rows = constraint_violations(df, name, **TABLE_RULES[name])
        out = rows if out is None else out.unionByName(rows)
    return out


def dataset_profile(
    tables: Mapping[str, DataFrame], spec: JobSpec, ids: DataFrame | None = None,
    concepts: DataFrame | None = None,
) -> DataFrame:
    """The content of a dataset report as rows (section, item, value)."""
    spark = tables["works"].sparkSession
    yes = lambda flag: "yes" if flag else "no"
    m, x, r, o = spec.metadata, spec.extraction, spec.relations, spec.output
    rows = [
        ("metadata", "project_name", m.project_name),
        ("metadata", "description", m.description),
        ("metadata", "date_created", m.date_created.isoformat()),
        ("metadata", "version", m.version),
        ("selection", "mode", spec.mode),
        ("extraction", "recitals", yes(x.include_recitals)),
        ("extraction", "articles", yes(x.include_articles)),
        ("extraction", "annexes", yes(x.include_annexes)),
        ("relations", "include_relations", yes(r.include_relations)),
        ("output", "formats", ", ".join(sorted(o.formats))),
        ("output", "include_raw_full_text", yes(o.include_raw_full_text)),
    ]
    if m.author:
        rows.append(("metadata", "author", m.author))
    if r.include_relations:
        rows.append(("relations", "include_original_act_relations", yes(r.include_original_act_relations)))
    if isinstance(spec.data, DiscoverSpec):
        d = spec.data
        rows += [
            ("selection", "document_types", ", ".join(sorted(d.document_types))),
            ("selection", "start_date", d.start_date.isoformat()),
            ("selection", "end_date", d.end_date.isoformat()),
            ("selection", "keywords", ", ".join(sorted(d.filter_keywords))),
            ("selection", "corrigenda", yes(d.include_corrigenda)),
            ("selection", "consolidated_texts", yes(d.include_consolidated_texts)),
            ("selection", "national_transpositions", yes(d.include_national_transpositions)),
        ]
    out = spark.createDataFrame(rows, "section string, item string, value string")

    stats = dataset_stats(tables["works"], tables["text_units"], tables["relations"])
    shown = lambda c: F.format_string("%.2f", F.col(c)) if c.startswith("avg") else F.col(c).cast("string")
    pairs = F.array(*[F.struct(F.lit(c).alias("item"), shown(c).alias("value")) for c in stats.columns])
    out = out.unionByName(stats.select(F.inline(pairs)).select(F.lit("statistics").alias("section"), "item", "value"))
    if ids is not None:
        first = preview_ids(ids)
        out = out.unionByName(first.select(
            F.lit("documents").alias("section"), F.col("celex_id").alias("item"),
            F.col("n_more").cast("string").alias("value"),
        ))
    if concepts is not None:
        out = out.unionByName(preview_concepts(concepts).select(
            F.lit("concepts").alias("section"), F.concat_ws(" | ", "keyword", "label").alias("item"),
            F.col("uri").alias("value"),
        )).unionByName(concept_counts(concepts).select(
            F.lit("concept_counts").alias("section"), F.col("keyword").alias("item"),
            F.col("n_concepts").cast("string").alias("value"),
        ))
    return out


def with_ids(df: DataFrame, order: Sequence[str]) -> DataFrame:
    return number_rows(df, order, "id")


def write_table(df: DataFrame, path: str, fmt: str, mode: str = "errorifexists") -> None:
    writer = df.write.mode(mode)
    if fmt == "csv":
        writer.option("header", True).option("quote", '"').option("escape", '"').csv(path)
    elif fmt == "parquet":
        writer.option("compression", "snappy").parquet(path)
    else:
        raise ValueError(f"unknown format: {fmt}")


def read_table(spark, path: str, fmt: str, schema=None) -> DataFrame:
    reader = spark.read.schema(schema) if schema is not None else spark.read
    if fmt == "csv":
        return (
            reader.option("header", True).option("quote", '"').option("escape", '"')
            .option("multiLine", True).csv(path)
        )
    return reader.parquet(path)


def append(df: DataFrame, path: str) -> None:
    """Append rows to a stored table; no rows leave it as it is."""
    df.write.mode("append").option("compression", "snappy").parquet(path)


SCHEMAS = {"works": WORKS, "text_units": TEXT_UNITS, "relations": RELATIONS}


EXPORTED = ("works", "text_units", "relations")


def export_dataset(tables: Mapping[str, DataFrame], path: str, spec: OutputSpec = OutputSpec()) -> list[str]:
    """Write the three tables in every wanted format; raw bodies on request only.

    Each table is built once: the first format is written from the plan, the others from what was written (Parquet
    first, so that no value goes through text). The manifest comes last; ``exported`` reads nothing without it, so an
    export that was cut short shows no table."""
    base = path.rstrip("/")
    formats = sorted(spec.formats, key=lambda f: (f != "parquet", f))
    if formats[0] != "parquet":
        formats = ["parquet", *formats]  # staged only
    folder = lambda fmt, name: f"{base}/{fmt if fmt in spec.formats else '_staged'}/{name}"
    rows = []
    for name in EXPORTED:
        df = project_works(tables[name], spec.include_raw_full_text) if name == "works" else tables[name]
        for fmt in formats:
            write_table(df, folder(fmt, name), fmt)
            if fmt == "parquet":
                df = read_table(df.sparkSession, folder(fmt, name), fmt, df.schema)
            if fmt in spec.formats:
                rows.append((name, fmt, folder(fmt, name)))
    spark = tables["works"].sparkSession
    spark.createDataFrame(rows, "table_name string, format string, path string").coalesce(1).write.json(f"{base}/_manifest")
    return [folder(fmt, name) for fmt in sorted(spec.formats) for name in EXPORTED]


def exported(spark, path: str, name: str, fmt: str) -> DataFrame:
    """A table of a finished export; an error if the export did not come to its end."""
    try:
        listed = spark.read.schema("table_name string, format string, path string").json(f"{path.rstrip('/')}/_manifest")
        found = listed.filter((F.col("table_name") == name) & (F.col("format") == fmt)).collect()  # a row per file set
    except AnalysisException:
        found = []
    if not found:
        raise ValueError(f"no finished export of {name} as {fmt} at {path}")
    return read_table(spark, found[0]["path"], fmt)
