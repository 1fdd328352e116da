"""Readers and decoders of landed inputs: bodies, query results, notices,
listings and inline value lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexspark import model
from lexspark.functions.markup import parses
from lexspark.functions.text import date_from_parts, decode_body, let, strip, unescape


def read_manifestations(spark: SparkSession, path: str) -> DataFrame:
    """Document bodies keyed by (id, role, format), as Parquet; the body may be
    text or bytes. A body that is not UTF-8 is NULL, so the next format counts."""
    rows = spark.read.schema(model.MANIFESTATIONS).parquet(path)
    return rows.withColumn("body", decode_body(F.col("body")))


def read_manifestation_files(spark: SparkSession, glob: str) -> DataFrame:
    """Document bodies as files named <id>.<role>.<format>, one body per file.
    The bytes are decoded strictly, file by file: a body that is not UTF-8 is
    NULL, so the next format of the document counts. An empty file has no row."""
    files = spark.read.format("binaryFile").load(glob)
    name = F.element_at(F.split("path", "/"), -1)
    field = lambda i: F.regexp_extract(name, r"^(.*)\.(main|annex)\.(xhtml|html)$", i)
    return files.filter(field(0) != "").select(
        field(1).alias("celex_id"), field(2).alias("role"), field(3).alias("fmt"),
        decode_body(F.col("content")).alias("body"),
    )


_TERM = T.StructType([
    T.StructField("type", T.StringType()),
    T.StructField("value", T.StringType()),
    T.StructField("datatype", T.StringType()),
    T.StructField("xml:lang", T.StringType()),
])
BINDINGS = T.StructType([
    T.StructField("results", T.StructType([
        T.StructField("bindings", T.ArrayType(T.MapType(T.StringType(), _TERM))),
    ])),
])


def read_bindings(
    df: DataFrame, json_col: str, variables: Sequence[str], keep: Sequence[str] = ()
) -> DataFrame:
    """One row per binding of a query-result document. A variable that a
    binding leaves out is NULL; ``pos`` is the place of the binding."""
    parsed = df.select(*keep, F.from_json(F.col(json_col), BINDINGS).alias("_doc"))
    rows = parsed.select(*keep, F.posexplode("_doc.results.bindings").alias("pos", "_b"))
    return rows.select(
        *keep, "pos", *[F.col("_b")[v]["value"].alias(v) for v in variables]
    )


def read_typed_bindings(
    df: DataFrame, json_col: str, variable: str, keep: Sequence[str] = ()
) -> DataFrame:
    """Like read_bindings for one variable, with its type, datatype and language."""
    parsed = df.select(*keep, F.from_json(F.col(json_col), BINDINGS).alias("_doc"))
    rows = parsed.select(*keep, F.posexplode("_doc.results.bindings").alias("pos", "_b"))
    term = F.col("_b")[variable]
    return rows.select(
        *keep, "pos", term["value"].alias("value"), term["type"].alias("kind"),
        term["datatype"].alias("datatype"), term["xml:lang"].alias("lang"),
    )


def drop_incomplete(df: DataFrame, variables: Sequence[str]) -> DataFrame:
    return df.dropna(how="any", subset=list(variables))


_NOTICE = (
    "EXPRESSION array<struct<EXPRESSION_TITLE:array<struct<VALUE:array<string>>>>>,"
    "WORK array<struct<DATE_DOCUMENT:array<struct<YEAR:string,MONTH:string,DAY:string>>>>"
)


def notice_fields(df: DataFrame, xml_col: str) -> DataFrame:
    """Title and date of a metadata notice; a broken notice gives NULLs. The
    usual layout (both elements right below the root) is read in one parse;
    other layouts are searched by path, only when the first way found nothing."""

    def fields(xml: Column) -> Column:
        ok = parses(xml)

        def at(path: str) -> Column:
            return F.when(ok & F.xpath_boolean(xml, F.lit(path)), F.xpath_string(xml, F.lit(path)))

        def pick(doc: Column) -> Column:
            titles = F.flatten(F.flatten(F.transform(
                doc["EXPRESSION"], lambda e: F.transform(e["EXPRESSION_TITLE"], lambda t: t["VALUE"])
            )))
            dates = F.flatten(F.transform(doc["WORK"], lambda w: w["DATE_DOCUMENT"]))
            deep_title = F.contains(xml, F.lit("<EXPRESSION_TITLE"))
            deep_date = F.contains(xml, F.lit("<DATE_DOCUMENT"))
            date = F.get(dates, F.lit(0))
            part = lambda name: F.when(date.isNotNull(), date[name]).when(
                deep_date, at(f"(//WORK/DATE_DOCUMENT)[1]/{name}")
            )
            title = F.coalesce(
                F.get(titles, F.lit(0)), F.when(deep_title, at("//EXPRESSION/EXPRESSION_TITLE/VALUE"))
            )
            return F.struct(
                title.alias("title"), date_from_parts(part("YEAR"), part("MONTH"), part("DAY")).alias("date")
            )

        options = {"mode": "PERMISSIVE", "ignoreSurroundingSpaces": "false"}
        return let(F.from_xml(xml, _NOTICE, options), pick)

    return df.withColumn("_notice", let(F.col(xml_col), fields)).withColumns({
        "notice_title": F.col("_notice.title"), "notice_date": F.col("_notice.date"),
    }).drop("_notice")


def parse_listing(df: DataFrame, html_col: str, keep: Sequence[str]) -> DataFrame:
    """Alternatives of a multiple-choice page, one row each, in page order.
    Items without an address are dropped; order is 999 when it is not a number."""
    chunks = F.split(F.col(html_col), r"(?i)<li\b[^>]*title\s*=\s*[\"']item[\"'][^>]*>", -1)
    item = F.col("_item")
    # the outer form, and no slice: for a test of the array's size the page would be split again. What stands before
    # the first item is chunk 0; the NULL of an empty page has no address.
    rows = df.select(*keep, F.posexplode_outer(chunks).alias("_chunk", "_item")).filter(
        (F.col("_chunk") > 0) & item.rlike(r"(?is)<a\b[^>]*\shref\s*=\s*[\"'][^\"']")
    ).withColumn("pos", F.col("_chunk") - 1)
    field = lambda title: unescape(strip(
        F.regexp_extract(item, rf"(?is)<li\b[^>]*title\s*=\s*[\"']{title}[\"'][^>]*>([^<]*)", 1)
    ))
    url = unescape(F.regexp_extract(item, r"(?is)<a\b[^>]*\shref\s*=\s*[\"']([^\"']*)[\"']", 1))
    order = field("stream_order")
    return rows.select(
        *keep,
        "pos",
        url.alias("url"),
        field("stream_name").alias("stream_name"),
        F.coalesce(F.when(order.rlike(r"^[+-]?[0-9]+$"), order.try_cast("int")), F.lit(999)).alias(
            "stream_order"
        ),
    )


def inline(spark: SparkSession, values: Sequence[str], name: str) -> DataFrame:
    """A driver-side list of parameters as a one-column table, duplicates removed."""
    rows = [(v,) for v in sorted(set(values))]
    return spark.createDataFrame(rows, T.StructType([T.StructField(name, T.StringType())]))
