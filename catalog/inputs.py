"""Legal input tables derived from the given tables, the same rules as ctes.py."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexspark import model
from lexspark.operators.scale import by_key, checkpoint_folder

KEYWORDS = ["RED", "Economy", "ring", "zzz"]
CONCEPT = "http://example.org/concept/"
WORK = "http://example.org/work/"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf.rstrip('/')}/{name}.parquet")


def works(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("o_orderkey")
    kinds = {"1": "R", "2": "L", "3": "D", "4": "PC"}
    first = F.substring("o_orderpriority", 1, 1)
    ty = F.lit("X")
    for digit, code in kinds.items():
        ty = F.when(first == digit, F.lit(code)).otherwise(ty)
    base = table(spark, sf, "orders").select(
        k.alias("k"), F.col("o_custkey").alias("ck"), F.col("o_orderdate").cast("date").alias("d"),
        ty.alias("ty"),
        (F.lit(1950) + F.floor(k / 10000)).cast("string").alias("y4"),
        F.lpad((k % 10000).cast("string"), 4, "0").alias("num"),
    )
    sector = F.when(F.col("ty") == "PC", "5").when(F.col("k") % 11 == 0, "7").otherwise("3")
    main = base.withColumn("sector", sector).select(
        "k", "ck", "d", "ty", "sector",
        F.concat("sector", "y4", "ty", "num", F.when(F.col("k") % 17 == 0, "R(01)").otherwise("")).alias("celex_id"),
    )
    days = F.when(F.col("k") % 20 == 0, F.array(F.lit(30), F.lit(60))).otherwise(F.array(F.lit(30)))
    versions = base.filter((F.col("k") % 10 == 0) & F.col("ty").isin("R", "L", "D")).withColumn(
        "n", F.explode(days)
    ).select(
        (F.lit(-1) - F.col("k")).alias("k"), "ck", "d", "ty", F.lit("0").alias("sector"),
        F.concat(
            F.lit("0"), "y4", "ty", "num", F.lit("-"), F.date_format(F.date_add("d", F.col("n")), "yyyyMMdd")
        ).alias("celex_id"),
    )
    return main.unionByName(versions)


def main_works(spark, sf) -> DataFrame:
    return works(spark, sf).filter("k >= 0")


def relations(spark, sf) -> DataFrame:
    w = main_works(spark, sf)
    s = w.select(F.col("k").alias("sk"), F.col("celex_id").alias("celex_source"))
    t = w.select(F.col("k").alias("tk"), F.col("celex_id").alias("_target"))
    names = ["cites", "amends", "adopts", "based_on", "proposes_to_amend", "consolidates"]
    lines = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("sk"), F.col("l_partkey").alias("tk"), F.col("l_linenumber").alias("pos")
    )
    return lines.join(s, "sk").join(t, "tk").select(
        "celex_source",
        F.when((F.col("sk") + F.col("tk")) % 13 == 0, "").otherwise(F.col("_target")).alias("celex_target"),
        F.get(F.array(*[F.lit(n) for n in names]), F.col("pos") % 6).alias("relation_type"),
        "pos", "sk", "tk",
    )


def labels(spark, sf) -> DataFrame:
    p = table(spark, sf, "part")
    uri = F.concat(F.lit(CONCEPT), F.col("p_partkey").cast("string")).alias("uri")
    three = F.col("p_size") % 3
    lang = lambda a, b: F.when(three == 0, a).when(three == 1, b).otherwise("fr").alias("lang")
    scheme = (F.col("p_size") % 2).alias("scheme")
    pref = p.select(uri, F.lit("pref").alias("kind"), F.col("p_name").alias("label"), lang("en", "en-GB"), scheme)
    alt = p.filter("p_partkey % 2 = 0").select(
        uri, F.lit("alt").alias("kind"), F.concat_ws(" ", F.lower("p_type"), "p_brand").alias("label"),
        lang("EN", "enx"), scheme,
    )
    return pref.unionByName(alt)


def tags(spark, sf) -> DataFrame:
    lines = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("k"), "l_partkey")
    return lines.join(main_works(spark, sf), "k").select(
        "celex_id", F.concat(F.lit(CONCEPT), F.col("l_partkey").cast("string")).alias("uri")
    )


def props(spark, sf) -> DataFrame:
    return works(spark, sf).select("k", "celex_id", F.col("d").alias("date"), F.col("ty").alias("type"), "sector")


def dossiers(spark, sf) -> DataFrame:
    return main_works(spark, sf).filter("ty = 'PC'").select(
        F.concat(
            F.lit("http://example.org/procedure/"), F.year("d").cast("string"), F.lit("/"),
            F.lpad((F.col("ck") % 10000).cast("string"), 4, "0"), F.lit("/COD"),
        ).alias("ref"),
        F.col("celex_id").alias("proposal"),
    )


def adopts(spark, sf) -> DataFrame:
    return relations(spark, sf).filter("relation_type = 'adopts' AND celex_target <> ''").select(
        F.col("celex_source").alias("work"), F.col("celex_target").alias("proposal")
    )


def _subject() -> Column:
    return F.concat(F.lit(WORK), F.col("k").cast("string"))


def triples(spark, sf) -> DataFrame:
    """Graph facts: date, type, id and sector of works (a second date for every
    13th work), relation edges and labels of concepts."""
    w = works(spark, sf).filter("k >= 0")
    fact = lambda p, o, cond=None: F.when(F.lit(True) if cond is None else cond, F.struct(F.lit(p).alias("p"), o.alias("o")))
    facts = F.array_compact(F.array(
        fact(model.P_DATE, F.col("d").cast("string")),
        fact(model.P_DATE, F.date_add("d", 1).cast("string"), F.col("k") % 13 == 0),
        fact(model.P_TYPE, F.col("ty")),
        fact(model.P_CELEX, F.col("celex_id")),
        fact(model.P_SECTOR, F.col("sector"), F.col("k") % 19 != 0),
    ))
    own = w.select(_subject().alias("s"), F.inline(facts))
    by_name = {v: k for k, v in model.RELATION_PREDICATES.items()}
    r = relations(spark, sf).filter("celex_target <> ''")
    names = F.create_map(*[F.lit(x) for pair in by_name.items() for x in pair])
    node = lambda c: F.concat(F.lit(WORK), F.col(c).cast("string"))
    edges = r.select(node("sk").alias("s"), names[F.col("relation_type")].alias("p"), node("tk").alias("o"))
    expression = F.concat(F.lit("http://example.org/expression/"), F.col("k").cast("string"))
    language = F.concat(F.lit("http://example.org/language/"), F.when(F.col("k") % 4 == 0, "FRA").otherwise("ENG"))
    titles = w.select(F.inline(F.array(
        F.struct(expression.alias("s"), F.lit(model.P_EXPRESSION_OF).alias("p"), _subject().alias("o")),
        F.struct(expression.alias("s"), F.lit(model.P_TITLE).alias("p"), F.concat(F.lit("Act "), "celex_id").alias("o")),
        F.struct(expression.alias("s"), F.lit(model.P_LANGUAGE).alias("p"), language.alias("o")),
    )))
    return own.unionByName(edges).unionByName(titles)


def bindings(df: DataFrame, names: list[str], per_doc: Column, order: str) -> DataFrame:
    """Rows as query-result documents (doc, json); NULL values are left out. A
    document holds one part of 64 of its rows, so a large group stays spread."""
    term = lambda c: F.struct(F.lit("literal").alias("type"), F.col(c).cast("string").alias("value"))
    pairs = F.filter(
        F.array(*[F.struct(F.lit(c).alias("k"), F.when(F.col(c).isNotNull(), term(c)).alias("v")) for c in names]),
        lambda p: p["v"].isNotNull(),
    )
    one = df.select(
        per_doc.alias("doc"), F.col(order).alias("_o"), F.map_from_entries(pairs).alias("b"),
        F.pmod(F.xxhash64(order), F.lit(64)).alias("_part"),
    )
    docs = one.groupBy("doc", "_part").agg(
        F.transform(F.array_sort(
            F.collect_list(F.struct("_o", "b")), lambda x, y: F.when(x["_o"] < y["_o"], -1).when(x["_o"] > y["_o"], 1).otherwise(0)
        ), lambda x: x["b"]).alias("bindings")
    )
    return docs.select("doc", F.to_json(F.struct(F.struct("bindings").alias("results"))).alias("json"))


def titles(spark, sf) -> DataFrame:
    w = main_works(spark, sf)
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), "o_orderpriority")
    return w.join(o, "k").select(
        "k", "celex_id", "d",
        F.concat_ws(
            " ", F.lit("Regulation of"), F.dayofmonth("d").cast("string"),
            F.when(F.col("k") % 9 == 0, "Smarch").otherwise(F.date_format("d", "MMMM")),
            F.year("d").cast("string"), F.lit("on"), F.col("o_orderpriority"),
        ).alias("title"),
    )


def notices(spark, sf) -> DataFrame:
    title = F.when(F.col("k") % 5 == 0, "").otherwise(F.concat(F.lit("Notice ,of "), "celex_id", F.lit(" ")))
    month = F.when(F.col("k") % 7 == 0, "13").otherwise(F.month("d").cast("string"))
    # spread like landed files, however few parts the orders are read in: reading a notice costs far more than its key
    return by_key(main_works(spark, sf).select("celex_id", "k", "d"), ["k"]).select(
        "celex_id", "k",
        F.concat(
            F.lit("<NOTICE><EXPRESSION><EXPRESSION_TITLE><VALUE>"), title,
            F.lit("</VALUE></EXPRESSION_TITLE></EXPRESSION><WORK><DATE_DOCUMENT><YEAR>"), F.year("d").cast("string"),
            F.lit("</YEAR><MONTH>"), month, F.lit("</MONTH><DAY>"), F.dayofmonth("d").cast("string"),
            F.lit("</DAY></DATE_DOCUMENT></WORK></NOTICE>"),
        ).alias("xml"),
    )


def graph_facts(spark, sf) -> DataFrame:
    return main_works(spark, sf).select(
        "celex_id", "k",
        F.when(F.col("k") % 3 != 0, F.concat(F.lit("Graph title ;of "), "celex_id")).alias("title"),
        F.when(F.col("k") % 2 != 0, F.col("d")).alias("date"),
    )


def listings(spark, sf) -> DataFrame:
    """One listing page per order, one item per line in order of (line, part). The narrow lines are grouped; the much
    longer items are written where their page is."""
    name = lambda o: F.when(o["stream"] == 0, "1_EN_ACT_part1.html").when(
        o["stream"] == 1, "1_EN_annexe.html"
    ).otherwise("1_EN_cover.html")
    order = lambda n: F.when(n == 5, "").when(n == 6, "first").otherwise(n.cast("string"))

    def item(o: Column) -> Column:
        n = o["l_linenumber"]
        link = F.when(n == 7, "<p>no link</p>").otherwise(
            F.concat(F.lit('<a href="http://example.org/doc?p='), o["l_partkey"].cast("string"),
                     F.lit("&amp;l="), n.cast("string"), F.lit('">x</a>'))
        )
        return F.concat(
            F.lit('<li title="item"><ul><li title="url">'), link, F.lit('</li><li title="stream_name"> '), name(o),
            F.lit(' </li>'),
            F.when(n == 5, "").otherwise(F.concat(F.lit('<li title="stream_order">'), order(n), F.lit("</li>"))),
            F.lit("</ul></li>"),
        )

    # equal lines stand in order of the stream's name
    stream = F.when(F.col("l_returnflag") == "A", 0).when(F.col("l_returnflag") == "N", 1).otherwise(2).alias("stream")
    rows = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("doc"),
        F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", stream).alias("o"),
    )
    lines = rows.groupBy("doc").agg(F.array_sort(F.collect_list("o")).alias("_lines"))
    return lines.select(
        "doc",
        F.concat(
            F.lit("<html><body><ul>"), F.array_join(F.transform("_lines", item), "\n"), F.lit("</ul></body></html>"),
        ).alias("html"),
    )


# ---- pages built from the lines of the documents -----------------------------

def _esc(x: Column) -> Column:
    x = F.replace(x, F.lit("&"), F.lit("&amp;"))
    return F.replace(F.replace(x, F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def _cat(*parts) -> Column:
    return F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])


def _standard_line(x: Column, i: Column) -> Column:
    n, body, short = i.cast("string"), _esc(x), _esc(F.substring(x, 1, 20))
    rct = _cat('<div id="rct_', n, '"><p>', body, "</p></div>")
    return (
        F.when(i % 12 == 0, _cat('<div class="content">lost', rct, "</div>lost too"))
        .when(i % 3 == 0, rct)
        .when(i % 3 == 1, _cat(
            '<div id="art_', n, '"><p class="oj-ti-art">Article ', n, '</p><div class="eli-title"><p>', short,
            "</p></div><div><p>", body, "</p></div></div>"))
        .otherwise(_cat(
            '<div id="anx_', n, '"><p class="oj-doc-ti">ANNEX ', n, '</p><p class="oj-doc-ti">', short,
            "</p><p>", body, "</p></div>"))
    )


def _manual_line(x: Column, i: Column) -> Column:
    n, body, short, j = i.cast("string"), _esc(x), _esc(F.substring(x, 1, 20)), i % 7
    normal = _cat('<p class="Normal">', body, "</p>")
    return (
        F.when(j < 2, _cat('<p class="li ManualConsidrant"><span class="num">(', n, ")</span> ", body, "</p>"))
        .when(j == 2, _cat('<p class="Titrearticle">Article ', n, "<br/>", short, "</p>"))
        .when(j == 4, _cat(
            '<p class="Titrearticle"><span>Article ', n, '</span></p><p class="Titrearticle"><span>', short,
            "</span></p>"))
        .when((j == 6) & (i % 2 == 0), _cat(
            '<p class="Annexetitre">ANNEX IV</p><p class="NormalCentered"><b>', short, "</b></p>", normal))
        .when(j == 6, _cat('<p class="Annexetitre">ANNEX IV ', short, "</p>", normal))
        .otherwise(normal)
    )


def _plain_line(x: Column, i: Column) -> Column:
    n, body = i.cast("string"), _esc(x)
    return _cat(
        F.when(i % 11 == 0, _cat("<p>ANNEX ", n, "</p>")).otherwise(""),
        F.when(i % 5 == 0, _cat("<p>Article ", n, "</p>")).otherwise(""),
        "<p>", F.when(i % 4 == 0, "Whereas ").otherwise(""), body, "</p>",
    )


def page(text: Column, doc_id: Column, kind: Column) -> Column:
    lines = F.split(text, "\n", -1)
    rows = lambda fn: F.array_join(F.transform(lines, fn), "\n")
    head = _cat('<html><body><div class="eli-main-title"><p>Page ', doc_id.cast("string"), "</p><p>title</p></div>")
    body = (
        F.when(kind == 0, rows(_standard_line))
        .when(kind == 1, _cat(rows(_manual_line), '<p class="Fait">Done</p>'))
        .otherwise(_cat('<div id="TexteOnly">', rows(_plain_line), "</div>"))
    )
    return _cat(head, body, "</body></html>")


def legal_pages(spark, sf) -> DataFrame:
    """Pages of all three structures, partitioned by document."""
    d = by_key(table(spark, sf, "documents").select("doc_id", "text"), ["doc_id"])
    kind = (F.col("doc_id") % 3).cast("int")
    return d.select("doc_id", kind.alias("kind"), page(F.col("text"), F.col("doc_id"), kind).alias("html"))


def pages_of_kind(spark, sf, kind: int) -> DataFrame:
    """Every document as a page of one structure, partitioned by document."""
    d = by_key(table(spark, sf, "documents").select("doc_id", "text"), ["doc_id"])
    return d.select("doc_id", page(F.col("text"), F.col("doc_id"), F.lit(kind)).alias("html"))


def manifestations(spark, sf) -> DataFrame:
    d = by_key(table(spark, sf, "documents").select("doc_id", "text"), ["doc_id"])
    w = works(spark, sf).select("celex_id", "k", "ty").withColumn(
        "doc_id", F.when(F.col("k") < 0, F.lit(-1) - F.col("k")).otherwise(F.col("k"))
    )
    k = F.col("k")
    # a br keeps a page with an open p from being repaired as XHTML; manual pages have some
    broken, mended = F.lit("<br><p>"), F.lit("</i><p>")
    body = lambda cond, role, fmt, shift, tail=None: F.when(
        cond,
        F.struct(
            F.lit(role).alias("role"), F.lit(fmt).alias("fmt"),
            ((F.col("doc_id") + shift) % 3).cast("int").alias("kind"),
            F.coalesce(F.lit("") if tail is None else tail, F.lit("")).alias("tail"),
        ),
    )
    bodies = F.array_compact(F.array(
        body((k >= 0) & (k % 4 != 0), "main", "xhtml", 0, F.when(k % 7 == 1, broken).when((k % 7 == 3) & (k % 3 != 1), mended)),
        body((k >= 0) & (k % 5 != 0), "main", "html", 0),
        body((k >= 0) & (F.col("ty") == "PC") & (k % 2 == 0), "annex", "xhtml", 1, F.when(k % 8 == 2, broken)),
        body(k < 0, "main", "html", 1),
    ))
    # joined first: most works may have no page, and a work has several bodies. Merged on purpose: the pages then stand in as
    # many parts as the documents are dealt to, spread like a landed table, whose files are many
    rows = w.join(d.hint("merge"), "doc_id").select("celex_id", "doc_id", "text", F.inline(bodies))
    html = page(F.col("text"), F.col("doc_id"), F.col("kind"))
    # inline keeps the page rule from being repeated at every use of the body, and filters on the other columns go below it
    return rows.select("celex_id", "role", "fmt", F.inline(F.array(F.struct(F.concat(html, F.col("tail")).alias("body")))))


def landed(df: DataFrame) -> str:
    """A new folder, shared by all executors, with the rows as Parquet files."""
    path = f"{checkpoint_folder(df.sparkSession).rstrip('/')}/landed-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return path
