"""Benchmark decontamination by template windows.

Numbers, names and units of a text become typed placeholders, so a question asked again with other values gives the same
template. Windows of `WINDOW` canonical words of every document are hash-joined with those of the benchmark, and the words
behind equal hashes are compared. Matches of one document and item with one alignment (position in the document less
position in the item) must have consistent slots: one value of the item stands for one value of the document throughout.
Neighbouring alignments, no more than `SLACK` words apart, are chained, so an inserted, left-out or changed word costs the
words it touches and not the windows across it. A document leaks an item if its matches cover at least `min_share` of the
item, counted in windows: covered words less WINDOW - 1. A chain whose slots contradict each other counts by its best
alignment alone. Built-in functions only.

* name: a capitalised word after a lower-case letter, digit, comma or semicolon and at most 20 white-space characters (so
  not at a sentence start); names in a row without a comma are one name
* unit: a word of UNITS after a number; number: a word with a digit and no letter; numbers in a row are one (`5 000`)

Most documents share nothing with the benchmark. A window of n words holds, wherever it lies, one of the shorter seeds that
start at every n/2-th word of a document; only documents with a seed of the benchmark get all their windows, and only keys,
positions and hashes are joined. Nothing is lost by that.

Defined cases: null and empty texts have no windows and never leak; an item of fewer words than WINDOW has one window of
its own length, an empty item none; a window counts if at least half of it is literal words (if an item has no such
window, all count). Each distinct (item_id, text) is searched, also without an item_id; each distinct (doc_id, text) is
judged by itself, so rows of one id, or without an id, do not add up or pull each other out; equal rows share a verdict.
`leaks` gives the best row of each (doc_id, item_id). An empty benchmark gives no leaks; extra columns are never read.
Texts are read whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexspark.llm.common import written
from lexspark.operators.scale import broadcast_if_small, may_have_key

WINDOW = 8
SLACK = WINDOW
BROADCAST_WINDOWS = 200_000
NAME, UNIT, NUMBER, JOINT = "\u0001", "\u0002", "\u0003", "\u0004"
UNITS = (
    "mm", "cm", "m", "km", "g", "kg", "mg", "t", "l", "ml", "s", "min", "h", "hours", "minutes", "seconds", "days", "weeks",
    "months", "years", "miles", "feet", "inches", "pounds", "dollars", "euros", "cents", "percent", "degrees", "kwh", "mb", "gb",
)
GAP = r"[\x20\x09-\x0D]"
NAME_GAP = GAP + r"++(?=\p{Lu})(?<=[\p{Ll}\p{N},;]" + GAP + "{1,20})"
NAME_RUN = r" \u0001(?<=\u0001[^\x20\x09-\x0D\u0001,;]{1,40} \u0001)"
NUMBER_RUN = GAP + "++(?=[0-9])(?<=[0-9]" + GAP + "{1,20})"
UNIT_GAP = GAP + "++(?=(?:" + "|".join(UNITS) + r")(?![^\x20\x09-\x0D.,;:!?]))(?<=[0-9]" + GAP + "{1,20})"
WORD_END = r"[.,;:!?()\"'\[\]]*+(?:" + GAP + r"++|\z)"


def marked(text: Column) -> Column:
    """Lower-case text with a mark before each name and unit, the words of a name or number joined."""
    t = F.lower(F.regexp_replace(F.regexp_replace(text, NAME_GAP, " " + NAME), NAME_RUN, JOINT))
    numbers = F.regexp_replace(F.regexp_replace(t, NUMBER_RUN, JOINT), UNIT_GAP, " " + UNIT)
    return F.when(text.rlike("[0-9]" + GAP), numbers).otherwise(t)


def templates(df: DataFrame, *keys: str) -> DataFrame:
    """keys, words and template of each row; punctuation at word ends is dropped."""

    def typed(w: Column) -> Column:
        number = w.rlike("[0-9]") & ~w.rlike(r"\p{L}")
        literal = F.when((w >= "a") & (w < "{"), w)  # most words, told by their first byte
        return literal.when(w.startswith(NAME), NAME).when(w.startswith(UNIT), UNIT).when(number, NUMBER).otherwise(w)

    rows = df.select(*keys, F.array_remove(F.split(marked(F.col("text")), WORD_END), "").alias("words"))
    return rows.select(*keys, "words", F.transform("words", typed).alias("template"))


def keyed(df: DataFrame, id_column: str) -> Column:
    """A digest of id and text, never null: what is judged by itself."""
    name = F.when(df[id_column].isNull(), "").otherwise(F.concat(F.lit("="), df[id_column].cast("string")))
    return F.md5(F.concat(name, F.lit("\u0000"), F.coalesce(df["text"], F.lit(""))))


def spots(template: str, size: int, length: int, step: int = 1) -> Column:
    """(size, pos, h) of the runs of `length` words at every `step`-th word, named after windows of `size` words."""
    one = lambda i: F.struct(
        F.lit(size).alias("size"), i.alias("pos"), F.xxhash64(*[F.get(template, i + k) for k in range(length)]).alias("h")
    )
    places = F.sequence(F.lit(0), F.size(template) - length, F.lit(step))
    return F.when(F.size(template) >= length, F.transform(places, one)).otherwise(F.array())


def seed_shape(size: int) -> tuple[int, int]:
    """Step and length of seeds: any window of `size` words holds a whole seed of `length` that starts at a multiple of
    `step`, as length + step - 1 = size."""
    step = max(1, size // 2)
    return step, size - step + 1


def items_of(benchmark: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The items (item_key, item_id, item_words, item_template, size, n_item) and their counted windows (item_key, size,
    item_pos, h)."""
    rows = benchmark.select("item_id", "text", keyed(benchmark, "item_id").alias("item_key")).dropDuplicates(["item_key"])
    rows = templates(rows, "item_key", "item_id").filter(F.size("words") > 0)
    rows = rows.withColumn("size", F.least(F.lit(WINDOW), F.size("words")))
    places = F.sequence(F.lit(0), F.size("words") - F.col("size"))
    literal = lambda p: F.size(F.filter(F.slice("template", p + 1, F.col("size")), lambda w: ~w.isin(NAME, UNIT, NUMBER)))
    good = F.filter(places, lambda p: 2 * literal(p) >= F.col("size"))
    rows = rows.withColumn("good", good).withColumn("places", F.when(F.size("good") > 0, F.col("good")).otherwise(places))
    rows = written(rows.withColumn("n_item", in_windows("places")).drop("good"), "items")
    sized = [F.when(F.col("size") == n, spots("template", n, n)) for n in range(1, WINDOW + 1)]
    windows = rows.select("item_key", "places", F.inline(F.coalesce(*sized))).filter(F.array_contains("places", F.col("pos")))
    items = rows.select("item_key", "item_id", F.col("words").alias("item_words"), F.col("template").alias("item_template"), "size", "n_item")
    return items, windows.select("item_key", "size", F.col("pos").alias("item_pos"), "h")


def in_windows(places: str) -> Column:
    """Words covered by the windows at these places, less those that a first window takes."""
    run = lambda p: F.sequence(p, p + F.col("size") - 1)
    return (F.size(F.array_distinct(F.flatten(F.transform(places, run)))) - F.col("size") + 1).cast("long")


def seeds_of(items: DataFrame, windows: DataFrame, sizes: list[int]) -> DataFrame:
    """Distinct (size, h) of all seeds that lie in a counted window."""
    parts = []
    for n in sizes:
        step, length = seed_shape(n)
        runs = items.filter(F.col("size") == n).select("item_key", F.inline(spots("item_template", n, length)))
        inside = windows.filter(F.col("size") == n).select("item_key", F.explode(F.sequence(F.col("item_pos"), F.col("item_pos") + step - 1)).alias("pos"))
        parts.append(runs.join(inside.distinct(), ["item_key", "pos"]).select("size", "h"))
    seeds = parts[0]
    for part in parts[1:]:
        seeds = seeds.union(part)
    return seeds.distinct()


def hits_of(docs: DataFrame, items: DataFrame, windows: DataFrame) -> DataFrame:
    """One row per (document, item, pos, item_pos) of equal window templates: ids, keys, size, n_item, slots."""
    sizes = sorted(r["size"] for r in items.select("size").distinct().collect()) or [WINDOW]  # 1 to WINDOW
    docs = docs.select("doc_id", "text", keyed(docs, "doc_id").alias("doc_key"))
    seeds = broadcast_if_small(written(seeds_of(items, windows, sizes), "seeds"), BROADCAST_WINDOWS)
    some = [spots("template", n, seed_shape(n)[1], seed_shape(n)[0]) for n in sizes]
    sown = templates(docs, "doc_key").select("doc_key", F.inline(F.concat(*some) if len(some) > 1 else some[0]))
    keys = written(sown.join(seeds, ["size", "h"], "left_semi").select("doc_key").distinct(), "candidates")
    wanted = may_have_key(docs, keys).groupBy("doc_key").agg(F.any_value("doc_id").alias("doc_id"), F.any_value("text").alias("text"))
    rows = written(templates(wanted, "doc_key", "doc_id"), "words")

    every = [spots("template", n, n) for n in sizes]
    narrow = rows.select("doc_key", F.inline(F.concat(*every) if len(every) > 1 else every[0]))
    met = narrow.join(broadcast_if_small(windows, BROADCAST_WINDOWS), ["size", "h"]).select("doc_key", "pos", "item_key", "item_pos")
    met = met.join(rows, "doc_key").join(broadcast_if_small(items), "item_key")
    part = lambda c, p: F.slice(c, F.col(p) + 1, F.col("size"))
    met = met.filter(part("template", "pos") == part("item_template", "item_pos"))  # the words, not only their hash
    pairs = F.arrays_zip(part("template", "pos").alias("t"), part("item_words", "item_pos").alias("a"), part("words", "pos").alias("b"))
    slots = F.transform(F.filter(pairs, lambda x: x["t"].isin(NAME, UNIT, NUMBER)), lambda x: F.struct(x["a"].alias("a"), x["b"].alias("b")))
    return met.select("doc_key", "doc_id", "item_key", "item_id", "size", "n_item", "pos", "item_pos", slots.alias("slots"))


def row_leaks(docs: DataFrame, benchmark: DataFrame, min_share: float = 0.5) -> DataFrame:
    """One row per leaked (doc_key, item_key), with the ids of both: n_windows, n_item, share, verbatim."""
    items, windows = items_of(benchmark)
    both = ["doc_key", "doc_id", "item_key", "item_id", "size", "n_item"]
    merged = lambda c: F.array_distinct(F.flatten(F.collect_set(c)))
    # what an alignment or a chain gathers is bounded by the item's words and the values they take
    aligned = hits_of(docs, items, windows).groupBy(*both, (F.col("pos") - F.col("item_pos")).alias("shift")).agg(
        F.collect_set("item_pos").alias("places"), merged("slots").alias("slots"))
    aligned = written(aligned.filter(consistent("slots")), "alignments")
    order = Window.partitionBy("doc_key", "item_key").orderBy("shift")
    opens = F.coalesce((F.col("shift") - F.lag("shift").over(order) > SLACK).cast("int"), F.lit(0))
    chains = (
        aligned.withColumn("opens", opens).withColumn("chain", F.sum("opens").over(order))
        .groupBy(*both, "chain").agg(merged("places").alias("places"), merged("slots").alias("slots")).filter(consistent("slots"))
    )
    found = aligned.drop("shift").union(chains.drop("chain")).withColumn("n_windows", in_windows("places"))
    return (
        found.filter(F.col("n_windows") >= F.ceil(F.lit(min_share) * F.col("n_item")))
        .groupBy("doc_key", "doc_id", "item_key", "item_id")
        .agg(F.max("n_windows").alias("n_windows"), F.max("n_item").alias("n_item"),
             F.bool_or(F.forall("slots", lambda x: x["a"] == x["b"])).alias("verbatim"))
        .withColumn("share", F.col("n_windows") / F.col("n_item"))
    )


def consistent(slots: str) -> Column:
    return F.size(F.array_distinct(F.transform(slots, lambda x: x["a"]))) == F.size(slots)


def leaks(docs: DataFrame, benchmark: DataFrame, min_share: float = 0.5) -> DataFrame:
    """One row per leaked (doc_id, item_id): n_windows and n_item of its largest share, share, verbatim (of any)."""
    best = F.max(F.struct("share", "n_windows", "n_item")).alias("best")
    rows = row_leaks(docs, benchmark, min_share).groupBy("doc_id", "item_id").agg(best, F.bool_or("verbatim").alias("verbatim"))
    return rows.select("doc_id", "item_id", "best.n_windows", "best.n_item", "verbatim", "best.share")


def clean_documents(docs: DataFrame, benchmark: DataFrame, min_share: float = 0.5) -> DataFrame:
    """The rows of docs whose id and text leak nothing."""
    bad = written(row_leaks(docs, benchmark, min_share).select(F.col("doc_key").alias("_leaking")).distinct(), "leaking")
    return docs.join(broadcast_if_small(bad), keyed(docs, "doc_id") == bad["_leaking"], "left_anti")
