"""Rule bitmask ledger: every rule is evaluated once per text; failures are bits of one long, beside the measurements.

Policies are versioned sets of rules. Applying one, or asking what each rule removes alone, is bit arithmetic on the
ledger; the texts are not read again. Built-in functions only, no shuffle: a text is judged inside its row.

Defined cases: a null text has no words (all measurements 0, fails `few_words`); other columns pass through unread;
repeated rows are judged alike, each for itself.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexspark.llm.common import WORD_GAP

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_bangs")


@dataclass(frozen=True)
class Rule:
    """name, bit and SQL condition over the measurements that holds if a text fails."""

    name: str
    bit: int
    fails: str


RULES = (
    Rule("few_words", 0, "n_words < 50"),
    Rule("repeated_words", 1, "100 * n_repeat_words > 50 * n_words"),
    Rule("symbols", 2, "100 * n_symbols > 10 * n_words"),
    Rule("repeated_lines", 3, "100 * n_dup_lines > 50 * n_lines"),
    Rule("shouting", 4, "100 * n_upper > 40 * word_chars"),
    Rule("bangs", 5, "100 * n_bangs > 40 * n_words"),
    Rule("word_length", 6, "word_chars < 2 * n_words or word_chars > 15 * n_words"),
)

#: Versioned policies: the rules a text must pass.
POLICIES = {
    "base": ("few_words", "repeated_words"),
    "v1": ("few_words", "repeated_words", "symbols"),
    "v2": tuple(r.name for r in RULES),
}


def mask_of(policy: str, rules: tuple[Rule, ...] = RULES) -> int:
    wanted = set(POLICIES[policy])
    return sum(1 << r.bit for r in rules if r.name in wanted)


def _repeated(hits: str) -> Column:
    """Words covered by the three-word windows that start at the ascending positions in `hits`."""
    return F.aggregate(
        F.col(hits),
        F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("n")),
        lambda a, p: F.struct(p.alias("last"), (a["n"] + F.least(F.lit(3), p - a["last"])).alias("n")),
        lambda a: a["n"],
    )


def measure(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """key and the measurements of each text."""
    t = F.coalesce(F.col(text), F.lit(""))
    words = F.filter(F.split(F.col("_t"), WORD_GAP), lambda w: w != "")
    windows = F.when(F.size("_w") >= 3, F.transform(
        F.sequence(F.lit(0), F.size("_w") - 3),
        lambda i: F.struct(F.concat_ws(" ", F.get("_w", i), F.get("_w", i + 1), F.get("_w", i + 2)).alias("t"), i.cast("int").alias("p")),
    ))
    hits = F.array_sort(F.transform(
        F.filter("_s", lambda x, k: (x["t"] == F.get("_s", k - 1)["t"]) | (x["t"] == F.get("_s", k + 1)["t"])),
        lambda x: x["p"],
    ))
    lines = F.filter(F.split(F.col("_t"), "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return (
        docs.select(F.col(key), t.alias("_t"))
        .withColumn("_w", words)
        .withColumn("_l", lines)
        .withColumn("_s", F.array_sort(windows))
        .withColumn("_hits", hits)
        # an outer generator, because a filter on a measurement would else be pushed down and repeat them all
        .select(key, F.inline_outer(F.array(F.struct(
            F.size("_w").cast("long").alias("n_words"),
            F.length(F.array_join("_w", "")).cast("long").alias("word_chars"),
            F.regexp_count("_t", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
            (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
            F.coalesce(_repeated("_hits"), F.lit(0)).cast("long").alias("n_repeat_words"),
            F.size("_l").cast("long").alias("n_lines"),
            F.regexp_count("_t", F.lit(r"\p{Lu}")).cast("long").alias("n_upper"),
            F.regexp_count("_t", F.lit("!!")).cast("long").alias("n_bangs"),
        ))))
    )


def ledger(docs: DataFrame, text: str = "text", key: str = "doc_id", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """key, measurements and `failed`, the bits of all rules that the text fails."""
    bits = F.lit(0).cast("long")
    for r in rules:
        bits = bits.bitwiseOR(F.when(F.expr(r.fails), F.lit(1 << r.bit)).otherwise(F.lit(0)).cast("long"))
    return measure(docs, text, key).withColumn("failed", bits)


def passes(policy: str, rules: tuple[Rule, ...] = RULES) -> Column:
    return F.col("failed").bitwiseAND(F.lit(mask_of(policy, rules))) == 0


def ablations(entries: DataFrame, policy: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per rule of the policy: texts that fail it, and texts that only it rejects (what leaving it out would
    bring back). One aggregate over the ledger; an empty ledger gives zeros."""
    mask = mask_of(policy, rules)
    used = [r for r in rules if mask >> r.bit & 1]
    seen = F.col("failed").bitwiseAND(F.lit(mask))
    row = entries.agg(*[
        F.struct(
            F.lit(r.name).alias("rule"),
            F.count_if(seen.bitwiseAND(F.lit(1 << r.bit)) != 0).alias("n_failed"),
            F.count_if(seen == F.lit(1 << r.bit)).alias("n_only"),
        ).alias(r.name)
        for r in used
    ])
    return row.select(F.inline(F.array(*[F.col(r.name) for r in used])))


def judged(docs: DataFrame, policy: str = "v2") -> DataFrame:
    base = mask_of("base")
    return ledger(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (F.col("failed").bitwiseAND(F.lit(base)) != 0).alias("base_failed"),
        passes(policy).alias("kept"),
        "failed", "n_lines", "n_upper", "n_bangs",
    )


def kept_documents(docs: DataFrame, policy: str = "v2") -> DataFrame:
    """The rows of docs whose text passes. The verdict is taken beside the row, so no join is needed."""
    boxed = docs.select(F.struct(*docs.columns).alias("_row"), F.col("text"))
    good = ledger(boxed, "text", "_row").filter(passes(policy))
    return good.select(*[F.col("_row")[c].alias(c) for c in docs.columns])
