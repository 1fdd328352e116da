"""Temperature mixing of sources.

Token shares p of the sources are raised to an exponent and normalised: w ~ p ** a. The exponent (1: as found, 0: all
equal) is bisected to meet a target entropy, or the limit on how often the most repeated source is repeated relative to
the least. The weights times the token budget give each source a number of epochs: full epochs take every document, the
last one a part. The part is cut by a permutation of blocks: a document's block is a hash of its id, blocks come in the
order of a hash of seed and epoch, and one block at the border is cut by the hash order of its documents. A hot source
has many blocks, so no task holds a source; a decision table of at most MAX_BLOCKS rows per source goes to the rows.

Defined cases: a null source is a source of its own; null and empty texts have 0 tokens, and a source without tokens gets
weight 0 and is kept once when no budget is given (so nothing is lost), else left out; an empty table gives an empty
mixture; repeated rows are drawn together (same id, same hash); ties of hashes go by id; other columns pass through.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexspark.llm.common import written

MAX_BLOCKS = 4096
BLOCK_TOKENS = 50_000
BROADCAST_ROWS = 200_000
NO_SOURCE = "\u0000"  # stands for a null source


@dataclass(frozen=True)
class Target:
    """Either entropy (nats, reached as nearly as exponents 0 to 1 allow) or repetition (at least 1)."""

    entropy: float | None = None
    repetition: float | None = None


def weights_at(shares: list[float], a: float) -> list[float]:
    raw = [p**a if p > 0 else 0.0 for p in shares]
    total = sum(raw)
    return [r / total if total else 0.0 for r in raw]


def bisect(holds: Callable[[float], bool], low: float = 0.0, high: float = 1.0, steps: int = 60) -> float:
    """Least argument at which a condition, false then true, holds; high if it never does."""
    if holds(low):
        return low
    for _ in range(steps):
        mid = (low + high) / 2
        low, high = (low, mid) if holds(mid) else (mid, high)
    return high


def exponent_for(shares: list[float], target: Target) -> float:
    used = [p for p in shares if p > 0]
    if not used:
        return 1.0
    if target.entropy is not None:
        return bisect(lambda a: -sum(w * math.log(w) for w in weights_at(used, a) if w) <= target.entropy)

    def repetition(a: float) -> float:
        epochs = [w / p for w, p in zip(weights_at(used, a), used)]
        return max(epochs) / min(epochs)

    return bisect(lambda a: repetition(a) <= target.repetition)


@dataclass(frozen=True)
class Plan:
    """What one source gets."""

    source: str
    tokens: int
    share: float
    weight: float
    epochs: float
    blocks: int


def plans_for(totals: dict[str, int], target: Target, budget: int | None) -> list[Plan]:
    """budget None: the least budget that takes every document at least once."""
    names = sorted(totals)
    everything = sum(totals.values())
    shares = [totals[s] / everything if everything else 0.0 for s in names]
    weights = weights_at(shares, exponent_for(shares, target))
    free = budget is None
    if budget is None:
        budget = max((totals[s] / w for s, w in zip(names, weights) if w), default=0)
    out = []
    for s, p, w in zip(names, shares, weights):
        epochs = budget * w / totals[s] if totals[s] else float(free)
        if abs(epochs - round(epochs)) < 1e-9:
            epochs = float(round(epochs))
        out.append(Plan(s, totals[s], p, w, epochs, max(1, min(MAX_BLOCKS, -(-totals[s] // BLOCK_TOKENS)))))
    return out


def hash_of(seed: int, *cols: Column) -> Column:
    return F.xxhash64(F.lit(seed), *cols)


def source_of(col: str = "source") -> Column:
    return F.coalesce(F.col(col), F.lit(NO_SOURCE))


@dataclass
class Mixture:
    """Source plans and the decision of each block: `copies` full epochs, and in the last one documents whose hash
    (then id) is at most `cut_h`, `cut_id`."""

    plans: list[Plan]
    decisions: DataFrame
    small: bool
    seed: int

    def apply(self, docs: DataFrame) -> DataFrame:
        """Rows of docs once per epoch, with `epoch`, `block` and `place` (the hash that orders a block)."""
        n = F.create_map(*[F.lit(x) for p in self.plans for x in (p.source, p.blocks)]) if self.plans else None
        rows = docs.select(F.struct(*docs.columns).alias("_row"))
        if n is None:
            return rows.filter(F.lit(False)).select("_row.*", F.lit(0).alias("epoch"), F.lit(0).alias("block"), F.lit(0).cast("long").alias("place"))
        rows = rows.withColumn("_source", source_of("_row.source")).withColumn("_id", F.col("_row.doc_id").cast("string"))
        rows = rows.withColumn("_block", F.pmod(hash_of(self.seed, F.col("_id")), n[F.col("_source")]).cast("int"))
        table = self.decisions.select(F.col("source").alias("_source"), F.col("block").alias("_block"), "copies", "cut_h", "cut_id")
        rows = rows.join(F.broadcast(table) if self.small else table, ["_source", "_block"])
        last = hash_of(self.seed + 1, F.col("copies"), F.col("_id"))
        partly = (last < F.col("cut_h")) | ((last == F.col("cut_h")) & (F.coalesce("_id", F.lit("")) <= F.col("cut_id")))
        times = F.col("copies") + F.when(partly, 1).otherwise(0)
        rows = rows.withColumn(
            "_epoch", F.explode(F.when(times > 0, F.sequence(F.lit(0), times - 1)).otherwise(F.array().cast("array<int>"))))
        return rows.select("_row.*", F.col("_epoch").alias("epoch"), F.col("_block").alias("block"),
                           hash_of(self.seed + 1, F.col("_epoch"), F.col("_id")).alias("place"))


def mixture(docs: DataFrame, target: Target, budget: int | None = None, seed: int = 11) -> Mixture:
    """Measure the sources and decide. The texts are read once, for their word counts."""
    spark = docs.sparkSession
    words = F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")
    narrow = written(docs.select(F.col("doc_id").cast("string").alias("id"), source_of().alias("source"), words.alias("tokens")), "sizes")
    totals = {r["source"]: r["t"] for r in narrow.groupBy("source").agg(F.sum("tokens").alias("t")).collect()}  # a row per source
    plans = plans_for(totals, target, budget)
    number = sum(p.blocks for p in plans)
    schema = "source string, n_blocks int, full int, part double"
    table = spark.createDataFrame([(p.source, p.blocks, int(p.epochs), (p.epochs - int(p.epochs)) * p.tokens) for p in plans], schema)
    placed = narrow.join(F.broadcast(table), "source").withColumn("block", F.pmod(hash_of(seed, F.col("id")), F.col("n_blocks")).cast("int"))
    blocks = placed.groupBy("source", "block", "full", "part").agg(F.sum("tokens").alias("tokens"))
    order = Window.partitionBy("source").orderBy(hash_of(seed + 1, F.col("full"), F.col("source"), F.col("block")), "block")
    before = F.coalesce(F.sum("tokens").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # at most MAX_BLOCKS rows
    blocks = blocks.withColumn("left", F.col("part") - before).withColumn(
        "state", F.when(F.col("left") <= 0, 0).when(F.col("left") >= F.col("tokens"), 2).otherwise(1))
    # the one block of a source that the budget ends in: documents by hash until the rest is used up
    edge = placed.join(blocks.filter("state = 1").select("source", "block", "left"), ["source", "block"])
    edge = edge.withColumn("h", hash_of(seed + 1, F.col("full"), F.col("id"))).withColumn("id", F.coalesce("id", F.lit("")))
    ids = edge.groupBy("source", "block", "left", "h", "id").agg(F.sum("tokens").alias("tokens"))
    run = Window.partitionBy("source", "block").orderBy("h", "id").rowsBetween(Window.unboundedPreceding, -1)
    taken = ids.withColumn("used", F.coalesce(F.sum("tokens").over(run), F.lit(0))).filter(F.col("used") < F.col("left"))
    cuts = taken.groupBy("source", "block").agg(F.max(F.struct("h", "id")).alias("cut"))
    decisions = blocks.join(cuts, ["source", "block"], "left").select(
        "source", "block", F.when(F.col("state") == 2, F.col("full") + 1).otherwise(F.col("full")).alias("copies"),
        F.when(F.col("state") == 1, F.col("cut.h")).alias("cut_h"), F.when(F.col("state") == 1, F.col("cut.id")).alias("cut_id"),
    )
    return Mixture(plans, written(decisions, "decisions"), number <= BROADCAST_ROWS, seed)


def mixed(docs: DataFrame, target: Target, budget: int | None = None, seed: int = 11) -> DataFrame:
    """Rows of docs as often as the mixture takes them, columns unchanged."""
    whole = docs.select("doc_id", "source", F.struct(*docs.columns).alias("_all"))  # no name of theirs meets one of ours
    return mixture(docs, target, budget, seed).apply(whole).select("_all.*")
