"""Phrase collocations of each language by best-first growth.

A phrase of 2 to 4 words that occurs `LEAST` times or more is a candidate; its score is the least over its cuts of
floor(2000000 * a / (l + r)), a, l and r being the counts of the phrase and of its two parts.

1. One scan counts words and pairs.
2. A phrase that begins with q = p + w is no more frequent than q, and what follows p in it is no less frequent than the
   phrase itself. So floor(2000000 * f(q) / (f(p) + f(q))), the least over the proper prefixes p of q, bounds the score of
   q and of everything that grows from it: prefix counts alone give an admissible bound.
3. The frontier is expanded best first, in batches: a line is drawn for every language at the score of its
   `DEPTH`-th pair, and one scan counts what grows from the prefixes whose bound reaches the line; a second one goes from
   three words to four. A phrase whose score reaches the line is also grown to the left, so that every longer phrase that
   may swallow it is counted. (A phrase of four words that swallows a pair contains one of three that does so.)
4. A language is settled if 2000 survivors, or all there are, stand on its line or above; no other phrase can reach it,
   ties included. For the others the line is lowered.

The prefixes of a batch reach the scanning tasks as two bit tables of fixed size (`TABLE_BITS` bits each, whatever the
data). A phrase wrongly let through is counted in full like any other, so it costs time but changes nothing.

Defined cases: null text has no words; null language is `und`, one with the language of that name; every row counts, so
repeated rows count again; ties in score go by a, then by the bytes of the phrase, ties of cuts to the first; a language
without candidates gives no row; texts are read whole; extra columns are never read; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexspark.llm.common import broadcast_object, mix64, small_batches, written

LEAST = 30
LONGEST = 4
TOP = 2000
DEPTH = 2 * TOP
SWALLOW = 80  # percent
SCALE = 2_000_000
PIECE = 4 << 20  # bytes of text held at once
TABLE_BITS = 1 << 25
SLOTS = 32
PROBES = 4
SALTS = 64
COUNTS = "lang string, k int, phrase string, f long"
_STOPS = bytes.maketrans(b".,;:!?\n\x0b\x0c\r", b"." * 10)
_STEP = np.uint64(0x9E3779B97F4A7C15)


class Piece:
    """Words of some texts of one language as codes; 0 stands between pieces."""

    def __init__(self, lang: str, texts: list[bytes | pa.Buffer]) -> None:
        data = b".".join(texts).lower().translate(_STOPS).replace(b".", b" . ")  # bytes: only A-Z are lower-cased
        words = [b".", *data.split(), b"."]
        self.words = list(dict.fromkeys(words))
        known = dict(zip(self.words, range(len(self.words))))
        self.codes = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
        self.lang = lang

    def hashes(self, k: int) -> np.ndarray:
        """Hash of the k words from every place on; what spans a border is meaningless."""
        own = word_hashes(self.words)[self.codes]
        acc = np.full(max(0, len(own) - k + 1), lang_hash(self.lang), np.uint64)
        for i in range(k):
            acc = grown(acc, own[i:i + len(acc)])
        return acc

    def whole(self, k: int) -> np.ndarray:
        """Whether the k words from every place on stand in one piece."""
        ok = np.ones(max(0, len(self.codes) - k + 1), bool)
        for i in range(k):
            ok &= self.codes[i:i + len(ok)] > 0
        return ok

    def counted(self, k: int, at: np.ndarray) -> pa.RecordBatch:
        """The distinct phrases of k words that begin at the places, with their counts."""
        size, spots = len(self.words), [self.codes[at + i] for i in range(k)]
        if size**k < 1 << 63:
            ids = spots[0]
            for more in spots[1:]:
                ids = ids * size + more
            ids, n = np.unique(ids, return_counts=True)
            spots = [ids // size**(k - 1 - i) % size for i in range(k)]
        else:
            rows, n = np.unique(np.stack(spots, axis=1), axis=0, return_counts=True)
            spots = list(rows.T)
        words = pa.array(self.words, pa.binary()).cast(pa.string())
        parts = [words.take(pa.array(spot)) for spot in spots]
        phrase = parts[0] if k == 1 else pc.binary_join_element_wise(*parts, " ")
        m = len(n)
        return pa.RecordBatch.from_arrays(
            [pa.array([self.lang] * m, pa.string()), pa.array(np.full(m, k, np.int32)), phrase, pa.array(n.astype(np.int64))],
            names=["lang", "k", "phrase", "f"])


def grown(acc: np.ndarray, words: np.ndarray) -> np.ndarray:
    return mix64(acc * _STEP + words)


def lang_hash(lang: str) -> np.uint64:
    return np.uint64(xxhash.xxh3_64_intdigest(lang.encode(), 7))


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[Piece]:
    held: dict[str, list[pa.Buffer]] = {}
    size = 0
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            held.setdefault(lang, []).append(text.as_buffer())
            size += len(text.as_buffer())
            if size >= PIECE:
                yield from (Piece(lang, texts) for lang, texts in held.items())
                held, size = {}, 0
    yield from (Piece(lang, texts) for lang, texts in held.items())


def _few(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words and pairs."""
    for piece in pieces(batches):
        for k in (1, 2):
            at = np.flatnonzero(piece.whole(k))
            if len(at):
                yield piece.counted(k, at)


class Table:
    """A set of phrase hashes as bits, in slots; may say yes to a stranger, never no to a member."""

    def __init__(self, slots: dict[int, bytes]) -> None:
        empty = bytes(TABLE_BITS // 8 // SLOTS)
        self.bits = np.frombuffer(b"".join(slots.get(s, empty) for s in range(SLOTS)), np.uint8)

    @staticmethod
    def slot(h: np.ndarray) -> np.ndarray:
        return (h % np.uint64(SLOTS)).astype(np.int64)

    @staticmethod
    def places(h: np.ndarray, probe: int) -> np.ndarray:
        """Bits within the slot."""
        return (mix64(h + np.uint64(probe + 1)) % np.uint64(TABLE_BITS // SLOTS)).astype(np.int64)

    def holds(self, h: np.ndarray) -> np.ndarray:
        at = np.arange(len(h))
        for probe in range(PROBES):
            bit = self.slot(h[at]) * (TABLE_BITS // SLOTS) + self.places(h[at], probe)
            at = at[(self.bits[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 == 1]
        out = np.zeros(len(h), bool)
        out[at] = True
        return out


def _phrase_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(side, slot, h) of (side, lang, phrase)."""
    for batch in batches:
        h = np.zeros(batch.num_rows, np.uint64)
        langs, phrases = batch.column(1).to_pylist(), batch.column(2).to_pylist()
        for i, (lang, phrase) in enumerate(zip(langs, phrases)):
            acc = np.full(1, lang_hash(lang), np.uint64)
            for w in word_hashes(phrase.encode().split(b" ")):
                acc = grown(acc, w)
            h[i] = acc[0]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(Table.slot(h).astype(np.int32)), pa.array(h.view(np.int64))], names=["side", "slot", "h"])


def _slot_bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(side, slot, bits) of the slots of this partition."""
    tables: dict[tuple[int, int], np.ndarray] = {}
    for batch in batches:
        side, slot = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        h = batch.column(2).to_numpy().view(np.uint64)
        for key in {*zip(side.tolist(), slot.tolist())}:
            mine = h[(side == key[0]) & (slot == key[1])]
            bits = tables.setdefault(key, np.zeros(TABLE_BITS // SLOTS // 8, np.uint8))
            for probe in range(PROBES):
                place = Table.places(mine, probe)
                np.bitwise_or.at(bits, place >> 3, np.left_shift(1, place & 7).astype(np.uint8))
    for (side, slot), bits in tables.items():
        yield pa.RecordBatch.from_arrays([pa.array([side], pa.int32()), pa.array([slot], pa.int32()), pa.array([bits.tobytes()], pa.binary())], names=["side", "slot", "bits"])


RIGHT, LEFT = 0, 1


def bit_tables(grow: DataFrame) -> tuple[Table, Table]:
    """Tables of the phrases to grow on the right and on the left; grow is (side, lang, phrase). The driver gets at most
    2 * SLOTS rows, TABLE_BITS / 4 bytes in all, whatever the number of phrases."""
    hashed = grow.select("side", "lang", "phrase").mapInArrow(_phrase_hashes, "side int, slot int, h long")
    rows = hashed.repartition(2 * SLOTS, "side", "slot").mapInArrow(_slot_bits, "side int, slot int, bits binary").collect()
    return tuple(Table({r["slot"]: bytes(r["bits"]) for r in rows if r["side"] == side}) for side in (RIGHT, LEFT))


def grown_counts(texts: DataFrame, grow: DataFrame, sizes: tuple[int, ...]) -> DataFrame:
    """Counts, from LEAST on, of all phrases of size + 1 words that grow from the phrases of `grow`; of others perhaps, but
    never in part."""
    sent = broadcast_object(texts.sparkSession, bit_tables(grow))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        right, left = sent()
        for piece in pieces(batches):
            for k in sizes:
                at = np.flatnonzero(piece.whole(k + 1))
                if not len(at):
                    continue
                h = piece.hashes(k)
                at = at[right.holds(h[at]) | left.holds(h[at + 1])]
                if len(at):
                    yield piece.counted(k + 1, at)

    found = _totals(texts.mapInArrow(scan, COUNTS)).filter(F.col("f") >= LEAST)
    with small_batches(texts.sparkSession):
        return written(found, "grown")


def _totals(counts: DataFrame) -> DataFrame:
    return counts.groupBy("lang", "k", "phrase").agg(F.sum("f").alias("f"))


def _wide(c: Column | str) -> Column:
    return F.col(c).cast("decimal(20,0)") if isinstance(c, str) else c.cast("decimal(20,0)")


def ratio(a: str, whole: Column) -> Column:
    """floor(SCALE * a / whole), exact beyond 64 bits."""
    return F.call_function("div", F.lit(SCALE).cast("decimal(10,0)") * _wide(a), whole)


def valued(phrases: DataFrame, counts: DataFrame) -> DataFrame:
    """(lang, k, phrase, a, l, r, score, bound). The score is null where the count of a part is unknown; parts of
    candidates that reach the line are known."""
    cuts = F.explode(F.expr("sequence(1, k - 1)")).alias("cut")
    cut = phrases.select("lang", "k", "phrase", F.col("f").alias("a"), cuts).select(
        "*", F.expr("substring_index(phrase, ' ', cut)").alias("first"), F.expr("substring_index(phrase, ' ', cut - k)").alias("rest"))
    known = counts.select("lang", "phrase", "f")
    cut = cut.join(known.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l")), ["lang", "first"], "left")
    cut = cut.join(known.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"], "left")
    cut = cut.withColumn("s", ratio("a", _wide("l") + _wide("r"))).withColumn("b", ratio("a", _wide("l") + _wide("a")))
    least = cut.groupBy("lang", "k", "phrase", "a").agg(
        F.min(F.struct("s", "cut", "l", "r")).alias("m"), F.count("s").alias("known"), F.min("b").alias("bound"))
    whole = F.col("known") == F.col("k") - 1
    return least.select("lang", "k", "phrase", "a", "m.l", "m.r", F.when(whole, F.col("m.s")).alias("score"), "bound")


def line_at(pairs: DataFrame, depth: int) -> DataFrame:
    """(lang, line): the score that `depth` pairs reach, 0 if there are fewer. A language has SCALE / 2 + 1 scores at the
    most, so the window is of bounded size."""
    steps = pairs.filter("score is not null").groupBy("lang", "score").agg(F.count(F.lit(1)).alias("m"))
    reached = F.sum("m").over(Window.partitionBy("lang").orderBy(F.desc("score")))
    steps = steps.withColumn("reached", reached)
    return steps.groupBy("lang").agg(F.coalesce(F.max(F.when(F.col("reached") >= depth, F.col("score"))), F.lit(0)).alias("line"))


def swallowed(phrases: DataFrame, longer: DataFrame) -> DataFrame:
    """The phrases that no phrase one word longer, of SWALLOW percent of their count or more, contains."""
    parts = F.explode(F.expr("array(substring_index(phrase, ' ', k - 1), substring_index(phrase, ' ', 1 - k))")).alias("phrase")
    most = longer.select("lang", parts, "f").groupBy("lang", "phrase").agg(F.max("f").alias("_most"))
    left = F.coalesce(F.lit(100) * _wide("_most") < F.lit(SWALLOW) * _wide("a"), F.lit(True))
    return phrases.join(most, ["lang", "phrase"], "left").filter(left).drop("_most")


def ranked(found: DataFrame) -> DataFrame:
    """The first TOP of each language; first those of a share of each language, so that no task sorts a whole one."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salt = F.pmod(F.xxhash64("phrase"), F.lit(SALTS))
    some = found.withColumn("salt", salt).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order)))
    some = some.filter(F.col("rank") <= TOP)
    return some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= TOP)


def collocations(docs: DataFrame) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the first TOP survivors of each language."""
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), "text").filter("text is not null")
    few = _totals(texts.mapInArrow(_few, COUNTS)).filter((F.col("k") == 1) | (F.col("f") >= LEAST))
    with small_batches(docs.sparkSession):
        few = written(few, "few")
    totals = few.filter("k = 1").groupBy("lang").agg(F.sum("f").alias("n"))
    few = few.filter(F.col("f") >= LEAST)
    pairs = written(valued(few.filter("k = 2"), few), "pairs")
    open_ = line_at(pairs, 1).select("lang")
    results, depth = [], DEPTH
    while True:
        lines = written(line_at(pairs, depth).join(open_, "lang", "left_semi"), "lines")
        if not lines.limit(1).count():
            break
        survivors = written(_settled(texts, few, pairs, lines), "survivors")
        enough = survivors.groupBy("lang").agg(F.count(F.lit(1)).alias("m"))
        done = lines.join(enough, "lang", "left").filter((F.col("m") >= TOP) | (F.col("line") == 0)).select("lang")
        results.append(survivors.join(done, "lang", "left_semi"))
        open_ = written(lines.join(done, "lang", "left_anti").select("lang"), "open")
        depth *= 4
    none = docs.sparkSession.createDataFrame([], "lang string, k int, phrase string, a long, l long, r long, score long")
    found = ranked(functools.reduce(DataFrame.unionByName, results, none))
    return found.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def _settled(texts: DataFrame, few: DataFrame, pairs: DataFrame, lines: DataFrame) -> DataFrame:
    """The survivors of the languages of `lines` that stand on their line or above."""

    def to_grow(phrases: DataFrame) -> DataFrame:
        at = phrases.join(lines, "lang")
        right = at.filter("bound >= line").select(F.lit(RIGHT).alias("side"), "lang", "phrase")
        return right.unionByName(at.filter("score >= line").select(F.lit(LEFT).alias("side"), "lang", "phrase"))

    threes = grown_counts(texts, to_grow(pairs), (2,))
    threes_valued = written(valued(threes, few.unionByName(threes)), "threes-valued")
    grow = to_grow(threes_valued)
    # the last three words of what grows from three are counted with all that begins with their first two
    ends = grow.filter(F.col("side") == RIGHT).select("side", "lang", F.expr("substring_index(phrase, ' ', -2)").alias("phrase")).distinct()
    more = grown_counts(texts, grow.unionByName(ends), (2, 3))
    fours = more.filter("k = 4")
    all_threes = threes.unionByName(more.filter("k = 3")).dropDuplicates(["lang", "phrase"])
    fours_valued = valued(fours, few.unionByName(all_threes))

    def above(phrases: DataFrame) -> DataFrame:
        return phrases.join(lines, "lang").filter("score >= line").drop("bound", "line")

    kept = swallowed(above(pairs), all_threes).unionByName(swallowed(above(threes_valued), fours))
    return kept.unionByName(above(fours_valued))
