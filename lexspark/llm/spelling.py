"""Spelling variants: words that differ by one edit, grouped under their most frequent form.

1. Words. A task counts the words of its texts; equal words are combined before the shuffle.
2. Blocks. A word of length L is at most the longer one of a pair of longer length L, or the shorter one of L + 1. The
   longer length is cut into `PARTS` parts; one edit lies in one of them, so two near words agree on all that stands
   before and after some part. Words with one key (longer length, part, what stands around it) form a block.
3. Tiles. A block is a pair of matrices of code points, padded on the right and on the left. The common prefix of two
   rows is read from the first, the common suffix from the second; the words are near if both together reach the longer
   length minus one. A pair counts only in the block of the part in which its common prefix ends, so it counts once.
4. Forms. A word's links lead to words of ten times its count or more, so chains are short; roots are found by doubling.

Hot groups: a block of more than `TILE` words is dealt over a grid of block pairs, so a task never holds more than two
pieces of it. Long words stand with words of their length only, so padding never exceeds one code point.

Defined cases: null text has no words; a null doc_id is written as nothing before the colon; every row is an
occurrence, so repeated rows count again; equal counts go to the smaller word; extra columns are never read; texts are
read whole; an empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexspark.llm.common import written

LEAST_LENGTH = 7
LEAST_COUNT = 2
RATIO = 10
DELETE_EVERY = 31
PARTS = 4
TILE = 1024
CELLS = 1 << 22  # code points of a matrix
FLUSH = 400_000  # words that a task holds before it hands them on


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, n): the words of a task's texts with their counts."""
    runs = re.compile("[A-Za-zÀ-ÿ]{%d,}" % LEAST_LENGTH)
    counts: dict[str, int] = {}

    def handed_on() -> pa.RecordBatch:
        out = pa.RecordBatch.from_pydict({"word": pa.array(list(counts), pa.string()), "n": pa.array(list(counts.values()), pa.int64())})
        counts.clear()
        return out

    for batch in batches:
        for doc, text in zip(batch.column(0), batch.column(1)):
            text = text.as_py()
            if not text:
                continue
            seen: dict[str, int] = {}
            for run in runs.findall(text.encode().lower().decode()):  # bytes: only A-Z are lower-cased
                seen[run] = seen.get(run, 0) + 1
            start = zlib.crc32(f"{doc.as_py()}:".encode())
            for run, n in seen.items():
                h = zlib.crc32(run.encode(), start)
                if h % DELETE_EVERY == 0:
                    at = h % len(run)
                    run = run[:at] + run[at + 1:]
                    if len(run) < LEAST_LENGTH:
                        continue
                counts[run] = counts.get(run, 0) + n
            if len(counts) >= FLUSH:
                yield handed_on()
    if counts:
        yield handed_on()


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n) of all words of the texts that are long and frequent enough."""
    rows = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"), "text")
    found = rows.mapInArrow(_words, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= LEAST_COUNT)


def _bound(m: Column, part: int) -> Column:
    return F.floor(m * F.lit(part) / F.lit(PARTS)).cast("int")


def blocks(words: DataFrame) -> DataFrame:
    """(m, part, key, word, n): every word in its blocks; m is the longer length."""
    size = F.char_length("word")
    places = []
    for m in (size, size + 1):
        for part in range(PARTS):
            head = F.substring(F.col("word"), F.lit(1), _bound(m, part))
            tail = F.right(F.col("word"), m - _bound(m, part + 1))
            key = F.xxhash64(m, F.lit(part), head, tail)
            places.append(F.struct(m.alias("m"), F.lit(part).alias("part"), key.alias("key")))
    return words.select("word", "n", F.explode(F.array(*places)).alias("at")).select("at.m", "at.part", "at.key", "word", "n")


def tiles(blocked: DataFrame) -> DataFrame:
    """Blocks with x, y, own: the words of a large block are dealt over pieces, and each pair of pieces is a tile."""
    hot = blocked.groupBy("m", "part", "key").agg(F.count(F.lit(1)).alias("size")).filter(F.col("size") > TILE)
    k = F.coalesce(F.ceil(F.col("size") / F.lit(TILE)).cast("int"), F.lit(1))
    own = F.pmod(F.xxhash64("word"), F.col("k")).cast("int")
    dealt = blocked.join(hot, ["m", "part", "key"], "left").withColumn("k", k).withColumn("own", own)
    other = F.explode(F.sequence(F.lit(0), F.col("k") - 1))
    return dealt.withColumn("other", other).select(
        "m", "part", "key", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), "own", "word", "n")


def _matrices(words: list[str], m: int) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the words, padded on the right; and read backwards, padded likewise. Words have m or m - 1."""
    lens = np.fromiter(map(len, words), np.int64, len(words))
    flat = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    ends = np.cumsum(lens)
    step = np.arange(m)
    inside = step < lens[:, None]
    forward = np.where(inside, flat[np.minimum((ends - lens)[:, None] + step, len(flat) - 1)], 0)
    backward = np.where(inside, flat[np.maximum(ends[:, None] - 1 - step, 0)], 0)
    return forward, backward


def _agree(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many leading columns of the rows agree; they differ somewhere."""
    return (a != b).argmax(axis=1)


def near_pairs(m: int, words: list[str], tile: np.ndarray, part: np.ndarray, apart: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions (i, j) of near words of one longer length. `tile` numbers the tiles in ascending order; rows of one tile
    compare, but rows with one number of `apart` that is not negative are left to another tile."""
    forward, backward = _matrices(words, m)
    lens = np.fromiter(map(len, words), np.int64, len(words))
    first, second = [], []
    edges = (np.arange(PARTS + 1) * m) // PARTS
    for d in range(1, len(words)):
        i = np.flatnonzero(tile[:-d] == tile[d:])
        if not len(i):
            break
        j = i + d
        use = (part[i] == part[j]) & (np.maximum(lens[i], lens[j]) == m) & ((apart[i] != apart[j]) | (apart[i] < 0))
        i, j = i[use], j[use]
        if not len(i):
            continue
        p = _agree(forward[i], forward[j])
        s = _agree(backward[i], backward[j])
        near = (p + s >= m - 1) & (np.searchsorted(edges, p, "right") - 1 == part[i])
        first.append(i[near])
        second.append(j[near])
    if not first:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(first), np.concatenate(second)


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, near, near_n), both ways, from rows ordered by m and tile."""
    held: pa.Table | None = None

    def compared(rows: pa.Table) -> pa.RecordBatch | None:
        m = rows["m"].to_numpy()
        ids = np.stack([rows[c].to_numpy() for c in ("part", "key", "x", "y")], axis=1)
        tile = np.cumsum(np.r_[True, (ids[1:] != ids[:-1]).any(axis=1) | (m[1:] != m[:-1])])
        own = np.where(ids[:, 2] == ids[:, 3], -1, rows["own"].to_numpy())
        words, n = rows["word"].to_pylist(), rows["n"].to_numpy()
        firsts, seconds = [], []
        for a, b in zip(*_runs(m)):
            i, j = near_pairs(int(m[a]), words[a:b], tile[a:b], ids[a:b, 0], own[a:b])
            firsts.append(i + a)
            seconds.append(j + a)
        i, j = np.concatenate(firsts), np.concatenate(seconds)
        if not len(i):
            return None
        text = pa.array(words, pa.string())
        at, to = np.r_[i, j], np.r_[j, i]
        return pa.RecordBatch.from_arrays([text.take(pa.array(at)), text.take(pa.array(to)), pa.array(n[to])], names=["word", "near", "near_n"])

    for batch in batches:
        rows = pa.Table.from_batches([batch])
        held = rows if held is None else pa.concat_tables([held, rows])
        while held is not None and held.num_rows:
            # whole tiles only: the last one may go on in the next batch
            last = _last_tile(held)
            size = np.cumsum(held["m"].to_numpy()[:last])
            if not last or size[-1] < CELLS and held.num_rows < 100_000:
                break
            out = compared(held.slice(0, last))
            held = held.slice(last)
            if out is not None:
                yield out
    if held is not None and held.num_rows:
        out = compared(held)
        if out is not None:
            yield out


def _runs(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts = np.flatnonzero(np.r_[True, x[1:] != x[:-1]])
    return starts, np.r_[starts[1:], len(x)]


def _last_tile(rows: pa.Table) -> int:
    """Where the last tile of the rows begins."""
    same = np.ones(rows.num_rows, bool)
    for c in ("m", "part", "key", "x", "y"):
        x = rows[c].to_numpy()
        same &= x == x[-1]
    return int(rows.num_rows - same[::-1].argmin()) if not same.all() else 0


def near_words(words: DataFrame) -> DataFrame:
    """(word, near, near_n): every near word of every word, once each way."""
    order = ["m", "part", "key", "x", "y"]
    dealt = tiles(blocks(words))
    return dealt.repartition("key", "x", "y").sortWithinPartitions(*order).mapInArrow(_near, "word string, near string, near_n long")


def roots(links: DataFrame) -> DataFrame:
    """(word, root) of (word, form): the last form of a chain, by doubling. Chains have no loops."""
    now = written(links.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        now = written(now.join(ahead, "root", "left").select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved")), "roots")
        moved = now.filter("_moved").limit(1).count()
        now = now.drop("_moved")
        if not moved:
            return now


def spelling_variants(docs: DataFrame) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word that is long and frequent enough."""
    words = written(word_counts(docs), "words")
    best = near_words(words).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("n"), F.col("near").alias("near"))).alias("best"))
    found = words.join(best, "word", "left")
    leads = -F.col("best.n") >= F.lit(RATIO) * F.col("n")
    found = found.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(leads, F.col("best.near")).alias("form"), F.when(leads, -F.col("best.n")).alias("form_n"))
    found = written(found, "forms")
    ends = roots(found.filter("form is not null"))
    return found.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
