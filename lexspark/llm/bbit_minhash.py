"""Near duplicates by b-bit MinHash, links confirmed on full sets.

A text's set is its distinct word shingles as 64-bit hashes; texts with equal sets are one class from the start. Two sets
link if 100 * |A and B| >= 85 * |A or B|.

1. Sketches. One pass hashes each set with `BANDS * ROWS` functions. The minima of a band become its key; of every minimum
   the `BITS` low bits are kept, packed into a signature of `BANDS * ROWS * BITS` bits.
2. Candidates. Classes with one key in one band meet. Two signatures agree in a share m of their places; equal low bits of
   different minima happen once in 2**BITS, so the similarity is estimated as (m - c) / (1 - c), c = 2**-BITS, from bit
   counts alone. Pairs whose estimate reaches `SURE` connect classes into clusters.
3. Links. The full sets of a cluster are counted against each other exactly, as products of 0/1 matrices over the shingles
   that two of them share; links connect classes, and a component is named by its least doc_id.

A pair at the border of 0.85 shares no band once in 2e10 cases, and falls below `SURE` once in 1e10; more similar pairs less
often. All else is exact but for equal 64-bit hashes of different shingles or sets.

Hot groups: equal texts are combined per task before a shuffle. A key with more than `TILE` classes, or a cluster with more
than `TILE` sets or `HASHES` shingles, is dealt over a grid of cells in which every two members meet, so a task holds at
most two pieces of it. A cell gives fewer edges than it has members.

Defined cases: null text, or text without words: empty set, size 0, linked with nothing, its own component; fewer words than
a shingle: the whole sequence is one shingle; repeated rows and equal texts are one class; a null doc_id never names a
component that has another, and is kept only where the component has no id at all; extra columns are never read; texts are
read whole; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexspark.llm.common import mix64, small_batches, texts_as_bytes, written
from lexspark.llm.components import components
from lexspark.llm.jaccard_join import Joined, Shingler, class_of, sets_of

PERCENT = 85
BANDS, ROWS = 32, 4
BITS = 2
SURE = 0.55
TILE = 1024
HASHES = 1 << 20
COLUMNS = 4096  # of a 0/1 matrix
HELD = 1 << 16  # rows of small tiles worked on at once
_RUN = 1 << 16
_MANY = np.uint64(0x9E3779B97F4A7C15)
_PAIRS = np.uint64(0x5555555555555555)
FUNCTIONS = BANDS * ROWS


def _functions() -> tuple[np.ndarray, np.ndarray]:
    seed = np.arange(1, 2 * FUNCTIONS + 1, dtype=np.uint64) * _MANY
    return mix64(seed[:FUNCTIONS]) | np.uint64(1), mix64(seed[FUNCTIONS:])


def minima(sets: list[np.ndarray]) -> np.ndarray:
    """The least value of every function over each set; the sets are not empty."""
    times, flips = _functions()
    lens = np.fromiter(map(len, sets), np.int64, len(sets))
    out = np.empty((len(sets), FUNCTIONS), np.uint64)
    a = 0
    while a < len(sets):
        b = a + 1
        while b < len(sets) and lens[a:b + 1].sum() <= _RUN:
            b += 1
        all_, starts = np.concatenate(sets[a:b]), np.cumsum(lens[a:b]) - lens[a:b]
        for k in range(FUNCTIONS):
            out[a:b, k] = np.minimum.reduceat((all_ ^ flips[k]) * times[k], starts)
        a = b
    return out


def band_keys(low: np.ndarray) -> np.ndarray:
    """A key for each band of each row of minima."""
    acc = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64) * _MANY, (len(low), BANDS))
    for r in range(ROWS):
        acc = mix64(acc ^ low[:, r::ROWS])
        acc *= _MANY
    return acc


def signatures(low: np.ndarray) -> np.ndarray:
    """The low bits of each row of minima, packed into words of 64 bits."""
    bits = (low[:, :, None] >> np.arange(BITS, dtype=np.uint64)) & np.uint64(1)
    return np.packbits(bits.astype(np.uint8).reshape(len(low), -1), axis=1).view(np.uint64)


def estimates(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Collision-corrected similarity of the sets behind signatures, row by row, by bit counts."""
    differ = a ^ b
    differ = (differ | (differ >> np.uint64(1))) & _PAIRS  # one bit for every place of two bits that differs
    m = 1 - np.bitwise_count(differ).sum(axis=1) / FUNCTIONS
    c = 2.0**-BITS
    return (m - c) / (1 - c)


def sketches(docs: DataFrame) -> DataFrame:
    """(doc_id, n, cls, bands, sig) of every row; bands and sig once per class and batch, and never of the empty set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()
        for batch in batches:
            sets = shingler.sets(texts_as_bytes(batch.column(1).to_pylist()))
            cls = [class_of(s) for s in sets]
            first = {c: i for i, c in reversed([*enumerate(cls)]) if len(sets[i])}
            shown = sorted(first.values())
            bands: list = [None] * len(sets)
            sig: list = [None] * len(sets)
            if shown:
                low = minima([sets[i] for i in shown])
                for i, keys, bits in zip(shown, band_keys(low).view(np.int64), signatures(low)):
                    bands[i], sig[i] = keys, bits.tobytes()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(cls, pa.int64()),
                 pa.array(bands, pa.list_(pa.int64())), pa.array(sig, pa.binary())], names=["doc_id", "n", "cls", "bands", "sig"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id long, n long, cls long, bands array<long>, sig binary")


def in_cells(rows: DataFrame, keys: list[str], parts: Column) -> DataFrame:
    """Rows with x, y: the members (cls) of a key are dealt over `parts` pieces, and every two pieces share a cell. Only keys
    with more than one piece are looked up."""
    hot = rows.groupBy(*keys).agg(parts.cast("int").alias("k")).filter("k > 1")
    dealt = rows.join(hot, keys, "left").withColumn("k", F.coalesce("k", F.lit(1)))
    own = F.pmod(F.xxhash64("cls"), F.col("k")).cast("int")
    dealt = dealt.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))
    return dealt.withColumns({"x": F.least("own", "other"), "y": F.greatest("own", "other")}).drop("k", "own", "other")


def by_cell(batches: Iterator[pa.RecordBatch], keys: list[str], enough: Callable[[pa.Table], bool]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Rows of whole cells, with the first row of each cell; the batches are in order of the keys."""
    held: pa.Table | None = None

    def starts(rows: pa.Table) -> np.ndarray:
        new = np.zeros(rows.num_rows, bool)
        new[:1] = True
        for c in keys:
            x = rows[c].to_numpy()
            new[1:] |= x[1:] != x[:-1]
        return np.flatnonzero(new)

    for batch in batches:
        rows = pa.Table.from_batches([batch])
        held = rows if held is None else pa.concat_tables([held, rows])
        if held.num_rows and enough(held):
            at = starts(held)
            if at[-1]:
                yield held.slice(0, at[-1]), at[:-1]
                held = held.slice(at[-1])
    if held is not None and held.num_rows:
        yield held, starts(held)


def _edges(names: np.ndarray, joined: Joined) -> pa.RecordBatch:
    r = joined.roots(np.arange(len(names)))
    moved = r != np.arange(len(names))
    return pa.RecordBatch.from_arrays([pa.array(names[moved]), pa.array(names[r[moved]])], names=["a", "b"])


def _alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b): what connects the classes of each cell whose estimates reach SURE."""
    for rows, starts in by_cell(batches, ["key", "x", "y"], lambda t: t.num_rows >= HELD):
        names, n = rows["cls"].to_numpy(), rows["n"].to_numpy()
        sig = np.frombuffer(b"".join(rows["sig"].to_pylist()), np.uint64).reshape(len(names), -1)
        cell = np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, len(names)]))
        joined = Joined(len(names))
        at = np.arange(len(names))
        for d in range(1, len(names)):
            at = at[at + d < len(names)]
            at = at[cell[at] == cell[at + d]]
            if not len(at):
                break
            i, j = at, at + d
            apart = joined.roots(i) != joined.roots(j)
            i, j = i[apart], j[apart]
            sized = 100 * np.minimum(n[i], n[j]) >= PERCENT * np.maximum(n[i], n[j])
            i, j = i[sized], j[sized]
            sure = estimates(sig[i], sig[j]) >= SURE
            for p, q in zip(i[sure].tolist(), j[sure].tolist()):
                joined.join(p, q)
        yield _edges(names, joined)


def clusters(classes: DataFrame) -> DataFrame:
    """(node, root): classes of one cluster, from (cls, n, bands, sig)."""
    keyed = classes.select("cls", F.explode("bands").alias("key"))
    shared = keyed.groupBy("key").agg(F.min("cls").alias("lo"), F.max("cls").alias("hi")).filter("lo < hi").select("key")
    met = written(keyed.join(shared, "key"), "met")
    met = met.join(classes.select("cls", "n", "sig"), "cls")
    cells = in_cells(met.select("key", "cls", "n", "sig"), ["key"], F.ceil(F.count(F.lit(1)) / F.lit(TILE)))
    cells = cells.repartition("key", "x", "y").sortWithinPartitions("key", "x", "y")
    return components(cells.mapInArrow(_alike, "a long, b long"))


def common_counts(sets: list[np.ndarray]) -> np.ndarray:
    """|A and B| of every two sets, by products of 0/1 matrices over the shingles that occur twice."""
    who = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    twice = times[column] > 1
    who, column = who[twice], np.unique(column[twice], return_inverse=True)[1]
    order = np.argsort(column, kind="stable")
    who, column = who[order], column[order]
    out = np.zeros((len(sets), len(sets)), np.int64)
    for start in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
        a, b = np.searchsorted(column, [start, start + COLUMNS])
        part = np.zeros((len(sets), min(COLUMNS, int(column[-1]) + 1 - start)), np.float32)
        part[who[a:b], column[a:b] - start] = 1
        out += (part @ part.T).astype(np.int64)
    return out


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b): what connects the linked classes of each cell."""
    for rows, starts in by_cell(batches, ["root", "x", "y"], lambda t: t["n"].to_numpy().sum() >= HASHES):
        names, n = rows["cls"].to_numpy(), rows["n"].to_numpy()
        sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in rows["hashes"]]
        joined = Joined(len(names))
        for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(names)]):
            if b - a < 2:
                continue
            common = common_counts(sets[a:b])
            size = n[a:b, None] + n[None, a:b]
            link = 100 * common >= PERCENT * (size - common)
            for i in range(1, b - a):
                at = np.flatnonzero(link[i, :i])
                if len(at):
                    for r in np.unique(joined.roots(at + a)).tolist():
                        joined.join(a + i, r)
        yield _edges(names, joined)


def links(sets: DataFrame, found: DataFrame) -> DataFrame:
    """(a, b): what connects the linked classes of (cls, n, hashes); found is (node, root)."""
    placed = found.withColumnRenamed("node", "cls").join(sets.select("cls", "n"), "cls")
    parts = F.greatest(F.ceil(F.count(F.lit(1)) / F.lit(TILE)), F.ceil(F.sum("n") / F.lit(HASHES)))
    cells = in_cells(placed, ["root"], parts).select("cls", "root", "x", "y").join(sets, "cls")
    cells = cells.repartition("root", "x", "y").sortWithinPartitions("root", "x", "y")
    return cells.mapInArrow(_linked, "a long, b long")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of docs."""
    with small_batches(docs.sparkSession):
        table = written(sketches(docs), "sketches")
        classes = table.filter("n > 0").groupBy("cls").agg(
            F.min("doc_id").alias("doc_id"), F.min("n").alias("n"), F.first("bands", True).alias("bands"), F.first("sig", True).alias("sig"))
        classes = written(classes, "classes")
        found = clusters(classes)
        wanted = classes.join(found.select(F.col("node").alias("cls")), "cls", "left_semi").select("doc_id", "cls")
        sets = written(sets_of(docs, wanted), "sets")
        roots = components(links(sets, found))
    named = classes.select("cls", "doc_id").join(roots.withColumnRenamed("node", "cls"), "cls", "left")
    named = named.withColumn("root", F.coalesce("root", "cls"))
    least = named.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    of_class = named.select("cls", "root").join(least, "root").select("cls", "component_id")
    done = table.select("doc_id", "n", "cls").join(of_class, "cls", "left")
    component = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return done.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))
