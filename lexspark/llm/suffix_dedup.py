"""Removal of repeated byte strings with partitioned suffix arrays.

A byte goes if a string of `length` (100) bytes that covers it also starts earlier: in a smaller document, or in the same
one before. Strings are judged on the input. Two equal strings have the same least 32-gram (by hash), so:

1. Segments. A text's string starts fall into runs with one least 32-gram. Only these 64-bit hashes are shuffled, packed
   per task and bucket, to find the ones that occur more than once; most of a clean corpus ends here.
2. Suffix arrays. Segments whose hash repeats meet by hash. In each bucket their suffixes are sorted in two stages: those
   smaller than their successor directly, the others induced from them by one scan over the character buckets, in which a
   suffix puts its predecessor behind its bucket's head. Common prefixes of neighbours that are windows then give the
   groups of equal strings; all but the first start of a group is a repeat.
3. Covering. Repeated starts become byte ranges of their document; each text is cut by the union of its ranges.

Hot strings: a task sends each distinct segment once (the first; later ones in the task are repeats already), so a passage
that a third of all documents hold reaches its bucket once per task, not once per document. Where the neighbours of a hot
line differ, so do the segments: a hash with more than HOT bytes of distinct segments (the driver gets these hashes, at most
one per HOT bytes of text) has no bucket. Each of its strings goes by its own 128-bit digest, once per 4 MB of texts, and
equal digests are equal strings.

Defined cases: null and empty texts have no bytes; texts shorter than `length` lose nothing; rows with the same id are
ordered by a hash of their text, and equal rows count as one occurrence, so they do not remove each other; a null id comes
before all others; extra columns are never read; texts are read whole; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexspark.llm.common import broadcast_object, buckets_for, mix64, ragged, slices, texts_as_bytes, written

LENGTH = 100
GRAM = 32
PIECE = 1 << 20
NO_ID = -(2**63)
UNIT = 128
HOT = UNIT * 32767  # what a counter of 15 bits can tell
RANGES = 1 << 14  # rows or buckets whose ranges are packed at once
_LETTERS = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9FB21C651E98DF25))
_FACTORS = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB)]


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the 32 bytes from each position on."""
    h, m = _LETTERS[data], 1
    for factor in _FACTORS:
        h = (h[:len(h) - m] ^ (h[:len(h) - m] >> np.uint64(31))) * factor + h[m:] if len(h) > m else h[:0]
        m *= 2
    return mix64(h)


def of_runs(pick, h: np.ndarray, width: int) -> np.ndarray:
    """Minimum or maximum of each `width` consecutive values."""
    m = 1
    while 2 * m <= width:
        h = pick(h[:-m], h[m:]) if len(h) > m else h[:0]
        m *= 2
    rest = width - m
    if rest:
        h = pick(h[:-rest], h[rest:]) if len(h) > rest else h[:0]
    return h


def own_repeats(grams: np.ndarray, least: np.ndarray, width: int) -> np.ndarray:
    """Hashes of least grams that stand twice within one window: strings of one segment may then be equal."""
    wide = np.r_[np.zeros(width - 1, np.uint64), least, np.zeros(width - 1, np.uint64)]
    at = np.flatnonzero(of_runs(np.maximum, wide, width) == grams)
    near = (np.diff(at) < width) & (grams[at[1:]] == grams[at[:-1]])
    return np.unique(grams[at[1:][near]])


def segments(texts: list[bytes], length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """(text, start, number of string starts, hash, may repeat itself, key of its bytes) of each run of starts with one least
    gram."""
    out = [[], [], [], [], [], []]
    width = length - GRAM + 1
    for a, b in slices([len(t) for t in texts], PIECE):
        lens = np.fromiter(map(len, texts[a:b]), np.int64, b - a)
        data = np.frombuffer(b"".join(texts[a:b]), np.uint8)
        if len(data) < length:
            continue
        grams = gram_hashes(data)
        least = of_runs(np.minimum, grams, width)
        number = np.maximum(0, lens - length + 1)
        begin = np.cumsum(lens) - lens
        at = ragged(begin, number)
        if not len(at):
            continue
        owner = np.repeat(np.arange(a, b), number)
        h = least[at]
        first = np.flatnonzero(np.r_[True, (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])])
        out[0].append(owner[first])
        out[1].append(at[first] - begin[owner[first] - a])
        out[2].append(np.diff(np.r_[first, len(at)]))
        out[3].append(h[first])
        out[4].append((out[2][-1] > width) | np.isin(h[first], own_repeats(grams, least, width)))
        total = np.r_[np.zeros(1, np.uint64), np.cumsum(grams)]
        out[5].append(total[at[first] + out[2][-1] + width - 1] - total[at[first]])
    kinds = (np.int64, np.int64, np.int64, np.uint64, bool, np.uint64)
    return tuple(np.concatenate(x) if x else np.zeros(0, k) for x, k in zip(out, kinds))


def two_stage_sort(text: np.ndarray, begin: np.ndarray, size: np.ndarray, number: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """Suffix array of the first `number` positions of each segment (and the few after them that induction needs). text
    holds the segments in order, each followed by one zero byte; begin and size tell where. Suffixes end with their
    segment and compare by `length` bytes at least."""
    t = text.astype(np.uint16) + np.uint16(1)
    stop = begin + size
    t[stop] = 0
    n = len(t)
    spot = np.arange(n)
    differs = np.r_[t[1:] != t[:-1], True]
    nxt = np.minimum.accumulate(np.where(differs, spot, n)[::-1])[::-1]  # next position whose successor differs
    rising = np.r_[t[:-1] < t[1:], False]
    small = rising[nxt]  # smaller than the successor
    ends = small | (t == 0)
    next_end = np.minimum.accumulate(np.where(ends, spot, n - 1)[::-1])[::-1]
    last = next_end[begin + number - 1]
    ranked = np.zeros(n + 1, np.int32)
    np.add.at(ranked, begin, 1)
    np.add.at(ranked, last + 1, -1)
    ranked = ranked[:n].cumsum() > 0

    # stage one: direct sort of the small suffixes
    direct = np.flatnonzero(ranked & small & (t > 0))
    padded = np.r_[text, np.zeros(length, np.uint8)]
    keys = np.lib.stride_tricks.sliding_window_view(padded, length)[direct]
    left = np.repeat(stop, size + 1)[direct] - direct
    cut = np.flatnonzero(left < length)
    if len(cut):
        keys[cut] *= np.arange(length) < left[cut, None]
    order = np.argsort(np.ascontiguousarray(keys).view(f"S{length}").ravel(), kind="stable")
    # equal but for closing zero bytes: their first letters still agree, unless the key is all zero bytes
    direct = direct[order]
    direct = direct[np.argsort(t[direct], kind="stable")]
    heads = np.searchsorted(t[direct], np.arange(258))

    # stage two: each suffix in turn induces a larger predecessor
    pending: list[list[np.ndarray]] = [[] for _ in range(257)]
    result = []
    for c in range(257):
        if c == 0:
            bucket = np.flatnonzero(ranked & (t == 0))
        else:
            wave = np.concatenate(pending[c]) if pending[c] else np.zeros(0, np.int64)
            parts = []
            while len(wave):
                parts.append(wave)
                back = wave - 1
                wave = back[(back >= 0) & (t[back] == c) & ranked[back]]
            parts.append(direct[heads[c]:heads[c + 1]])
            bucket = np.concatenate(parts)
        pending[c] = []
        if not len(bucket):
            continue
        if c:
            result.append(bucket)
        back = bucket[bucket > 0] - 1
        back = back[(t[back] > c) & ranked[back]]
        if len(back):
            letter = t[back]
            order = np.argsort(letter, kind="stable")
            back, letter = back[order], letter[order]
            edge = np.flatnonzero(np.r_[True, letter[1:] != letter[:-1]])
            for s, e in zip(edge, np.r_[edge[1:], len(back)]):
                pending[int(letter[s])].append(back[s:e])
    return np.concatenate(result) if result else np.zeros(0, np.int64)


def common_prefixes(text: np.ndarray, order: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """Bytes that each entry shares with the one before it, up to `length`; the first has 0."""
    padded = np.r_[text, np.zeros(length + 16, np.uint8)]
    words = np.lib.stride_tricks.as_strided(padded.view(np.uint8), (len(text) + length, 8), (1, 1))
    out = np.zeros(len(order), np.int64)
    live = np.arange(1, len(order))
    for k in range(0, length, 8):
        if not len(live):
            break
        x = words[order[live] + k].copy().view(np.uint64).ravel() ^ words[order[live - 1] + k].copy().view(np.uint64).ravel()
        same = x == 0
        rest = x[~same]
        low = np.bitwise_count((rest & (~rest + np.uint64(1))) - np.uint64(1)).astype(np.int64) // 8
        out[live[~same]] = k + low
        out[live[same]] = k + 8
        live = live[same]
    return np.minimum(out, length)


def repeats(text: np.ndarray, begin: np.ndarray, size: np.ndarray, number: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """Whether the string at each position of text is a window that occurs at an earlier position."""
    window = np.zeros(len(text), bool)
    window[ragged(begin, number)] = True
    order = two_stage_sort(text, begin, size, number, length)
    order = order[window[order]]
    out = np.zeros(len(text), bool)
    if len(order):
        head = np.flatnonzero(common_prefixes(text, order, length) < length)
        first = np.minimum.reduceat(order, head)
        out[order] = order != np.repeat(first, np.diff(np.r_[head, len(order)]))
    return out


def runs_of(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.flatnonzero(np.diff(np.r_[False, flags, False].astype(np.int8)))
    return edge[::2], edge[1::2]


def joined_starts(starts: np.ndarray, owners: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(owner, first start, number) of each run of consecutive starts of one owner."""
    head = np.flatnonzero(np.r_[True, (owners[1:] != owners[:-1]) | (starts[1:] != starts[:-1] + 1)])
    return owners[head], starts[head], np.diff(np.r_[head, len(starts)])


def _by_bucket(h: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    bucket = (h % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    edge = np.flatnonzero(np.diff(np.r_[-1, bucket[order]]))
    for s, e in zip(edge, np.r_[edge[1:], len(order)]):
        yield int(bucket[order[s]]), order[s:e]


def _pack(x: np.ndarray, kind=np.int64) -> bytes:
    return np.ascontiguousarray(x, kind).tobytes()


def _packs(ids: np.ndarray, tags: np.ndarray, values: np.ndarray, parts: int) -> list[tuple]:
    """One FOUND row for each part of the documents: its documents, how many values each has, and the values in turn."""
    if not len(ids):
        return []
    part = (mix64(ids.view(np.uint64) ^ mix64(tags.view(np.uint64))) % np.uint64(parts)).astype(np.int64)
    order = np.lexsort((tags, ids, part))
    ids, tags, part, values = ids[order], tags[order], part[order], values[order]
    doc = np.flatnonzero(np.r_[True, (ids[1:] != ids[:-1]) | (tags[1:] != tags[:-1])])
    sizes = np.diff(np.r_[doc, len(ids)])
    edge = np.flatnonzero(np.r_[True, np.diff(part[doc]) != 0])
    rows = []
    for s, e in zip(edge.tolist(), [*edge[1:].tolist(), len(doc)]):
        d = doc[s:e]
        rows.append((int(part[d[0]]), _pack(ids[d]), _pack(tags[d]), _pack(sizes[s:e]), np.ascontiguousarray(values[d[0]:d[-1] + sizes[e - 1]]).tobytes()))
    return rows


def _per_document(packs: DataFrame, parts: int, width: int) -> DataFrame:
    """(id, tag, found): one row per document from FOUND rows, whose values have `width` bytes."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        got = [r for pdf in batches for r in pdf.itertuples(index=False)]
        if not got:
            return
        ids, tags, sizes = (np.frombuffer(b"".join(getattr(r, c) for r in got), np.int64) for c in ("ids", "tags", "sizes"))
        values = np.frombuffer(b"".join(r.found for r in got), f"V{width}")
        got = []
        starts = np.cumsum(sizes) - sizes
        order = np.lexsort((tags, ids))
        ids, tags, sizes = ids[order], tags[order], sizes[order]
        values = values[ragged(starts[order], sizes)]
        head = np.flatnonzero(np.r_[True, (ids[1:] != ids[:-1]) | (tags[1:] != tags[:-1])])
        stop = np.cumsum(sizes)[np.r_[head[1:], len(ids)] - 1]
        begin = np.r_[0, stop[:-1]]
        for a, b in slices((stop - begin).tolist(), 1 << 20):
            yield pd.DataFrame({"id": ids[head[a:b]], "tag": tags[head[a:b]], "found": [values[s:e].tobytes() for s, e in zip(begin[a:b], stop[a:b])]})

    return packs.repartition(parts, "part").mapInPandas(run, "id long, tag long, found binary")


HASHES = "bucket int, hashes binary, ids binary, tags binary, known binary"  # known: 32768 if so, and UNITs of distinct bytes
FOUND = "part int, ids binary, tags binary, sizes binary, found binary"
FOUND_COLUMNS = ["part", "ids", "tags", "sizes", "found"]
SEGMENTS = "bucket int, text binary, sizes binary, numbers binary, ids binary, tags binary, starts binary, kind int"
PIECES, DONE, STRINGS = 0, 1, 2  # kinds of SEGMENTS rows


def removals(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(doc_id, text, found): every row with the byte ranges (from, to pairs, packed) that go from it."""
    spark = docs.sparkSession
    parts = buckets_for(spark)
    buckets = 8 * parts
    hot_units = -(-HOT // UNIT)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    # both joins below use these three columns, so the texts are shuffled once
    rows = rows.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), F.xxhash64("text").alias("tag"), "text")

    def hashes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts, ids, tags = texts_as_bytes(pdf["text"]), pdf["id"].to_numpy(np.int64), pdf["tag"].to_numpy(np.int64)
            for a, b in slices([len(t) for t in texts], 4 * PIECE):
                owner, _, number, h, own, key = segments(texts[a:b], length)
                if not len(h):
                    continue
                order = np.lexsort((key, h))
                h, owner, own, key, number = h[order], owner[order] + a, own[order], key[order], number[order]
                head = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
                other = np.r_[True, (h[1:] != h[:-1]) | (key[1:] != key[:-1])]
                units = -(-np.add.reduceat(np.where(other, number + length - 1, 0), head) // UNIT)
                many = (np.diff(np.r_[head, len(h)]) > 1) | np.logical_or.reduceat(own, head)
                # hashes that repeat here are known; one entry of each tells the others
                again = np.repeat(many, np.diff(np.r_[head, len(h)]))
                if again.any():
                    own = [(-1 - k, found, i, t, n) for k, i, t, n, found in _packs(ids[owner[again]], tags[owner[again]], h[again], parts)]
                    yield pd.DataFrame(own, columns=["bucket", "hashes", "ids", "tags", "known"])
                h1, o1 = h[head], owner[head]
                known = (np.minimum(units, 32767) + 32768 * many).astype(np.uint16)
                out = [(k, _pack(h1[w], np.uint64), _pack(ids[o1[w]]), _pack(tags[o1[w]]), known[w].tobytes()) for k, w in _by_bucket(h1, buckets)]
                yield pd.DataFrame(out, columns=["bucket", "hashes", "ids", "tags", "known"])

    def meet(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        got = []
        for pdf in batches:
            own = pdf[pdf["bucket"] < 0]
            if len(own):
                yield pd.DataFrame({"part": -1 - own["bucket"], "ids": own["ids"], "tags": own["tags"], "sizes": own["known"], "found": own["hashes"]})
            got += list(pdf[pdf["bucket"] >= 0].itertuples(index=False))
        if not got:
            return
        h = np.frombuffer(b"".join(r.hashes for r in got), np.uint64)
        ids, tags = np.frombuffer(b"".join(r.ids for r in got), np.int64), np.frombuffer(b"".join(r.tags for r in got), np.int64)
        known = np.frombuffer(b"".join(r.known for r in got), np.uint16)
        units, known = (known & 32767).astype(np.int64), known >= 32768
        order = np.argsort(h, kind="stable")
        head = np.flatnonzero(np.r_[True, h[order][1:] != h[order][:-1]])
        count = np.diff(np.r_[head, len(h)])
        keep = order[np.repeat((count > 1) | np.logical_or.reduceat(known[order], head), count)]
        keep = keep[~known[keep]]
        hot = h[order[head[np.add.reduceat(units[order], head) >= hot_units]]]
        if len(hot):
            yield pd.DataFrame([(-1, b"", b"", b"", _pack(hot, np.uint64))], columns=FOUND_COLUMNS)
        yield pd.DataFrame(_packs(ids[keep], tags[keep], h[keep], parts), columns=FOUND_COLUMNS)

    spread = F.when(F.col("bucket") < 0, F.hash("ids")).otherwise(F.col("bucket"))
    repeated = rows.select("id", "tag", "text").mapInPandas(hashes, HASHES).repartition(parts, spread).mapInPandas(meet, FOUND)
    repeated = written(repeated, "repeated")
    hot_hashes = np.sort(np.frombuffer(b"".join(bytes(r["found"]) for r in repeated.filter("part < 0").select("found").collect()), np.uint64))
    shared_hot = broadcast_object(spark, hot_hashes)
    listed = _per_document(repeated.filter("part >= 0"), parts, 8)
    with_hashes = rows.join(listed, ["id", "tag"]).select("id", "tag", "text", "found")

    columns = ["bucket", "text", "sizes", "numbers", "ids", "tags", "starts", "kind"]

    def strings(texts, ids, tags, owner, start, number) -> Iterator[pd.DataFrame]:
        """The strings of hot segments by digest: the first of each, and where the others stand."""
        at, who = ragged(start, number), np.repeat(owner, number)
        digests = [hashlib.blake2b(texts[o][s:s + length], digest_size=16).digest() for o, s in zip(who.tolist(), at.tolist())]
        place: dict[bytes, int] = {}
        first = np.fromiter((place.setdefault(d, i) == i for i, d in enumerate(digests)), bool, len(digests))
        dup, one = np.flatnonzero(~first), np.flatnonzero(first)
        rows = []
        if len(dup):
            o, s, n = joined_starts(at[dup], who[dup])
            rows.append((-1, b"", b"", _pack(n), _pack(ids[o]), _pack(tags[o]), _pack(s), DONE))
        words = np.frombuffer(b"".join(digests), np.uint64)[::2]
        for k, w in _by_bucket(words[one], parts):
            w = one[w]
            rows.append((k, b"".join(digests[i] for i in w), b"", b"", _pack(ids[who[w]]), _pack(tags[who[w]]), _pack(at[w]), STRINGS))
        yield pd.DataFrame(rows, columns=columns)

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hot = shared_hot()
        for pdf in batches:
            pdf = pdf.drop_duplicates(["id", "tag"]).sort_values(["id", "tag"])
            texts, ids, tags = texts_as_bytes(pdf["text"]), pdf["id"].to_numpy(np.int64), pdf["tag"].to_numpy(np.int64)
            wanted = [np.unique(np.frombuffer(x, np.uint64)) for x in pdf["found"]]
            for a, b in slices([len(t) for t in texts], 4 * PIECE):
                owner, start, number, h, _, _ = segments(texts[a:b], length)
                edge = np.searchsorted(owner, np.arange(b - a + 1))
                keep = np.concatenate([np.isin(h[edge[i]:edge[i + 1]], wanted[a + i]) for i in range(b - a)] or [np.zeros(0, bool)])
                owner, start, number, h = owner[keep] + a, start[keep], number[keep], h[keep]
                often = np.isin(h, hot)
                if often.any():
                    yield from strings(texts, ids, tags, owner[often], start[often], number[often])
                    owner, start, number, h = owner[~often], start[~often], number[~often], h[~often]
                seen: dict[bytes, bool] = {}
                first = np.ones(len(owner), bool)
                pieces = []
                for i, (o, s, n) in enumerate(zip(owner.tolist(), start.tolist(), number.tolist())):
                    x = texts[o][s:s + n + length - 1]
                    if x in seen:
                        first[i] = False
                    else:
                        seen[x] = True
                    pieces.append(x)
                dup = np.flatnonzero(~first)
                if len(dup):  # the same bytes stand earlier in this very batch
                    yield pd.DataFrame([(-1, b"", b"", _pack(number[dup]), _pack(ids[owner[dup]]), _pack(tags[owner[dup]]), _pack(start[dup]), DONE)],
                                       columns=columns)
                one = np.flatnonzero(first)
                out = []
                for k, w in _by_bucket(h[one], buckets):
                    w = one[w]
                    out.append((k, b"".join(pieces[i] for i in w), _pack([len(pieces[i]) for i in w]), _pack(number[w]),
                                _pack(ids[owner[w]]), _pack(tags[owner[w]]), _pack(start[w]), PIECES))
                yield pd.DataFrame(out, columns=columns)

    def sort(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[int, list] = {}
        hot = []
        ready: list[tuple] = []  # ids, tags, starts and ends of ranges

        def packed(least: int) -> Iterator[pd.DataFrame]:
            if len(ready) >= least:
                ids, tags, starts, ends = (np.concatenate(x) for x in zip(*ready))
                ready.clear()
                yield pd.DataFrame(_packs(ids, tags, np.column_stack([starts, ends]).astype(np.int64), parts), columns=FOUND_COLUMNS)

        for pdf in batches:
            for r in pdf.itertuples(index=False):
                if r.kind == DONE:
                    ids, tags, starts, numbers = (np.frombuffer(x, np.int64) for x in (r.ids, r.tags, r.starts, r.numbers))
                    ready.append((ids, tags, starts, starts + numbers - 1 + length))
                    yield from packed(RANGES)
                elif r.kind == STRINGS:
                    hot.append(r)
                else:
                    held.setdefault(r.bucket, []).append(r)
        if hot:
            ids, tags, starts = (np.frombuffer(b"".join(getattr(r, c) for r in hot), np.int64) for c in ("ids", "tags", "starts"))
            low, high = np.frombuffer(b"".join(r.text for r in hot), np.uint64).reshape(-1, 2).T
            hot = []
            order = np.lexsort((starts, tags, ids, high, low))
            ids, tags, starts, low, high = (x[order] for x in (ids, tags, starts, low, high))
            head = np.flatnonzero(np.r_[True, (low[1:] != low[:-1]) | (high[1:] != high[:-1])])
            size = np.diff(np.r_[head, len(low)])
            # equal rows send equal strings, so the first may stand there again
            late = np.any([x != np.repeat(x[head], size) for x in (ids, tags, starts)], axis=0)
            if late.any():
                ready.append((ids[late], tags[late], starts[late], starts[late] + length))
        for bucket in list(held):
            got = held.pop(bucket)
            raw = np.frombuffer(b"".join(r.text for r in got), np.uint8)
            size, number, ids, tags, starts = (np.frombuffer(b"".join(getattr(r, c) for r in got), np.int64) for c in ("sizes", "numbers", "ids", "tags", "starts"))
            origin = np.cumsum(size) - size
            order = np.lexsort((starts, tags, ids))
            new = np.r_[True, np.any([np.diff(x[order]) != 0 for x in (ids, tags, starts)], axis=0)]
            order = order[new]  # equal rows of several batches or tasks send equal segments
            size, number, ids, tags, starts, origin = (x[order] for x in (size, number, ids, tags, starts, origin))
            begin = np.cumsum(size + 1) - size - 1
            text = np.zeros(int((size + 1).sum()), np.uint8)
            text[ragged(begin, size)] = raw[ragged(origin, size)]
            a, b = runs_of(repeats(text, begin, size, number, length))
            if len(a):
                seg = np.searchsorted(begin, a, side="right") - 1
                ready.append((ids[seg], tags[seg], starts[seg] + a - begin[seg], starts[seg] + b - 1 - begin[seg] + length))
                yield from packed(RANGES)
        yield from packed(1)

    spread = F.when(F.col("bucket") < 0, F.hash("ids")).otherwise(F.col("bucket"))
    gone = _per_document(with_hashes.mapInPandas(cut, SEGMENTS).repartition(parts, spread).mapInPandas(sort, FOUND), parts, 16)
    doc_id = F.when(F.col("id") != NO_ID, F.col("id")).alias("doc_id")
    return rows.join(gone, ["id", "tag"], "left").select(doc_id, "text", "found")


def kept_bytes(data: bytes, found) -> tuple[bytes, int, int]:
    """What is left of a text, the number of removed bytes, and of removed runs."""
    if found is None or not len(found):
        return data, 0, 0
    pairs = np.frombuffer(found, np.int64).reshape(-1, 2)
    edge = np.zeros(len(data) + 1, np.int64)
    np.add.at(edge, pairs[:, 0], 1)
    np.add.at(edge, pairs[:, 1], -1)
    gone = edge[:-1].cumsum() > 0
    runs = int(np.count_nonzero(np.diff(np.r_[False, gone].astype(np.int8)) == 1))
    return np.frombuffer(data, np.uint8)[~gone].tobytes(), int(gone.sum()), runs


def _by_text_ids(rows: DataFrame, run, columns: str) -> DataFrame:
    """mapInPandas with ids as text: pandas would make floats of them beside a null."""
    rows = rows.withColumn("doc_id", F.col("doc_id").cast("string"))
    return rows.mapInPandas(run, f"doc_id string, {columns}").withColumn("doc_id", F.col("doc_id").cast("long"))


def deduplicated(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(doc_id, kept): the bytes left of every row's text."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "kept": [kept_bytes(t, f)[0] for t, f in zip(texts_as_bytes(pdf["text"]), pdf["found"])]})

    return _by_text_ids(removals(docs, length), run, "kept binary")


def removal_report(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every row."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for t, f in zip(texts_as_bytes(pdf["text"]), pdf["found"]):
                kept, gone, spans = kept_bytes(t, f)
                rows.append((len(t), gone, spans, hashlib.sha256(kept).hexdigest()))
            out = pd.DataFrame(rows, columns=["n_bytes", "n_removed", "n_spans", "kept_sha256"])
            out.insert(0, "doc_id", pdf["doc_id"].to_numpy())
            yield out

    return _by_text_ids(removals(docs, length), run, "n_bytes long, n_removed long, n_spans long, kept_sha256 string")
