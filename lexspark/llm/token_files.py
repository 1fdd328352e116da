"""Token ids in bit-plane files.

Every text is encoded, an end id is appended, and ids are written in ascending id order. A file row (chunk) holds whole
documents; its ids are cut into blocks of `BLOCK` ids, each block is transposed into byte planes (or bit planes), so that
bytes of like weight lie together, and each plane is compressed with zstandard by itself. Beside the chunks lies the chunk
index: where each chunk's ids begin and how many ids and documents it has. Spark writes both tables, so any shared file
system will do and a lost task is written again; a chunk is decoded without any other.

Placing: documents are range-partitioned by id and sorted, each task writes one shard. Starts come from the index, a
running sum within the shard plus one total per shard.

Defined cases: null and empty texts give the end id alone; a text of any length is one chunk of many blocks; rows with
the same id lie side by side, and get starts in the order of their text; rows with a null id come first; an empty table
gives an empty file; extra columns are never read.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import chain, compress, pairwise, repeat
from operator import attrgetter

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from tokenizers import Tokenizer

from lexspark.llm.common import ragged, shared_folder, slices, small_batches
from lexspark.llm.token_counts import PRE_TOKEN, byte_letters, check_settings

BLOCK = 8192
CHUNK_IDS = 1 << 17
BATCH_CHARS = 4_000_000
MEMO = 64_000_000
CHUNK_SCHEMA = "shard int, chunk int, doc_ids array<long>, doc_lens array<long>, widths int, n_ids long, planes array<binary>"


def to_planes(ids: np.ndarray, bits: bool = False) -> list[bytes]:
    """Planes of one block of unsigned 32-bit ids, compressed one by one: 4 byte planes, or 32 bit planes."""
    raw = np.ascontiguousarray(ids.astype("<u4")).view(np.uint8).reshape(-1, 4)
    pack = zstandard.ZstdCompressor(level=1)
    if not bits:
        return [pack.compress(np.ascontiguousarray(raw[:, k]).tobytes()) for k in range(4)]
    wide = np.unpackbits(raw, axis=1, bitorder="little")
    return [pack.compress(np.packbits(wide[:, k], bitorder="little").tobytes()) for k in range(32)]


def from_planes(planes: list[bytes], n: int) -> np.ndarray:
    """The ids of one block; the number of planes tells their kind."""
    unpack = zstandard.ZstdDecompressor()
    raw = [np.frombuffer(unpack.decompress(p), np.uint8) for p in planes]
    if len(planes) == 4:
        return np.column_stack(raw).reshape(-1).view("<u4")
    wide = np.column_stack([np.unpackbits(p, count=n, bitorder="little") for p in raw])
    return np.packbits(wide, axis=1, bitorder="little").reshape(-1).view("<u4")


def chunk_planes(ids: np.ndarray, bits: bool = False) -> list[bytes]:
    return [p for a in range(0, len(ids), BLOCK) for p in to_planes(ids[a:a + BLOCK], bits)]


def chunk_ids(planes: list[bytes], n: int, width: int) -> np.ndarray:
    blocks = [from_planes(planes[k * width:(k + 1) * width], min(BLOCK, n - k * BLOCK)) for k in range(len(planes) // width)]
    return np.concatenate(blocks) if blocks else np.zeros(0, "<u4")


@dataclass
class Pool:
    """Named runs of ids."""

    names: dict[bytes, int] = field(default_factory=dict)
    ids: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint32))
    starts: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    sizes: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    again: np.ndarray = field(default_factory=lambda: np.zeros(0, bool))  # found since it was added or last kept
    held: int = 0  # bytes, about

    def add(self, names: list[bytes], ids: np.ndarray, sizes: np.ndarray) -> None:
        self.names.update(zip(names, range(len(self.names), len(self.names) + len(names))))
        self.starts = np.r_[self.starts, len(self.ids) + np.cumsum(sizes) - sizes]
        self.sizes = np.r_[self.sizes, sizes]
        self.ids = np.r_[self.ids, ids.astype(np.uint32)]
        self.again = np.r_[self.again, np.zeros(len(names), bool)]
        self.held += sum(map(len, names)) + 4 * len(ids) + 150 * len(names)

    def find(self, names: list[bytes]) -> np.ndarray:
        """The number of each name, or -1."""
        where = np.fromiter(map(self.names.get, names, repeat(-1)), np.int64, len(names))
        self.again[where[where >= 0]] = True
        return where

    def of(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the runs in turn, and their sizes."""
        sizes = self.sizes[which]
        return self.ids[ragged(self.starts[which], sizes)], sizes

    def kept(self) -> Pool:
        """A new pool of the runs found again."""
        pool = Pool()
        pool.add([*compress(self.names, self.again.tolist())], *self.of(np.flatnonzero(self.again)))
        return pool


def bytes_of(strings: pa.LargeStringArray) -> list[bytes]:
    if not len(strings):
        return []
    _, bounds, data = strings.buffers()
    data = data.to_pybytes()
    return [data[a:b] for a, b in pairwise(np.frombuffer(bounds, np.int64, len(strings) + 1, 8 * strings.offset).tolist())]


#: What the pre-token pattern tells apart.
SPACE, LETTER, DIGIT, OTHER = range(4)
KINDS = regex.compile(r"(\s)|(\p{L})|(\p{N})|(.)", regex.DOTALL)


def kinds_of(chars: str) -> np.ndarray:
    return np.fromiter((m.lastindex - 1 for m in KINDS.finditer(chars)), np.uint8, len(chars))


#: Of each byte that is a character; the bytes of the others are looked up as a whole.
BYTE_KIND = np.r_[kinds_of("".join(map(chr, range(128)))), np.full(128, OTHER, np.uint8)]


def byte_kinds(data: np.ndarray) -> np.ndarray:
    """The kind of the character that each byte of UTF-8 belongs to."""
    kind = BYTE_KIND[data]
    for begin in range(0, len(data), 1 << 22):  # bounds the memory of one long text
        lead = begin + np.flatnonzero(data[begin:begin + (1 << 22)] >= 0xC0)
        if not len(lead):
            continue
        size = 2 + (data[lead] >= 0xE0) + (data[lead] >= 0xF0).astype(np.int64)
        char = data[lead].astype(np.uint32)
        for k in (1, 2, 3):
            long = size > k
            char[long] = char[long] << 8 | data[lead[long] + k]
        distinct, which = np.unique(char, return_inverse=True)
        mine = kinds_of(b"".join(c.to_bytes(4, "big").lstrip(b"\0") for c in distinct.tolist()).decode("utf-8"))[which]
        for k in range(4):
            long = size > k
            kind[lead[long] + k] = mine[long]
    return kind


def pre_token_starts(data: np.ndarray, heads: np.ndarray) -> np.ndarray:
    """Where the matches of PRE_TOKEN begin in the bytes of several texts that begin at heads."""
    kind = byte_kinds(data)
    head = np.zeros(len(data) + 3, bool)
    head[heads] = True
    new = head[:len(data)].copy()
    new[1:] |= (kind[1:] != kind[:-1]) & (data[:-1] != 32)  # a space goes with what follows
    # the last of several white space characters, if more text follows, is cut off
    space = kind == SPACE
    last = 1 + np.flatnonzero(space[:-2] & space[1:-1] & ~space[2:])
    last = last[~head[last + 1]]
    for _ in range(3):  # to its first byte
        last = last - ((data[last] & 0xC0) == 0x80)
    new[last] = True
    # 's, 't, 'm, 'd, 're, 've, 'll after anything but a space or a character of the apostrophe's kind
    mark = np.flatnonzero(data == ord("'"))
    mark = mark[new[mark]]
    after = np.r_[data, np.zeros(3, np.uint8)]
    one, two = after[mark + 1], after[mark + 2]
    short = np.isin(one, [*b"stmd"]) & ~head[mark + 1]
    long = (np.isin(one, [*b"rv"]) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))) & ~head[mark + 1] & ~head[mark + 2]
    new[mark[short | long] + 1] = False
    rest = np.r_[mark[short] + 2, mark[long] + 3]
    new[rest[rest < len(data)]] = True
    return np.flatnonzero(new)


@dataclass
class WordEncoder:
    """Encodes whole texts with a byte-level file of the tokenizers library. The matches of the fixed pre-token pattern of
    such files are found in the bytes of all texts at once; each new one goes through the library's merge model once and is
    remembered. At more than MEMO bytes only those met again stay. A text that holds a special string goes to the library
    as it is."""

    path: str

    def __post_init__(self) -> None:
        with open(self.path, encoding="utf-8") as f:
            check_settings(json.load(f))
        self.tokenizer = Tokenizer.from_file(self.path)
        self.specials = tuple(t.content for t in self.tokenizer.get_added_tokens_decoder().values())
        self.pre = regex.compile(PRE_TOKEN)
        self.letters = dict(enumerate(byte_letters()))
        self.tokenize = self.tokenizer.model.tokenize
        self.words = Pool()

    def whole(self, text: str) -> bool:
        return any(s in text for s in self.specials)

    def cut(self, text: str) -> list[str]:
        return [text] if self.whole(text) else self.pre.findall(text)

    def units(self, texts: list[str]) -> tuple[pa.LargeStringArray, np.ndarray]:
        """What `cut` gives for all texts in turn, and the number of each text."""
        raw = [t.encode("utf-8") for t in texts]
        lens = np.fromiter(map(len, raw), np.int64, len(raw))
        ends = np.cumsum(lens)
        data = np.frombuffer(b"".join(raw), np.uint8)
        heads = (ends - lens)[lens > 0]
        starts = pre_token_starts(data, heads)
        whole = np.fromiter(map(self.whole, texts), bool, len(texts))
        if whole.any():
            starts = starts[~whole[np.searchsorted(ends, starts, "right")] | np.isin(starts, heads)]
        bounds = np.append(starts, len(data))
        cut = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(bounds), pa.py_buffer(data))
        return cut, np.diff(np.searchsorted(starts, np.r_[0, ends]))

    def learn(self, new: list[bytes], whole: set[bytes]) -> None:
        """Remember pre-tokens, or whole texts, not met before."""
        texts = [*whole.intersection(new)]
        ids = [np.array(self.tokenizer.encode(t.decode("utf-8"), add_special_tokens=False).ids, np.uint32) for t in texts]
        sizes = [np.fromiter(map(len, ids), np.int64, len(ids))]
        words = [w for w in new if w not in whole] if whole else new
        letters = b"".join(words).decode("latin-1").translate(self.letters)  # those of the model
        ends = np.cumsum([0, *map(len, words)]).tolist()
        for k in range(0, len(words), 1000):
            found = [self.tokenize(letters[a:b]) for a, b in pairwise(ends[k:k + 1001])]
            ids.append(np.fromiter(map(attrgetter("id"), chain.from_iterable(found)), np.uint32))
            sizes.append(np.fromiter(map(len, found), np.int64, len(found)))
        self.words.add(texts + words, np.concatenate(ids), np.concatenate(sizes))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in order, and the number of each text."""
        if self.words.held > MEMO:
            self.words = self.words.kept()
            if self.words.held > MEMO / 2:
                self.words = Pool()
        cut, number = self.units(texts)
        coded = cut.dictionary_encode()
        names = bytes_of(coded.dictionary)
        where = self.words.find(names)
        missing = np.flatnonzero(where < 0)
        if len(missing):
            late = [names[i] for i in missing.tolist()]
            self.learn(late, {t.encode("utf-8") for t in texts if self.whole(t)})
            where[missing] = np.fromiter(map(self.words.names.__getitem__, late), np.int64, len(late))
        where = where[coded.indices.to_numpy()]
        ids, sizes = self.words.of(where)
        sums, ends = np.r_[0, np.cumsum(sizes)], np.cumsum(number)
        return ids, sums[ends] - sums[ends - number]


@lru_cache(maxsize=1)
def shared_encoder(path: str, changed: int) -> WordEncoder:
    """One encoder for all tasks of a worker, with what it remembers, as long as the file is not changed."""
    return WordEncoder(path)


def write_tokens(docs: DataFrame, vocabulary: str, path: str, end_id: int = 0, bits: bool = False) -> None:
    """Write the files below path: `chunks` and `index`."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder, shard, chunk = shared_encoder(vocabulary, os.stat(vocabulary).st_mtime_ns), TaskContext.get().partitionId(), 0
        for pdf in batches:
            texts, keys = pdf["text"].tolist(), pdf["doc_id"].tolist()
            for a, b in slices([len(t) for t in texts], BATCH_CHARS):
                ids, lens = encoder.encode(texts[a:b])
                ends = np.cumsum(lens)
                all_ids = np.insert(ids, ends, end_id)  # after each text
                lens = lens + 1
                begin = 0
                for c, d in slices(lens.tolist(), CHUNK_IDS):
                    n = int(lens[c:d].sum())
                    mine = keys[a + c:a + d]
                    yield pd.DataFrame({
                        "shard": [shard], "chunk": [chunk], "doc_ids": [[None if x is None else int(x) for x in mine]], "doc_lens": [lens[c:d]],
                        "widths": [32 if bits else 4], "n_ids": [n], "planes": [chunk_planes(all_ids[begin:begin + n], bits)],
                    })
                    begin += n
                    chunk += 1

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    placed = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"))
    # ids travel as text: pandas would make floats of them beside a null
    placed = placed.select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    with small_batches(docs.sparkSession):
        placed.mapInPandas(run, CHUNK_SCHEMA).write.parquet(f"{path}/chunks")
    chunks = docs.sparkSession.read.schema(CHUNK_SCHEMA).parquet(f"{path}/chunks")
    within = Window.partitionBy("shard").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    index = chunks.select("shard", "chunk", "n_ids", F.size("doc_ids").alias("n_docs"), F.aggregate(
        "planes", F.lit(0).cast("long"), lambda n, p: n + F.length(p)).alias("n_bytes"))
    totals = index.groupBy("shard").agg(F.sum("n_ids").alias("total"))  # a row per shard
    before = F.coalesce(F.sum("total").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    index = index.withColumn("inside", F.coalesce(F.sum("n_ids").over(within), F.lit(0)))
    index.join(totals.select("shard", before.alias("base")), "shard").select(
        "shard", "chunk", (F.col("base") + F.col("inside")).alias("start"), "n_ids", "n_docs", "n_bytes",
    ).write.parquet(f"{path}/index")


def read_tokens(spark, path: str, visit: Callable[[np.ndarray], int], name: str) -> DataFrame:
    """One row per document from the files: doc_id, start, n_tokens, and `name`, what visit says of its ids."""
    chunks = spark.read.schema(CHUNK_SCHEMA).parquet(f"{path}/chunks")
    index = spark.read.parquet(f"{path}/index").select("shard", "chunk", "start")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for row in pdf.itertuples(index=False):
                ids = chunk_ids(list(row.planes), int(row.n_ids), int(row.widths))
                lens = np.asarray(row.doc_lens, np.int64)
                ends = np.cumsum(lens)
                yield pd.DataFrame({
                    "shard": row.shard, "chunk": row.chunk, "doc_id": pd.array([None if x is None else int(x) for x in row.doc_ids], dtype="Int64") if len(lens) else [],
                    "inside": ends - lens, "n_tokens": lens, name: [visit(ids[e - n:e]) for e, n in zip(ends, lens)],
                })

    found = chunks.withColumn("doc_ids", F.col("doc_ids").cast("array<string>")).mapInPandas(run, f"shard int, chunk int, doc_id long, inside long, n_tokens long, {name} long")
    return found.join(index, ["shard", "chunk"]).select("doc_id", (F.col("start") + F.col("inside")).alias("start"), "n_tokens", name)


def crc_of(ids: np.ndarray) -> int:
    return zlib.crc32(np.ascontiguousarray(ids, "<u4").tobytes())


def token_digest(docs: DataFrame, vocabulary: str) -> DataFrame:
    """Write the ids of docs to a new shared folder, read them back, and give each document's place and checksum."""
    path = f"{shared_folder(docs.sparkSession)}/tokens"
    write_tokens(docs, vocabulary, path)
    return read_tokens(docs.sparkSession, path, crc_of, "ids_crc32")
