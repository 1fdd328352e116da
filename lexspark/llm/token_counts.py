"""Token counts by rank-synchronous merging of ragged numpy arrays.

A text is cut into units at single spaces, units into pre-tokens, pre-tokens into byte symbols. All new pre-tokens of a
batch lie in one flat array with their lengths. In each round every sequence finds its lowest-ranked adjacent pair and
merges all its occurrences at once (left to right where they overlap); a sequence without a ranked pair is done, and
its surviving symbols are its token count. In a merge list learned step by step, a pair that holds a new symbol always
ranks after the pair that made it, so merging all occurrences at once equals merging one at a time.

Counts of units already met are remembered up to `MEMO` units per task; that changes the speed only.

Defined cases: a null or empty text has 0 tokens and 0 bytes; special strings of the vocabulary file inside a text are
one token each, as the library does by default; texts of any length are counted whole; repeated rows are counted each;
extra columns are never read.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexspark.llm.common import slices

MEMO = 400_000
BATCH_CHARS = 4_000_000
#: Fixed value: the byte-level pre-token pattern of this family of vocabularies.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
NO_PAIR = np.iinfo(np.int64).max


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = [""] * 256
    for b in plain:
        letters[b] = chr(b)
    for i, b in enumerate(b for b in range(256) if b not in set(plain)):
        letters[b] = chr(256 + i)
    return letters


def check_settings(spec: dict) -> None:
    """Stop at a file whose texts are normalised, prefixed or cut in another way than byte-level files do by default."""
    cutter, model = spec.get("pre_tokenizer") or {}, spec["model"]
    usual = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
    if spec.get("normalizer") is not None or any(cutter.get(k, v if k == "use_regex" else None) != v for k, v in usual.items()):
        raise ValueError("only byte-level files without a normaliser, without a prefix space and with the usual pattern")
    if model.get("type", "BPE") != "BPE" or any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")):
        raise ValueError("only plain byte-pair models")
    if any(t.get(k) for t in spec.get("added_tokens", []) for k in ("lstrip", "rstrip", "single_word", "normalized")):
        raise ValueError("only special strings that are matched as they stand")


@dataclass
class Merges:
    """Vocabulary as arrays: the symbol of each byte, and merge keys in order with their ranks and results."""

    byte_symbol: np.ndarray
    keys: np.ndarray
    ranks: np.ndarray
    results: np.ndarray
    width: int
    specials: tuple[str, ...] = ()

    @classmethod
    def from_json(cls, path: str) -> Merges:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        check_settings(spec)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        width = max(vocab.values()) + 1
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        left = np.array([vocab[a] for a, _ in pairs], np.int64)
        right = np.array([vocab[b] for _, b in pairs], np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        keys = left * width + right
        order = np.argsort(keys, kind="stable")
        specials = tuple(t["content"] for t in spec.get("added_tokens", []))
        symbols = np.array([vocab[c] for c in byte_letters()], np.int64)
        return cls(symbols, keys[order], np.arange(len(pairs))[order], made[order], width, specials)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Index into keys of each pair, or -1."""
        wanted = left * self.width + right
        at = np.searchsorted(self.keys, wanted)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == wanted, at, -1)


def survivors(merges: Merges, words: list[bytes]) -> np.ndarray:
    """Number of symbols left of each word when no ranked pair remains."""
    lens = np.fromiter(map(len, words), np.int64, len(words))
    counts = lens.copy()
    symbols = merges.byte_symbol[np.frombuffer(b"".join(words), np.uint8)]
    owner = np.repeat(np.arange(len(words)), lens)
    while len(symbols) > 1:
        inside = owner[1:] == owner[:-1]
        at = np.full(len(symbols) - 1, -1, np.int64)
        at[inside] = merges.find(symbols[:-1][inside], symbols[1:][inside])
        rank = np.where(at >= 0, merges.ranks[at], NO_PAIR)
        heads = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        least = np.minimum.reduceat(np.r_[rank, NO_PAIR], heads)
        # the pair that starts at a sequence's last symbol lies across its end and has no rank
        of_seq = np.repeat(least, np.diff(np.r_[heads, len(owner)]))
        merge = (rank == of_seq[:-1]) & (rank != NO_PAIR)
        # overlapping occurrences of one pair: the first, third, ... of each run
        spot = np.arange(len(merge))
        run_start = np.maximum.accumulate(np.where(merge & ~np.r_[False, merge[:-1]], spot, -1))
        merge &= (spot - run_start) % 2 == 0
        hit = np.flatnonzero(merge)
        symbols[hit] = merges.results[at[hit]]
        keep = np.ones(len(symbols), bool)
        keep[hit + 1] = False
        live = of_seq != NO_PAIR
        done = heads[least == NO_PAIR]
        if len(done):
            ids, n = np.unique(owner[~live], return_counts=True)
            counts[ids] = n
        keep &= live
        symbols, owner = symbols[keep], owner[keep]
    if len(symbols):
        counts[owner] = 1
    return counts


@dataclass
class Counter:
    """Counts tokens of whole texts; remembers units."""

    merges: Merges
    known: dict[str, int] = field(default_factory=dict)
    words: dict[str, int] = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.pre = regex.compile(PRE_TOKEN)
        special = sorted(self.merges.specials, key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.gap = regex.compile(r"\s ")

    def units(self, text: str) -> list[str]:
        """Parts whose pre-tokens are those of the text in order. A space that follows white space may belong to a
        longer run, so such a text is one unit."""
        if not text:
            return []
        if text[0] == " " or self.gap.search(text):
            return [text]
        first, *rest = text.split(" ")
        return [first, *[" " + x for x in rest]]

    def counts_of(self, words: list[str]) -> np.ndarray:
        """Counts of the pre-tokens in the list."""
        codes, distinct = pd.factorize(np.array(words, object))
        fresh = [w for w in distinct if w not in self.words]
        self.words.update(zip(fresh, survivors(self.merges, [w.encode("utf-8") for w in fresh]).tolist()))
        return np.fromiter(map(self.words.__getitem__, distinct), np.int64, len(distinct))[codes]

    def simple(self, unit: str) -> bool:
        """One run of non-space, after one space at most, without special strings."""
        parts = unit.split()
        if len(parts) != 1 or len(unit) - len(parts[0]) != (unit[0] == " "):
            return False
        return not any(s in unit for s in self.merges.specials)

    def learn(self, fresh: list[str]) -> None:
        """Remember the counts of units not met before. Simple units are cut in one call with a line end between them:
        beside non-space a line end is always a pre-token of its own."""
        plain = [u for u in fresh if self.simple(u)]
        words = self.pre.findall("\n".join(plain))
        ends = [i for i, w in enumerate(words) if w == "\n"] + [len(words)]
        sizes = np.diff(np.array([-1, *ends])) - 1
        words = [w for w in words if w != "\n"]
        rest = list(set(fresh).difference(plain))
        n_special, more = [], []
        for unit in rest:
            pieces = self.special.split(unit) if self.special else [unit]
            n_special.append(len(pieces) - 1)
            before = len(words)
            for piece in pieces:
                words += self.pre.findall(piece)
            more.append(len(words) - before)
        sizes = np.r_[sizes, np.array(more, np.int64)] if plain else np.array(more, np.int64)
        sums = np.r_[0, np.cumsum(self.counts_of(words))]
        stop = np.cumsum(sizes)
        totals = sums[stop] - sums[stop - sizes]
        totals[len(plain):] += np.array(n_special, np.int64)
        self.known.update(zip(plain + rest, totals.tolist()))

    def count(self, texts: list[str]) -> np.ndarray:
        cut = [self.units(t) for t in texts]
        if len(self.known) > MEMO:
            self.known.clear()
            self.words.clear()
        fresh = set().union(*cut) - self.known.keys()
        if fresh:
            self.learn(list(fresh))
        get = self.known.__getitem__
        return np.fromiter((sum(map(get, c)) for c in cut), np.int64, len(cut))


def count_tokens(docs: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_bytes and n_tokens of each row's text."""
    kind = docs.schema[key].dataType  # keys travel as text: pandas would make floats of long ones beside a null

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counter = Counter(Merges.from_json(vocabulary))
        for pdf in batches:
            texts = pdf["t"].tolist()
            for a, b in slices([len(t) for t in texts], BATCH_CHARS):
                yield pd.DataFrame({"k": pdf["k"].iloc[a:b], "n_bytes": pdf["n_bytes"].iloc[a:b], "n_tokens": counter.count(texts[a:b])})

    t = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(key).cast("string").alias("k"), t.alias("t"), F.octet_length(t).cast("long").alias("n_bytes"))
    return rows.mapInPandas(run, "k string, n_bytes long, n_tokens long").withColumn("k", F.col("k").cast(kind)).withColumnRenamed("k", key)
