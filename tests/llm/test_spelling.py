"""Spelling variants against brute force."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from lexspark.llm import spelling

SCHEMA = "doc_id long, text string, lang string, word string, n long, m int, part int, key long, own int, form string, root string, near string"


def table(spark, texts, ids=None):
    rows = [((ids or range(len(texts)))[i], t, "en", "w", 1, 2, 3, 4, 5, "f", "r", "x") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def brute_words(texts, ids):
    out = Counter()
    for i, t in zip(ids, texts):
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            out[run] += 1
    return {w: n for w, n in out.items() if len(w) >= 7 and n >= 2}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(texts, ids=None):
    n = brute_words(texts, ids or range(len(texts)))
    near = {w: [v for v in n if v != w and one_edit(v, w)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 10 * n[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return {(w, form[w], root(w), n[w], len(near[w]), n[form[w]] if form[w] else None) for w in n}


def texts_of(seed):
    r = random.Random(seed)
    base = ["".join(r.choice("abéÿß") for _ in range(r.randint(6, 9))) for _ in range(30)]
    base += ["aaaaaaa", "aaaaaaaa", "aaaaaaaaa", "abababab", "babababa", "x" * 300, "x" * 301, "x" * 299 + "y"]
    words = []
    for w in base:
        words += [w] * r.choice([1, 2, 25, 400])
        for _ in range(4):
            i = r.randrange(len(w))
            words += [r.choice([w[:i] + w[i + 1:], w[:i] + "q" + w[i:], w[:i] + "z" + w[i + 1:], w + w[-1]])] * r.choice([1, 2, 3, 30])
    r.shuffle(words)
    words = [w.upper() if i % 7 == 0 and w.isascii() else w for i, w in enumerate(words)]
    out, i = [], 0
    while i < len(words):
        k = r.randint(1, 40)
        out.append(r.choice([" ", "-", "\n", "1", "Ā"]).join(words[i:i + k]))
        i += k
    return out + [None, "", "   ", "short", out[0], out[0]]


@pytest.mark.parametrize("seed", [1, 2])
def test_spelling_equals_brute_force(spark, seed):
    texts = texts_of(seed)
    got = [tuple(r) for r in spelling.spelling_variants(table(spark, texts)).collect()]
    assert len(got) == len(set(got)) and set(got) == brute(texts)
    assert any(r[1] for r in got) and max(r[4] for r in got) > 3


def test_spelling_with_tiles_smaller_than_blocks(spark, monkeypatch):
    monkeypatch.setattr(spelling, "TILE", 3)
    monkeypatch.setattr(spelling, "CELLS", 20)
    texts = texts_of(3)
    got = [tuple(r) for r in spelling.spelling_variants(table(spark, texts)).collect()]
    assert len(got) == len(set(got)) and set(got) == brute(texts)


def test_spelling_of_odd_ids_and_empty_tables(spark):
    big = 2**53 + 1
    texts = ["something somethin"] * 40 + ["Something"]
    ids = [None, None, *(big + 2 * i for i in range(38)), -5]
    got = {tuple(r) for r in spelling.spelling_variants(table(spark, texts, ids)).collect()}
    assert got == brute(texts, ids)
    assert spelling.spelling_variants(table(spark, texts).filter("false")).collect() == []
    assert spelling.spelling_variants(table(spark, [None, "", "a b c"])).collect() == []


def test_a_chain_of_forms_leads_to_its_last(spark):
    chain = [(f"abcdefgh{'i' * k}", 2 * 10**k) for k in range(4)]
    links = spark.createDataFrame([(a, b) for (a, _), (b, _) in zip(chain, chain[1:])], "word string, form string")
    assert {tuple(r) for r in spelling.roots(links).collect()} == {(w, chain[-1][0]) for w, _ in chain[:-1]}


def test_near_pairs_count_once():
    words = ["aaaaaaa", "aaaaaaaa"]
    found = 0
    for part in range(spelling.PARTS):
        i, _ = spelling.near_pairs(8, words, np.zeros(2, int), np.full(2, part), np.full(2, -1))
        found += len(i)
    assert found == 1
