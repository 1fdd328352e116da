"""Phrase collocations against brute force."""

import random
import re
from collections import Counter, defaultdict

import numpy as np

from lexspark.llm import collocations as col

SCHEMA = "doc_id long, text string, lang string, n long, k int, phrase string, score long, bound long, line long, salt int, rank int"


def table(spark, rows):
    return spark.createDataFrame([(i, t, lang, 1, 2, "p", 3, 4, 5, 6, 7) for i, (t, lang) in enumerate(rows)], SCHEMA).repartition(3)


def brute(rows, least, top):
    f = defaultdict(Counter)
    for text, lang in rows:
        lang = "und" if lang is None else lang
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            w = tuple(re.findall(r"[^\x20\x09]+", piece))
            for k in range(1, 5):
                f[lang].update(w[i:i + k] for i in range(len(w) - k + 1))
    out = []
    for lang, c in f.items():
        cands = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        swallow = Counter()
        for p, a in cands.items():
            for m in range(2, len(p)):
                for i in range(len(p) - m + 1):
                    swallow[p[i:i + m]] = max(swallow[p[i:i + m]], a)
        found = []
        for p, a in cands.items():
            if 100 * swallow[p] >= 80 * a:
                continue
            score, k = min((2000000 * a // (c[p[:k]] + c[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        n = sum(a for p, a in c.items() if len(p) == 1)
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return sorted(out)


def corpus(seed, n=120):
    r = random.Random(seed)
    words = ["".join(r.choice("abcdé") for _ in range(r.randint(1, 3))) for _ in range(25)]
    fixed = [" ".join(r.choice(words) + str(i) for _ in range(r.randint(2, 7))) for i in range(12)]
    rows = []
    for _ in range(n):
        parts = []
        for _ in range(r.randint(0, 30)):
            parts.append(r.choice(fixed) if r.random() < 0.3 else r.choice(words))
            if r.random() < 0.2:
                parts.append(r.choice([",", ". ", "\n", "\r", "\x0b", ";", "!", " \t "]))
        text = " ".join(parts)
        rows.append((text.upper() if r.random() < 0.1 and text.isascii() else text, r.choice(["en", "en", "fr", None, "und"])))
    return rows + [(None, "en"), ("", "fr"), (" \t ", None), ("a b a b \x00 x", "en"), ("only", "xx"), (None, "yy")]


def run(spark, monkeypatch, rows, least, top, depth=None):
    monkeypatch.setattr(col, "LEAST", least)
    monkeypatch.setattr(col, "TOP", top)
    monkeypatch.setattr(col, "DEPTH", depth or 2 * top)
    return sorted(tuple(r) for r in col.collocations(table(spark, rows)).collect())


def test_collocations_equal_brute_force(spark, monkeypatch):
    rows = corpus(1)
    assert run(spark, monkeypatch, rows, 3, 2000) == brute(rows, 3, 2000)


def test_growth_stops_at_the_line(spark, monkeypatch):
    rows = corpus(2)
    got = run(spark, monkeypatch, rows, 3, 12)
    assert got == brute(rows, 3, 12) and Counter(r[0] for r in got)["en"] == 12


def test_a_line_too_high_is_lowered(spark, monkeypatch):
    rows = corpus(3)
    assert run(spark, monkeypatch, rows, 3, 40, depth=2) == brute(rows, 3, 40)


def test_repeated_texts_tie(spark, monkeypatch):
    rows = [("one two three four five six. seven eight", "en")] * 30 + [("one two", "en")] * 8
    got = run(spark, monkeypatch, rows, 30, 3)
    assert got == brute(rows, 30, 3)


def test_empty_tables(spark):
    assert col.collocations(table(spark, [("a b", "en")]).filter("false")).collect() == []
    assert col.collocations(table(spark, [(None, "en"), ("", None), ("a b c", "en")])).collect() == []


def test_full_tables_change_nothing(spark, monkeypatch):
    rows = corpus(4, 40)
    monkeypatch.setattr(col, "TABLE_BITS", col.SLOTS * 8)
    assert run(spark, monkeypatch, rows, 3, 10) == brute(rows, 3, 10)


def test_scores_beyond_64_bits(spark):
    a = 2**62
    got = spark.createDataFrame([(a, a, a - 1)], "a long, l long, r long").select(col.ratio("a", col._wide("l") + col._wide("r"))).collect()[0][0]
    assert got == 2000000 * a // (2 * a - 1)


def test_tables_hold_their_members(spark):
    grow = spark.createDataFrame([(0, "en", f"a{i} b") for i in range(500)] + [(1, "fr", "x y z")], "side int, lang string, phrase string")
    right, left = col.bit_tables(grow)
    piece = col.Piece("en", [" ".join(f"a{i} b" for i in range(500)).encode()])
    at = np.flatnonzero(piece.whole(2))
    held = right.holds(piece.hashes(2)[at])
    assert held[::2].all() and held[1::2].sum() < 5
    assert left.holds(col.Piece("fr", [b"x y z"]).hashes(3)[1:2]).all()


def test_phrases_count_alike_in_a_wide_vocabulary():
    text = " ".join(f"w{i % 70000}" for i in range(70010)).encode()
    piece = col.Piece("en", [text])
    at = np.flatnonzero(piece.whole(4))
    got = piece.counted(4, at)
    assert len(piece.words)**4 >= 1 << 63
    assert sorted(got["f"].to_pylist())[-8:] == [1, 2, 2, 2, 2, 2, 2, 2] and sum(got["f"].to_pylist()) == len(at)
