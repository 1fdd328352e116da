"""Ids of the token files against the library, on texts whose white space is of every kind, and settings that are refused."""

import json
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from lexspark.llm import token_files
from lexspark.llm.token_counts import Merges

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
LETTERS = [" ", " ", "\n", "\t", "\x1c", "\x85", "\xa0", "　", "\0", "a", "B", "é", "中", "1", "'", "'s", ".", "<|endoftext|>", "́", "½"]


@pytest.mark.parametrize("memo", [token_files.MEMO, 0])
def test_ids_equal_the_library(monkeypatch, memo):
    monkeypatch.setattr(token_files, "MEMO", memo)  # 0: nothing is remembered from one call to the next
    rnd = random.Random(3)
    texts = ["".join(rnd.choices(LETTERS, k=rnd.randint(0, 9))) for _ in range(4000)]
    want = [e.ids for e in Tokenizer.from_file(VOCABULARY).encode_batch(texts, add_special_tokens=False)]
    encoder = token_files.WordEncoder(VOCABULARY)
    for a in range(0, len(texts), 500):
        ids, lens = encoder.encode(texts[a:a + 500])
        assert lens.tolist() == [len(w) for w in want[a:a + 500]]
        assert ids.tolist() == np.concatenate(want[a:a + 500]).astype(int).tolist()


@pytest.mark.parametrize("key, value", [("normalizer", {"type": "NFC"}), ("pre_tokenizer", {"type": "ByteLevel", "add_prefix_space": True, "use_regex": True}),
                                        ("pre_tokenizer", {"type": "Whitespace"}), ("pre_tokenizer", None)])
def test_other_settings_are_refused(tmp_path, key, value):
    with open(VOCABULARY, encoding="utf-8") as f:
        spec = json.load(f)
    spec[key] = value
    path = tmp_path / "other.json"
    path.write_text(json.dumps(spec), encoding="utf-8")
    for read in (Merges.from_json, token_files.WordEncoder):
        with pytest.raises(ValueError):
            read(str(path))


def test_units_of_a_batch_are_those_of_each_text():
    encoder = token_files.WordEncoder(VOCABULARY)
    texts = ["a b\nc d.", "", " a", "a ", "\na", "a\n", "a  b", "a \n b", "a\tb c", "a\0b", "x\x01y z", "é à\nü", "a b", "a b c",
             "“q” r", "　", " ", "\n", "one", "a\x1cb", "b <|endoftext|> c", "漢 字\n、", "€ 5"]
    for batch in (texts, texts[:1], [""], ["", "a b", ""], [" ", " "]):
        cut, number = encoder.units(batch)
        assert number.tolist() == [len(encoder.cut(t)) for t in batch]
        assert cut.to_pylist() == [u for t in batch for u in encoder.cut(t)]
    ids, sizes = encoder.encode(texts)
    want = [encoder.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert sizes.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]


def test_words_are_remembered_apart_from_marks():
    encoder = token_files.WordEncoder(VOCABULARY)
    texts = ["tree, tree. tree!", "tree? tree don't", "don't", "", "we'll we 'll o'", "s"]
    ids, sizes = encoder.encode(texts)
    want = [encoder.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert sizes.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]
    assert set(encoder.words.names) == {m.encode() for t in texts for m in encoder.pre.findall(t)}


def test_apostrophes_and_white_space_at_the_ends_of_texts():
    encoder = token_files.WordEncoder(VOCABULARY)
    rnd = random.Random(4)
    letters = [" ", "\n", "　", "\x85", "'", "s", "r", "e", "v", "l", "é", "1", "."]
    texts = ["".join(rnd.choices(letters, k=rnd.randint(0, 6))) for _ in range(20_000)]
    cut, number = encoder.units(texts)
    assert number.tolist() == [len(encoder.pre.findall(t)) for t in texts]
    assert cut.to_pylist() == [m for t in texts for m in encoder.pre.findall(t)]


def test_what_is_met_again_outlives_a_full_memory(monkeypatch):
    encoder = token_files.WordEncoder(VOCABULARY)
    encoder.encode(["one two three", "x <|endoftext|>"])
    first, _ = encoder.encode(["one two"])
    monkeypatch.setattr(token_files, "MEMO", encoder.words.held - 1)
    again, _ = encoder.encode(["one two"])
    assert set(encoder.words.names) == {b"one", b" two"} and again.tolist() == first.tolist()
    late, _ = encoder.encode(["three one four"])
    assert late.tolist() == encoder.tokenizer.encode("three one four", add_special_tokens=False).ids


def test_tasks_of_a_worker_share_what_they_learned(tmp_path):
    path = tmp_path / "v.json"
    path.write_bytes(open(VOCABULARY, "rb").read())
    one = token_files.shared_encoder(str(path), 1)
    assert token_files.shared_encoder(str(path), 1) is one
    assert token_files.shared_encoder(str(path), 2) is not one
