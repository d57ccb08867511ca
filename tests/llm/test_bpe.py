"""Tree concatenation against the tokenizers library on whole texts."""

import json
import random

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from odoscore.llm import bpe as B

PATH = public_tokenizers.path("byte_bpe_50k.json")
PIECES = [
    "a", "aa", "s", "'s", "'re", "'", "''s", "!", "!!", "...", " ", "  ", "\n", "\r\n", "\t", " \n ", "the", " the", "ing", "1", "23", "中文", "é", "é",
    "😀", "👩‍👧", "<|endoftext|>", "<|", "|>", "endoftext", "'ll", "'LL", "　", "\xa0", "\x85", "\x1c", "\x00", "Ⅷ", "²", "​", "----", "ab" * 9,
]
DOCS = "doc_id long, text string, row string, mark string, ids string, n_tokens string, `a b.c:d` int"


@pytest.fixture(scope="module")
def own():
    return B.codec(PATH)


def check(own, text, size):
    assert own.concatenate([own.encode(leaf) for leaf in own.leaves(text, size)]) == own.encode(text)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(PIECES), min_size=1, max_size=40), st.integers(1, 12), st.integers(1, 4))
def test_joins_of_mixed_texts(parts, size, window):
    own, before = B.codec(PATH), B.WINDOW
    B.WINDOW = window
    try:
        check(own, "".join(parts), size)
    finally:
        B.WINDOW = before


@settings(max_examples=200, deadline=None)
@given(st.text(min_size=1, max_size=60), st.integers(1, 9))
def test_joins_of_any_characters(text, size):
    check(B.codec(PATH), text, size)


@pytest.mark.parametrize("atom", ["a", "ab", " ", "\n", "中", "é", "!", "-", "0", "😀", "'", "s's"])
def test_unsplit_runs(own, atom):
    """No leaf ends at a certain boundary here."""
    for length in (97, 1000):
        for size in (1, 7, 64):
            check(own, atom * length, size)
    random.seed(7)
    check(own, "".join(random.choice("etaoinshrd") for _ in range(3000)), 50)


def test_leaves_are_short_and_cut_no_added_token(own):
    text = "x" * 30 + "<|endoftext|>" * 20 + "y" * 30
    leaves = own.leaves(text, 8)
    assert "".join(leaves) == text
    assert sum(leaf.count("<|endoftext|>") for leaf in leaves) == 20
    assert own.leaves("", 8) == [""] and own.leaves("12345678", 8) == ["12345678"]


def test_letters_of_bytes_are_the_vocabulary(own):
    assert sorted(B._letters_of_bytes().values()) == list(range(256))
    assert all(own.bytes_of[own.encode(w)[0]].decode() == w for w in ("the", " the", "<|endoftext|>"))


def test_other_tokenizers_are_refused(tmp_path):
    described = json.load(open(PATH, encoding="utf-8"))
    for change in (
        {"normalizer": {"type": "NFC"}}, {"pre_tokenizer": None}, {"model": described["model"] | {"byte_fallback": True}},
        {"model": described["model"] | {"merges": described["model"]["merges"][::-1]}},
        {"added_tokens": [described["added_tokens"][0] | {"lstrip": True}]},
    ):
        path = tmp_path / "other.json"
        path.write_text(json.dumps(described | change), encoding="utf-8")
        with pytest.raises(ValueError):
            B.check_tokenizer(str(path))
    B.check_tokenizer(PATH)


@pytest.mark.parametrize("leaf, fan", [(8192, 64), (16, 2), (16, 4)])
def test_documents(spark, own, monkeypatch, leaf, fan):
    monkeypatch.setattr(B, "LEAF", leaf)
    monkeypatch.setattr(B, "FAN", fan)
    random.seed(11)
    texts = [None, "", " ", "a", "short text.", "<|endoftext|>", "x" * 40_000, "word " * 5000, "中文字" * 4000, "\n" * 9000, " " * 20_000 + "end"]
    texts += ["".join(random.choice(PIECES) for _ in range(random.randint(1, 90))) for _ in range(40)]
    # A third of all rows are copies of one long text.
    texts += ["copied, and long enough to be cut into many pieces. " * 300] * 25
    rows = [(i % 70 or None, t, "r", "m", "i", "n", 5) for i, t in enumerate(texts)]
    encoded = B.bpe_encode(spark.createDataFrame(rows, DOCS).repartition(3), PATH, keep_text=True)
    assert encoded.columns == ["doc_id", "text", "row", "mark", "a b.c:d", "n_tokens", "ids"]
    got = B.bpe_decode(encoded, PATH).collect()
    assert len(got) == len(rows) and all(r["row"] == "r" and r["mark"] == "m" for r in got)
    by_text = {t: own.library.encode(t or "", add_special_tokens=False).ids for t in texts}
    assert sorted(str(r["text"]) for r in got) == sorted(str(t) for t in texts)
    for r in got:
        want = by_text[r["text"]]
        assert np.frombuffer(r["ids"], "<u4").tolist() == want and r["n_tokens"] == len(want)
        assert r["decoded"] == (r["text"] or "") == own.library.decode(want, skip_special_tokens=False)


def test_decoding_of_any_numbers(spark, own):
    odd = [own.encode("é")[0], 99_999_999, 50256, own.encode("中文")[0]]
    rows = [(1, bytearray(B._packed(odd))), (2, None), (3, bytearray(B._packed([200, 201, 202, 128])))]
    got = {r["doc_id"]: r["decoded"] for r in B.bpe_decode(spark.createDataFrame(rows, "doc_id long, ids binary"), PATH).collect()}
    known = [i for i in odd if i in own.bytes_of]
    assert got[1] == own.library.decode(known, skip_special_tokens=False)
    assert got[2] == "" and got[3] == own.library.decode([200, 201, 202, 128], skip_special_tokens=False)


def test_empty_table(spark):
    empty = spark.createDataFrame([], DOCS)
    assert B.bpe_decode(B.bpe_encode(empty, PATH), PATH).count() == 0
