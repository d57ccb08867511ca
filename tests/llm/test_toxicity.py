"""Noisy-channel decoding and toxicity scores."""

import math
import random
from collections import Counter

import numpy as np
import pytest

from odoscore.llm import toxicity as T

WORDS = "idiot stupid worthless loser pathetic disgusting moron trash clown scum house river garden window little people".split()


@pytest.fixture(scope="module")
def model():
    text = "#" + "#".join(WORDS * 50) + "#"
    codes = [T._CODE[c] for c in text]
    counts = np.zeros((T._SIZE,) * 3)
    for a, b, c in zip(codes, codes[1:], codes[2:]):
        counts[a, b, c] += 1
    return T.log_model(counts)


@pytest.mark.parametrize("written, word", [
    ("1d10t", "idiot"), ("mor0n", "moron"), ("l0s3r", "loser"), ("tr@sh", "trash"), ("$tupid", "stupid"), ("5tup1d", "stupid"), ("p4th3t1c", "pathetic"),
    ("i.d.i.o.t", "idiot"), ("s-c-u-m", "scum"), ("scuuuuum", "scum"), ("idiooooot!!!", "idiot"), ("cl*wn", "clown"), ("clown", "clown"), ("(window),", "window"),
    ("worthlessss", "worthless"), ("2024", ""), ("***", ""), ("a" * 30 + "1", ""),
])
def test_words_are_restored(model, written, word):
    assert T.restore(written, model) == word


def test_spaced_letters(model):
    assert {"idiot", "you", "are"} <= T.restored_words("You are i d i o t ok", model, {})
    assert T.restored_words(None, model, {}) == set()


def slow_decode(token, model):
    """Every path through the lattice."""
    paths = [("", 0.0)]
    for options in T.lattice(token):
        paths = [(t + p, s + c) for t, s in paths for p, c in options]
    best = []
    for text, cost in paths:
        a = b = 0
        for c in text + "#":
            cost += model.item(a, b, T._CODE[c])
            a, b = b, T._CODE[c]
        best.append((cost, text))
    return max(best)[1].replace("#", " ")


def test_decoding_finds_the_best_path(model):
    random.seed(6)
    for _ in range(300):
        token = "".join(random.choices("idotscum0134@$*. ", k=random.randint(1, 7)))
        assert T.decode(token, model) == slow_decode(token, model)


def test_trigram_counts(spark):
    rows = [("Ab, c!",), (None,), ("",), ("éé 9 a",), ("ab",)]
    counts = T.trigram_counts(spark.createDataFrame(rows, "text string"))
    want = Counter()
    for parts in (["ab", "c", "éé", "a", "ab"],):
        text = "##" + "#".join(parts) + "#"
        want.update(("" if b == "#" else a, b, c) for a, b, c in zip(text, text[1:], text[2:]))
    got = Counter()
    for a, b, c in zip(*np.nonzero(counts)):
        got["" if b == 0 else T.ALPHABET[a], T.ALPHABET[b], T.ALPHABET[c]] += int(counts[a, b, c])
    assert got == want


DOCS = "doc_id long, text string, score string"


def corpus(n, seed=1):
    random.seed(seed)
    bad, good = WORDS[:10], WORDS[10:]
    rows, labels = [], []
    for i in range(n):
        words = random.choices(good, k=30)
        toxic = i % 4 == 0
        if toxic:
            for w in random.sample(bad, 3):
                words.insert(random.randrange(len(words)), w if i % 8 else w.replace("o", "0").replace("i", "1"))
        rows.append((i, " ".join(words), "x"))
        labels.append((i, int(toxic)))
    return rows, labels


def test_held_out_documents_are_told_apart(spark):
    rows, labels = corpus(600)
    rows += [(None, None, "x"), (9000, "", "x"), rows[0], (9001, "river " * 30_000 + "st0pp idiot moron scum", "x")]
    labels += [(0, 1), (77, None), (None, 1)]
    out = T.toxicity(spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert out.columns == ["doc_id", "text", "held_out", "score", "predicted"]
    got = out.collect()
    assert len(got) == len(rows)
    for r in got:
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3)
        if r["doc_id"] is not None and r["doc_id"] < 600:
            assert r["predicted"] == (r["doc_id"] % 4 == 0)
            assert r["held_out"] == (__import__("zlib").crc32(str(r["doc_id"]).encode()) % 4 == 2)
        else:
            assert r["predicted"] == (r["doc_id"] == 9001)


def test_labels_of_held_out_rows_are_not_used(spark):
    rows, labels = corpus(200)
    import zlib

    flipped = [(i, 1 - t if zlib.crc32(str(i).encode()) % 4 == 2 else t) for i, t in labels]
    scores = [
        sorted((r["doc_id"], r["score"]) for r in T.toxicity(spark.createDataFrame(rows, DOCS), spark.createDataFrame(x, "doc_id long, toxic int")).collect())
        for x in (labels, flipped)
    ]
    assert scores[0] == scores[1]


def test_without_labels(spark):
    docs = spark.createDataFrame([(1, "some text", "x"), (2, None, "x")], DOCS)
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert [(r["predicted"], 0 < r["score"] < 0.3) for r in T.toxicity(docs, none).collect()] == [(0, True)] * 2
    assert T.toxicity(docs.limit(0), none).count() == 0
    assert T.accepted_documents(docs, none).schema == docs.schema
    assert math.isclose(T.fit_logistic(np.zeros((10, 1)), np.array([1.0] * 5 + [0.0] * 5))[0], 0, abs_tol=1e-6)


@pytest.mark.parametrize("written, words", [
    ("stupid...pathetic...worthless", {"stupid", "pathetic", "worthless"}), ("you,worthless,pathetic,moron!", {"worthless", "pathetic", "moron"}),
    ("house/garden-1d10t-window/l0s3r", {"idiot", "loser", "house"}), ("1d1" + "0" * 25 + "t", {"idiot"}), ("st" + "u" * 30 + "pid", {"stupid"}),
    ("iiddiioott", {"idiot", "iiddiioott"}), ("m_o_r_o_n", {"moron"}), ("stu.pid", {"stupid"}), ("s.t.u.p.i.d" * 4 + "!", set()),
    ("house_" * 40 + "mor0n", {"moron", "house"}),
])
def test_long_and_doubled_tokens_bring_words(model, written, words):
    found = T.restored_words(written, model, {})
    assert words <= found and found


def test_decoding_is_linear(model):
    assert len(T.decode("1d10t" * 4000, model)) >= 12_000
