"""Closed-syncmer fingerprints against a slow form."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from odoscore.llm import syncmers as Y


def slow_sketch(text):
    points = [ord(c) for c in text]

    def mixed(run):
        value = 0
        for c in run:
            value = (value * int(Y._BASE) + c + 1) % 2**64
        return value * int(Y._MIX) % 2**64

    found = {}
    for i in range(len(points) - Y.K + 1):
        inner = [mixed(points[i + j: i + j + Y.S]) for j in range(Y.K - Y.S + 1)]
        if min(inner) in (inner[0], inner[-1]):
            found.setdefault(mixed(points[i: i + Y.K]) >> 32, i)
    if text and not found:
        found = {int.from_bytes(hashlib.blake2b(text.encode(), digest_size=4).digest()): 0}
    return found


def slow_likeness(a, b):
    """Twice the longest common subsequence over all, by the quadratic table."""
    if not a or not b:
        return float(a == b)
    mine, other = (sorted(s, key=s.get) for s in (a, b))
    row = [0] * (len(other) + 1)
    for x in mine:
        above = row[:]
        for j, y in enumerate(other):
            row[j + 1] = above[j] + 1 if x == y else max(row[j], above[j + 1])
    return 2 * row[-1] / (len(a) + len(b))


def slow_written(sketch):
    return "".join(f"{h:08x}" for h in sorted(sketch, key=sketch.get))


@pytest.fixture(scope="module")
def texts():
    random.seed(9)
    words = ["the", "über", "and", "😀", "some", "words\n", "of", "a", "language"]
    return ["", "a", "x" * 15, "x" * 40, "ab" * 300, *(" ".join(random.choices(words, k=n)) for n in (1, 4, 9, 40, 150, 400))]


@pytest.mark.parametrize("chunk", [1 << 20, 100])
def test_sketches(texts, chunk, monkeypatch):
    monkeypatch.setattr(Y, "_CHUNK", chunk)
    got = Y.sketches(texts)
    assert [dict(zip(s.hashes.tolist(), s.at.tolist())) for s in got] == [slow_sketch(t) for t in texts]
    assert all((np.diff(s.hashes.astype(np.int64)) > 0).all() for s in got)


def test_anchors_do_not_depend_on_context(texts):
    body = texts[-1]
    at, hashes = Y.anchors(Y._points(body))
    shifted, others = Y.anchors(Y._points("some other beginning " + body))
    inside = shifted >= 21
    assert np.array_equal(shifted[inside] - 21, at) and np.array_equal(others[inside], hashes)


def test_likeness():
    a, b, none = Y.sketches(["".join(random.Random(seed).choices("abcdefgh ", k=3000)) for seed in (1, 2)] + [""])
    assert Y.likeness(a, a) == 1 and Y.likeness(a, b) == 0 and Y.likeness(none, none) == 1 and Y.likeness(none, a) == 0
    # Equal anchors in another order are no match.
    assert Y.likeness(a, Y.Sketch(a.hashes, 10_000 - a.at)) < 0.1


def test_every_anchor_of_a_long_text_counts():
    """One passage of one percent of a long text is found, and half a text is half alike."""
    make = lambda seed, k: "".join(random.Random(seed).choices("abcdefghijkl ", k=k))
    long, other = make(1, 200_000), make(2, 200_000)
    quoted = other[:90_000] + long[50_000:52_000] + other[92_000:]
    a, b, c = Y.sketches([long, quoted, long[:100_000] + other[:100_000]])
    assert 0.008 < Y.likeness(a, b) < 0.012 and abs(Y.likeness(a, c) - 0.5) < 0.01


DOCS = "doc_id long, text string, near_next string"


def check(spark, rows):
    frame = spark.createDataFrame(rows, DOCS)
    got = sorted(Y.compare_with_next(frame).collect(), key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["edited_sha256"]))
    signed = lambda t: (xxhash.xxh64_intdigest(t.encode(), 42) + 2**63) % 2**64
    ordered = sorted(((i, t or "") for i, t, _ in rows), key=lambda r: (r[0] is None, r[0] or 0, signed(r[1]), r[1].encode()))
    want = []
    for at, (i, text) in enumerate(ordered):
        after = ordered[(at + 1) % len(ordered)][1]
        edited = text[: len(text) - len(text) // 2] + after[: len(text) // 2]
        own, changed, following = (slow_sketch(t) for t in (text, edited, after))
        digest = hashlib.sha256(edited.encode()).hexdigest()
        want.append((i, len(text), digest, slow_written(own), slow_written(changed), slow_likeness(own, changed), slow_likeness(own, following)))
    want.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    assert [tuple(r) for r in got] == want


def test_documents_and_their_followers(spark, texts):
    rows = [(i * 3, texts[i % len(texts)], "x") for i in range(40)] + [(5, None, "x"), (None, "lost", "x"), (6, texts[-1], "x"), (6, texts[-2], "x"), (6, texts[-2], "x")]
    check(spark, rows)


def test_hot_ids_and_nulls_are_parted(spark, texts):
    """A third of all rows under one id, another third without an id."""
    rows = [(i if i < 60 else 30 if i < 120 else None, f"{texts[5 + i % 4]} {i}", "x") for i in range(180)]
    check(spark, rows)
    frame = spark.createDataFrame(rows, DOCS).withColumn("hash", F.xxhash64("text"))
    got = Y._ordered_ranges(frame).groupBy("range").agg(
        F.count("*").alias("n"), F.min(F.struct("doc_id", "hash")).alias("low"), F.max(F.struct("doc_id", "hash")).alias("high"),
        F.first("doc_id").alias("id"),
    ).orderBy("range").collect()
    assert max(r["n"] for r in got) <= 40 and sum(r["id"] == 30 for r in got) >= 4 and sum(r["id"] is None for r in got) >= 4
    assert all(a["high"] < b["low"] for a, b in zip(got, got[1:]) if a["id"] is not None and b["id"] is not None)
    check(spark, [(7, f"text {i % 5}", "x") for i in range(40)])
    check(spark, [(None, f"text {i % 5}", "x") for i in range(40)])


def test_long_texts_are_compared_by_themselves(texts, monkeypatch):
    rows = pa.table({"range": [0] * 30, "last": [False] * 29 + [True], "doc_id": list(range(30)), "text": (texts * 3)[:30]})
    whole = pa.Table.from_batches(Y._walk(rows.to_batches()))
    monkeypatch.setattr(Y, "_POINTS", 300)
    parts = list(Y._walk(rows.to_batches()))
    assert len(parts) > 5 and pa.Table.from_batches(parts).equals(whole.combine_chunks()) and whole.num_rows == 29


def test_few_documents(spark):
    check(spark, [(1, "a single text that follows itself", "x")])
    check(spark, [(2, "short", "x"), (1, "a longer text than the next one", "x")])
    assert Y.compare_with_next(spark.createDataFrame([], DOCS)).count() == 0
