"""SimHash fingerprints, vantage-point search and components against brute force."""

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from odoscore.llm import simhash as S
from odoscore.llm.components import components, spanning_stars


def slow_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in __import__("re").split("[\x20\x09-\x0d]+", low) if w]
    grams = [" ".join(words[i: i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    votes = [0] * 64
    for g in grams:
        h = xxhash.xxh64_intdigest(g.encode(), 42)
        for b in range(64):
            votes[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * votes[b] > len(grams))


@pytest.mark.parametrize("text", [None, "", "  \t\n", "One", "Two words", "ÀB C\x0bd e f É g h i", "a b c a b c a b c", "x " * 70_000])
def test_fingerprint(text):
    assert S.fingerprint(text) == slow_fingerprint(text)


def test_hash_is_that_of_the_engine(spark):
    assert spark.sql("SELECT xxhash64('a b c') AS h").first()[0] & (1 << 64) - 1 == xxhash.xxh64_intdigest(b"a b c", 42)


@pytest.fixture(scope="module")
def values():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**63, 1500, dtype=np.uint64)
    near = base[:400].copy()
    for i in range(400):
        for bit in rng.integers(0, 64, rng.integers(1, 6)):
            near[i] ^= np.uint64(1) << np.uint64(bit)
    # A dense ball: all values within two bits of one.
    dense = [np.uint64(99) ^ (np.uint64(1) << np.uint64(i)) ^ (np.uint64(1) << np.uint64(j)) for i in range(24) for j in range(i)]
    return np.unique(np.concatenate([base, near, np.array(dense, np.uint64)]))


@pytest.mark.parametrize("sizes", [{}, {"task_rows": 90, "shard_rows": 60}])
def test_search_loses_no_link(spark, values, sizes):
    rows = spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "fp long")
    found = S.near_edges(rows, 3, **sizes).toPandas()
    x, y = np.nonzero(np.triu(np.bitwise_count(values[:, None] ^ values[None, :]) <= 3, 1))
    want = dict(zip(*spanning_stars(values[x], values[y])))
    got = dict(zip(*spanning_stars(found.a.to_numpy().view(np.uint64), found.b.to_numpy().view(np.uint64))))
    assert got == want
    pairs = np.bitwise_count(found.a.to_numpy().view(np.uint64) ^ found.b.to_numpy().view(np.uint64))
    assert len(found) < 20 * len(values) and len(pairs)


def test_components_of_paths_and_stars(spark):
    random.seed(1)
    edges = [(i, i + 1) for i in range(60)] + [(1000, i) for i in range(200, 260)] + [(5, 5), (300, 301), (301, 300)]
    random.shuffle(edges)
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {i: 0 for i in range(61)} | {i: 200 for i in [*range(200, 260), 1000]} | {300: 300, 301: 300}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


DOCS = "doc_id long, text string, fp string"


def grouped(spark, rows):
    docs = S.with_fingerprint(spark.createDataFrame(rows, DOCS), keep_text=False)
    return S.near_duplicate_groups(docs.select("doc_id", "fp"))


def test_groups_of_nulls_repeats_and_ties(spark):
    long = " ".join(f"word{i}" for i in range(400))
    rows = [(9, long, "x"), (4, long.upper(), "x"), (4, long.upper(), "x"), (7, None, "x"), (8, "", "x"), (None, "other text here", "x"), (3, "something else", "x")]
    got = sorted((str(r["doc_id"]), r["component_id"]) for r in grouped(spark, rows).collect())
    assert got == sorted([("9", 4), ("4", 4), ("4", 4), ("7", 7), ("8", 7), ("None", None), ("3", 3)])
    assert grouped(spark, []).count() == 0
    assert S.with_fingerprint(spark.createDataFrame(rows[:1], DOCS)).columns == ["doc_id", "text", "fp"]


@pytest.mark.parametrize("share", [0.0, 0.2, 2.0])
def test_hot_fingerprints_and_others_get_the_same_groups(spark, share, monkeypatch):
    monkeypatch.setattr(S, "HOT_SHARE", share)
    rows = [(i, "a hot text" if i % 3 else f"text number {i} alone", "x") for i in range(5, 65)] + [(None, "a hot text", "x")]
    got = {r["doc_id"]: r["component_id"] for r in grouped(spark, rows).collect()}
    assert len(got) == 61 and got == {i: i if i and i % 3 == 0 else 5 for i in got}


def test_one_row_of_each_group_stays(spark):
    long = " ".join(f"word{i}" for i in range(400))
    rows = [(9, long, "x"), (4, long.upper(), "b"), (4, long.upper(), "a"), (None, "other text here", "x"), (None, "yet another text", "x"), (3, "", "x")]
    kept = S.keep_one_per_group(spark.createDataFrame(rows, DOCS))
    assert kept.columns == ["doc_id", "text", "fp"]
    assert sorted((str(r[0]), r[2]) for r in kept.collect()) == [("3", "x"), ("4", "a"), ("None", "x"), ("None", "x")]


def test_stage_keeps_columns_of_its_own_names(spark):
    rows = [(1, "same words in both texts", 5, 6, 7, 8), (2, "same words in both texts", 9, 9, 9, 9), (3, "another text with other words", 1, 2, 3, 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, root int, __fp int, __id int, __n int")
    kept = S.keep_one_per_group(docs)
    assert kept.columns == docs.columns
    assert sorted(map(tuple, kept.collect())) == [rows[0], rows[2]]


def test_text_form(spark):
    assert spark.createDataFrame([(-1,), (10,)], "fp long").select(S.fingerprint_text()).collect() == [("f" * 16,), ("000000000000000a",)]
    assert F is not None
