"""Pivot top-k and best-fit packing against brute force."""

import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from odoscore.llm import pivot_topk as P
from odoscore.llm.packing import pack, pack_documents

VECTORS = "vec_id long, embedding array<float>, score string"


def brute(rows, k):
    ok = [(i, r) for i, r in enumerate(rows) if r[0] is not None and r[1] and all(x is not None and math.isfinite(x) for x in r[1])]
    ok = [(i, r) for i, r in ok if sum((256 * x) ** 2 for x in r[1]) < P.LONGEST**2]
    ints = {i: [math.floor(256 * x) for x in r[1]] for i, r in ok}
    out = []
    for i, r in ok:
        if r[0] % 50:
            continue
        scored = [(-sum(a * b for a, b in zip(ints[i], ints[j])), s[0]) for j, s in ok if j != i and len(ints[j]) == len(ints[i])]
        out += [(r[0], n, v, -s) for n, (s, v) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("block", [4096, 16])
def test_exact_top_k(spark, monkeypatch, block):
    monkeypatch.setattr(P, "BLOCK_ROWS", block)
    monkeypatch.setattr(P, "QUERY_ROWS", max(2, block // 8))
    random.seed(2)
    centers = [[random.gauss(0, 1) for _ in range(8)] for _ in range(5)]
    half = lambda x: round(x * 64) / 64  # noqa: E731  exact as float
    rows = [(i, [half(c + random.gauss(0, 0.2)) for c in random.choice(centers)], "x") for i in range(300)]
    rows += [(400 + i, [1.0] * 8, "x") for i in range(120)]
    rows += [(50, None, "x"), (100, [], "x"), (150, [1.0, None] * 4, "x"), (200, [float("nan")] * 8, "x"), (250, [float("inf")] * 8, "x"), (None, [1.0] * 8, "x")]
    rows += [(500, [0.5, 0.25], "x"), (501, [0.5, 0.5], "x"), (0, rows[0][1], "x")]
    # Beyond the range of a long, and just within it.
    rows += [(600, [3e16] * 8, "x"), (650, [3e38] * 8, "x"), (700, [2.9e6] * 8, "x"), (701, [2.9e6] * 7 + [-2.9e6], "x"), (702, [-2.9e6] * 8, "x")]
    got = P.exact_top_k(spark.createDataFrame(rows, VECTORS), F.col("vec_id") % 50 == 0)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, got.collect())) == brute(rows, 5)


def test_top_k_edge_cases(spark):
    assert P.exact_top_k(spark.createDataFrame([], VECTORS), F.col("vec_id") % 50 == 0).count() == 0
    alone = spark.createDataFrame([(0, [1.0, 2.0], "x")], VECTORS)
    assert P.exact_top_k(alone, F.col("vec_id") % 50 == 0).count() == 0


def slow_best_fit(sizes, sources, clusters, capacity, per_source):
    bins = []
    for item in zip(sizes, sources, clusters):
        fits = [
            (b["left"], n) for n, b in enumerate(bins)
            if b["left"] >= item[0] and item[2] not in b["clusters"] and b["sources"][item[1]] < per_source
        ]
        if not fits:
            bins.append({"left": capacity, "clusters": set(), "sources": Counter()})
            fits = [(capacity, len(bins) - 1)]
        b = bins[min(fits)[1]]
        b["left"] -= item[0]
        b["clusters"].add(item[2])
        b["sources"][item[1]] += 1
        yield min(fits)[1]


def test_pack_is_best_fit():
    random.seed(4)
    n = 600
    sizes = [random.randint(1, 100) for _ in range(n)]
    sources = [random.choice("aaab") + random.choice("xy") for _ in range(n)]
    clusters = [random.randint(0, 120) for _ in range(n)]
    bins, offsets, residual = pack(sizes, sources, clusters, 100, 2)
    assert bins == list(slow_best_fit(sizes, sources, clusters, 100, 2))
    ends = defaultdict(list)
    for b, o, s in sorted(zip(bins, offsets, sizes)):
        assert o == (ends[b][-1] if ends[b] else 0)
        ends[b].append(o + s)
    assert all(100 - ends[b][-1] == residual[b] for b in ends)


DOCS = "doc_id long, text string, source string, piece string"


@pytest.mark.parametrize("shard_rows", [8192, 10])
def test_packed_documents(spark, shard_rows):
    random.seed(5)
    rows = [(i, " ".join(f"w{i}_{j}" for j in range(random.randint(1, 60))), random.choice(["a", "b", None]), "x") for i in range(80)]
    rows += [(200 + i, "the same  text\nagain", "c", "x") for i in range(30)] + [(300, None, "a", "x"), (301, "", None, "x"), (None, "one", "a", "x")]
    rows += [rows[0], (302, "  " + " ".join(f"l{j}" for j in range(100)), "d", "x")]
    out = pack_documents(spark.createDataFrame(rows, DOCS), capacity=20, per_source=2, with_text=True, shard_rows=shard_rows).collect()
    used, held, by_source = Counter(), defaultdict(list), Counter()
    for r in out:
        if r["bin_id"] is None:
            assert r["n_words"] == 0
            continue
        used[r["bin_id"]] += r["n_words"]
        held[r["bin_id"]].append(r["cluster"])
        by_source[r["bin_id"], r["source"]] += 1
        assert len(r["text"].split()) == r["n_words"]
    assert max(used.values()) <= 20 and max(by_source.values()) <= 2
    assert all(len(c) == len(set(c)) for c in held.values())
    pieces = defaultdict(list)
    for r in sorted(out, key=lambda r: r["start_word"]):
        pieces[r["doc_id"]] += r["text"].split()
    assert pieces[302] == rows[-1][1].split() and pieces[5] == rows[5][1].split()
    assert sum(used.values()) == sum(len((t or "").split()) for _, t, _, _ in rows)
    assert {r["doc_id"] for r in out} == {r[0] for r in rows}


def test_packing_nothing(spark):
    assert pack_documents(spark.createDataFrame([], DOCS)).count() == 0
