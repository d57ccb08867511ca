"""Slot-decomposed hard negatives against a search of every window."""

import math
import random

import pytest
from pyspark.sql import functions as F

from odoscore.llm import hard_negatives as H

VECTORS = "vec_id long, embedding array<double>, label int, score string, uid string"


def brute(rows, k=3, n=5, low=50, high=95):
    ok = [
        (i, r[0], r[2], [math.floor(256 * x) for x in r[1]]) for i, r in enumerate(rows)
        if r[0] is not None and r[1] is not None and r[2] is not None and all(x is not None and math.isfinite(256 * x) for x in r[1])
    ]
    ok = [r for r in ok if sum(x * x for x in r[3]) < 2**56]
    out = []
    for i, anchor, label, v in ok:
        if anchor % 50:
            continue
        scored = [(-sum(a * b for a, b in zip(v, w)), c, other == label) for j, c, other, w in ok if j != i and len(v) == len(w)]
        for p, positive, _ in sorted(s for s in scored if s[2])[:n]:
            fits = sorted(s for s in scored if not s[2] and low * -p <= 100 * -s[0] <= high * -p)
            out += [(anchor, positive, at, c, -p, -s) for at, (s, c, _) in enumerate(fits[:k], 1)]
    return sorted(out)


def answer(spark, rows, **options):
    df = H.hard_negatives(spark.createDataFrame(rows, VECTORS), F.col("vec_id") % 50 == 0, **options)
    assert df.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(map(tuple, df.collect()))


def some_rows(seed, n, label):
    random.seed(seed)
    centers = [[random.gauss(0, 1) for _ in range(6)] for _ in range(4)]
    return [(i, [round(c + random.gauss(0, 0.4), 2) for c in random.choice(centers)], label(), "x", "y") for i in range(n)]


@pytest.mark.parametrize("row_part, slab", [(1 << 21, 1 << 18), (60, 6)])
def test_every_window(spark, monkeypatch, row_part, slab):
    monkeypatch.setattr(H, "ROW_COMPONENTS", row_part)
    monkeypatch.setattr(H, "ANCHOR_COMPONENTS", slab)
    # A third of all rows share one label; equal vectors tie; anchors repeat.
    rows = some_rows(3, 150, lambda: random.choice([0, 0, 1, 2, 3]))
    rows += [(200 + i, [0.5] * 6, i % 2, "x", "y") for i in range(40)]
    rows += [(0, rows[0][1], rows[0][2], "x", "y"), (100, rows[7][1], 9, "x", "y")]
    rows += [(50, None, 1, "x", "y"), (50, [1.0, None] * 3, 1, "x", "y"), (50, [float("nan")] * 6, 1, "x", "y"), (50, [float("inf")] * 6, 1, "x", "y")]
    rows += [(None, [1.0] * 6, 1, "x", "y"), (50, [1.0] * 6, None, "x", "y"), (50, [3e16] * 6, 1, "x", "y"), (50, [1e308] * 6, 1, "x", "y")]
    rows += [(300, [1.0, 2.0], 1, "x", "y"), (301, [1.0, 2.0], 1, "x", "y"), (302, [0.5, 1.5], 2, "x", "y"), (350, [], 1, "x", "y"), (351, [], 2, "x", "y")]
    want = brute(rows)
    assert want and answer(spark, rows) == want


@pytest.mark.parametrize("options", [{"k": 1, "n": 9}, {"k": 7, "n": 2, "low": 1, "high": 100}, {"k": 2, "n": 4, "low": 80, "high": 120}])
def test_other_windows(spark, options):
    rows = some_rows(5, 120, lambda: random.choice([0, 1, 2]))
    asked = {("n_positives" if name == "n" else name): value for name, value in options.items()}
    assert answer(spark, rows, **asked) == brute(rows, **options)


def test_long_vectors_are_multiplied_as_integers(spark):
    rows = [(i, [40000.0 + i / 256, 1.0 - i / 256], i % 3, "x", "y") for i in range(60)]
    assert H._longest(H.np.array([[2**27, 1]])) ** 2 > H._EXACT / 2
    big = [(i, [1e5 * (1 + i % 7) + 1 / 256, float(i)], i % 3, "x", "y") for i in range(60)]
    assert answer(spark, rows) == brute(rows)
    assert answer(spark, big) == brute(big)


def test_without_partners(spark):
    assert answer(spark, []) == []
    assert answer(spark, [(0, [1.0], 1, "x", "y")]) == []
    assert answer(spark, [(0, [1.0], 1, "x", "y"), (1, [1.0], 1, "x", "y")]) == []
    assert answer(spark, [(0, [1.0], 1, "x", "y"), (1, [1.0], 2, "x", "y")]) == []
    with pytest.raises(ValueError):
        answer(spark, [], low=0)
