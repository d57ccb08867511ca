import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from odoscore.operators import metrics as m
from odoscore.operators.quantiles import exact_percentiles


def brute_auc(pairs):
    pos = [s for s, y in pairs if y == 1]
    neg = [s for s, y in pairs if y == 0]
    if not pos or not neg:
        return None
    return sum((p > q) + 0.5 * (p == q) for p in pos for q in neg) / (len(pos) * len(neg))


@pytest.mark.parametrize("kind", ["ties", "narrow", "few"])
def test_auc_against_all_pairs(spark, kind):
    rng = random.Random(3)
    score = {"ties": lambda: rng.randint(0, 9) / 10, "narrow": lambda: 0.5 + rng.random() * 1e-9, "few": rng.random}[kind]
    rows = [(g, rng.randint(0, 1), score()) for g in ("a", "b") for _ in range(300 if kind != "few" else 4)]
    rows += [("one", 1, 0.3), ("one", 1, 0.7)]
    df = spark.createDataFrame(rows, "g string, label int, score double").repartition(5)
    got = {r["g"]: r for r in m.classification_metrics(df, by=["g"], digits=9).collect()}
    for g in ("a", "b", "one"):
        part = [(s, y) for h, y, s in rows if h == g]
        auc = brute_auc(part)
        assert got[g]["roc_auc"] == (None if auc is None else pytest.approx(auc, abs=1e-8))
        assert got[g]["accuracy"] == pytest.approx(np.mean([(s >= 0.5) == (y == 1) for s, y in part]), abs=1e-8)
        assert got[g]["n_samples"] == len(part)


def test_hot_score_holds_most_rows(spark):
    df = spark.range(5000).select(
        (F.col("id") % 2).cast("int").alias("label"),
        F.when(F.col("id") < 4000, 0.5).otherwise(F.col("id") / 5000).alias("score"))
    rows = [(r["score"], r["label"]) for r in df.collect()]
    pos = np.array([s for s, y in rows if y == 1])[:, None]
    neg = np.array([s for s, y in rows if y == 0])[None, :]
    want = ((pos > neg).mean() + 0.5 * (pos == neg).mean())
    assert m.classification_metrics(df, digits=9).first()["roc_auc"] == pytest.approx(want, abs=1e-8)


def test_threshold_is_inclusive_and_empty_input(spark):
    df = spark.createDataFrame([(1, 0.5), (0, 0.4999)], "label int, score double")
    assert m.classification_metrics(df).first()["accuracy"] == 1.0
    empty = m.classification_metrics(df.filter("label > 5")).collect()
    assert [r["roc_auc"] for r in empty] == [None]


def test_precision_at_k_breaks_ties_by_key(spark):
    df = spark.createDataFrame([("a", 1, 0.9), ("c", 0, 0.5), ("b", 1, 0.5), ("d", 0, 0.1)], "id string, label int, score double")
    assert tuple(m.precision_at_k(df, 2, "id").first()) == (2, 2, 1.0)


CASES = {
    "plain": [float(i) for i in range(101)],
    "one": [7.5],
    "pair": [1.0, 2.0],
    "hot": [3.0] * 500 + [float(i) for i in range(20)],
    "signs": [-1e6, -2.5, -0.001, 0.0, 0.0001, 3e9, 1e300, -1e300],
    "narrow": [100 + i * 1e-9 for i in range(200)],
}


def test_percentiles_against_numpy(spark):
    rows = [(name, v) for name, values in CASES.items() for v in values] + [("plain", None), ("plain", float("nan"))]
    df = spark.createDataFrame(rows, "g string, v double").repartition(4)
    probs = [0.0, 0.5, 0.95, 0.99, 1.0]
    got = {r["g"]: r["q"] for r in exact_percentiles(df, "v", probs, ["g"]).collect()}
    for name, values in CASES.items():
        assert got[name] == pytest.approx(np.percentile(values, [p * 100 for p in probs]).tolist(), rel=1e-12, abs=1e-9), name


def test_percentiles_without_groups_and_weighted(spark):
    df = spark.createDataFrame([(1.0, 3), (2.0, 1), (10.0, 2)], "v double, n long")
    want = np.percentile([1, 1, 1, 2, 10, 10], [50, 95])
    assert exact_percentiles(df, "v", [0.5, 0.95], weight="n").first()["q"] == pytest.approx(want.tolist())
    assert exact_percentiles(df.filter("v < 0"), "v", [0.5]).first()["q"] == [None]


def test_latency_summary(spark):
    rows = [(i, f"2024-01-01 00:00:{i:02d}", float(10 * i), i == 3) for i in range(1, 6)]
    log = spark.createDataFrame(rows, "request_id int, t string, latency_ms double, is_error boolean").withColumn(
        "started_at", F.col("t").cast("timestamp"))
    r = m.request_latency_summary(log).first()
    assert (r["n_requests"], r["errors"], r["total_wall_seconds"]) == (5, 1, 4.05)
    assert r["throughput_req_per_sec"] == 1.23 and r["avg_latency_ms"] == 30.0
    assert r["p50_latency_ms"] == 30.0 and r["p95_latency_ms"] == 48.5
    none = m.request_latency_summary(log.filter("is_error")).first()
    assert none["avg_latency_ms"] is None and none["p99_latency_ms"] is None and none["errors"] == 1


def test_rows_without_score_or_label_are_counted(spark):
    rows = [("a", 1, 0.9), ("a", 0, 0.2), ("a", None, 0.3), ("a", 1, None), ("b", None, None)]
    df = spark.createDataFrame(rows, "g string, label int, score double")
    got = {r["g"]: (r["n_samples"], r["n_unscored"]) for r in m.classification_counts(df, by=["g"]).collect()}
    assert got == {"a": (2, 2), "b": (0, 1)}
