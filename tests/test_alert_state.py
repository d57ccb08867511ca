"""Alerts from summaries of bounded size."""

import math
import random

from pyspark.sql import functions as F

from odoscore.plans import alerts
from odoscore.session import scratch_path
from odoscore.streaming import jobs

LOG = "started_at string, latency_ms double, is_error boolean"


def log(spark, n, latency):
    random.seed(6)
    rows = [(f"2024-01-01 10:{m:02d}:{random.randint(0, 59):02d}", latency(i), random.random() < 0.04) for i in range(n) for m in [random.randint(0, 29)]]
    return spark.createDataFrame(rows, LOG).withColumn("started_at", F.col("started_at").cast("timestamp"))


def rows_of(df):
    return sorted(
        (str(r["window_start"]), r["n_requests"], r["errors"], None if r["p95_latency_ms"] is None else round(r["p95_latency_ms"], 9), r["latency_alert"], r["error_alert"])
        for r in df.collect()
    )


def test_summary_gives_the_exact_percentile(spark):
    special = [0.0, 1e12, 3e15, -1.0, 250.0, 250.0, None]
    df = log(spark, 3000, lambda i: special[i % 7] if i % 5 == 0 else random.lognormvariate(5, 0.7)).filter("latency_ms IS NULL OR latency_ms >= 0")
    clean = df.filter("latency_ms IS NOT NULL")
    summary = alerts.latency_summary(clean)
    assert rows_of(alerts.alerts_from_summary(summary, clean)) == rows_of(alerts.latency_alerts(clean))
    assert summary.groupBy("window_start").count().agg(F.max("count")).first()[0] <= alerts.SUMMARY_ROWS
    # Errors only, and values that are none: no percentile, no alert.
    odd = spark.createDataFrame([("2024-01-01 10:00:00", 9.0, True), ("2024-01-01 10:00:01", float("nan"), False)], LOG)
    odd = odd.withColumn("started_at", F.col("started_at").cast("timestamp"))
    assert rows_of(alerts.alerts_from_summary(alerts.latency_summary(odd), odd))[0][1:] == (2, 1, None, False, True)


def test_cells_are_narrow_and_merge(spark):
    df = log(spark, 4000, lambda i: random.lognormvariate(4, 2))
    summary = alerts.latency_summary(df)
    wide = summary.filter((F.col("high") + 1) / (F.col("low") + 1) > math.exp(1 / alerts.SUMMARY_CELLS_PER_E) * 1.000001)
    assert wide.count() == 0
    halves = [alerts.latency_summary(df.filter(c)) for c in ("latency_ms * 1000 % 2 < 1", "NOT latency_ms * 1000 % 2 < 1")]
    merged = halves[0].unionByName(halves[1]).groupBy("window_start", "cell", "is_error").agg(
        F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high")
    )
    assert merged.select(*summary.columns).exceptAll(summary).isEmpty() and merged.count() == summary.count()


def test_stream_state_is_bounded(spark):
    """All latencies differ; the state has cells, not latencies."""
    folder = scratch_path(spark, "alert-log")
    df = log(spark, 12_000, lambda i: 200 + i / 1000)
    df.write.parquet(f"{folder}/in")
    stream = spark.readStream.schema(df.schema).parquet(f"{folder}/in")
    query = jobs.start_alerts(stream, f"{folder}/out", f"{folder}/state", df)
    query.awaitTermination()
    held = [o["numRowsTotal"] for p in query.recentProgress for o in p["stateOperators"]]
    windows = df.select(F.window("started_at", alerts.ALERT_WINDOW)).distinct().count()
    assert max(held) <= windows * 2 * (math.log(212 / 200) * alerts.SUMMARY_CELLS_PER_E + 2)
    late = query.recentProgress[-1]["stateOperators"][0]["numRowsDroppedByWatermark"]
    assert late == 0
    closed = spark.read.parquet(f"{folder}/out")
    assert closed.count() > 0
    want = {r[0]: r for r in rows_of(alerts.latency_alerts(df))}
    assert all(want[r[0]] == r for r in rows_of(closed))
