import pytest
from pyspark.sql import functions as F

from odoscore.config import GuardrailConfig
from odoscore.functions.features import features
from odoscore.operators.stats import feature_stats
from odoscore.plans.alerts import latency_alerts, positive_rate_alerts
from odoscore.plans.monitor import dq_issues, drift_warnings, monitor_report, quarantine_split, run_monitor
from odoscore.plans.promotion import promotion_decision
from odoscore.plans.retrain import feedback_alerts, gather_signals, retrain_decisions

STATS = "version string, feature string, mean double, std double, n_rows long"


def test_null_rate_threshold_is_strict(customers):
    rows = customers(*[{"customer_id": str(i), "contract_type": None if i < 1 else "one_year",
                        "payment_method": None if i < 2 else "mailed_check"} for i in range(20)])
    got = dq_issues(rows).collect()
    assert [(r["check"], r["column"], r["rate"]) for r in got] == [("null_rate", "payment_method", 0.1)]
    assert got[0]["message"] == "HIGH NULL RATE: payment_method = 10.0%"


def test_ranges_ignore_missing_values_and_include_bounds(customers):
    charges = [0.0, 1000.0, -0.01, 1000.01, float("nan"), 5.0, 5.0, 5.0]
    tenures = [0, 600, 601, -1, 5, 5, 5, 5]
    rows = customers(*[{"customer_id": str(i), "monthly_charges": c, "tenure_months": t}
                       for i, (c, t) in enumerate(zip(charges, tenures))])
    ranges = {r["column"]: r["rate"] for r in dq_issues(rows).filter("check = 'out_of_range'").collect()}
    assert ranges == {"monthly_charges": 0.25, "tenure_months": 0.25}


def test_missing_column_is_reported_and_drift_skipped(customers, spark):
    rows = customers().drop("contract_type")
    stats = spark.createDataFrame([("v", "monthly_charges", 1.0, 1.0, 5)], STATS)
    report = monitor_report(rows, stats).first()
    assert report["data_quality_issues"] == ["MISSING COLUMN: contract_type"] and report["drift_warnings"] == []
    assert report["any_issue_detected"]


# The batch mean is 95.5; 95.5 / 1.2 shifts by 20 % up to float noise.
@pytest.mark.parametrize("mean,warns", [(90.0, False), (67.0, True), (81.25 / 1.2, False), (0.0, False)])
def test_drift_threshold_is_strict(customers, spark, mean, warns):
    stats = spark.createDataFrame([("v", "monthly_charges", mean, 1.0, 5)], STATS)
    assert bool(drift_warnings(customers(), stats).collect()) == warns


def test_drift_message_and_missing_reference(customers, spark):
    stats = spark.createDataFrame([("v", "monthly_charges", 50.0, 1.0, 5)], STATS)
    (row,) = drift_warnings(customers(), stats).collect()
    assert row["message"] == (
        "DRIFT in 'monthly_charges': train_mean=50.000 recent_mean=81.250 (relative shift=62.5%, threshold=20%)")


def test_report_order_empty_batch_and_clean_batch(customers, spark):
    rows = customers({}, {"customer_id": "C2", "tenure_months": 601, "monthly_charges": None, "contract_type": None})
    report = monitor_report(rows, None).first()
    assert [m.split(" =")[0] for m in report["data_quality_issues"]] == [
        "HIGH NULL RATE: contract_type", "HIGH NULL RATE: monthly_charges", "OUT-OF-RANGE tenure_months: 50.0% of rows"]
    stats = feature_stats(features(customers()), "v")
    clean = monitor_report(customers(), stats).first()
    assert clean["n_rows_checked"] == 1 and not clean["any_issue_detected"]
    empty = monitor_report(customers().filter("false"), stats).first()
    assert empty["n_rows_checked"] == 0 and not empty["any_issue_detected"]


def test_monitor_job_writes_only_with_statistics(customers, spark, tmp_path):
    stats, reports = str(tmp_path / "stats"), str(tmp_path / "reports")
    assert run_monitor(spark, customers(), stats, reports) is None
    assert not (tmp_path / "reports").exists()
    feature_stats(features(customers({"monthly_charges": 1.0})), "v1").write.mode("append").parquet(stats)
    feature_stats(features(customers()), "v2").write.mode("append").parquet(stats)
    assert run_monitor(spark, customers(), stats, reports) is not None
    stored = spark.read.parquet(reports).first()
    assert stored["drift_warnings"] == [] and not stored["any_issue_detected"]


def test_quarantine_by_batch(customers, spark):
    rows = customers({}, {"customer_id": "C2"}, {"customer_id": "C3", "monthly_charges": 9550.0})
    rows = rows.withColumn("batch", F.when(F.col("customer_id") == "C3", "cents").when(F.col("customer_id") == "C1", "ok"))
    accepted, held = quarantine_split(rows, feature_stats(features(customers()), "v"), ["batch"])
    assert {r["customer_id"] for r in accepted.collect()} == {"C1", "C2"}
    assert {r["customer_id"] for r in held.collect()} == {"C3"}


def signals(spark, *rows):
    return spark.createDataFrame(
        rows, "days_since_last_training int, current_model_promotion_auc double, recent_labeled_auc double, drift_detected boolean")


def test_retrain_rules(spark):
    got = retrain_decisions(signals(
        spark, (16, 0.842, 0.803, False), (13, 0.83, 0.80, False), (14, 0.8, None, False), (13, 0.8, 0.79, False), (1, 0.8, 0.8, True),
        (20, 0.9, 0.5, True),
    )).collect()
    assert got[0]["reasons"] == [
        "staleness: 16 days since last training (threshold=14)",
        "performance drop: AUC fell from 0.842 to 0.803 (drop=0.039, threshold=0.03)",
    ]
    # 0.83 - 0.80 is below 0.03 in binary floats; it must count.
    assert [len(r["reasons"]) for r in got] == [2, 1, 1, 0, 1, 3]
    assert [r["should_retrain"] for r in got] == [True, True, True, False, True, True]


def test_gather_signals_uses_newest_rows(spark):
    registry = spark.createDataFrame([("m", "2024-01-01", 0.9), ("m", "2024-01-10", 0.8)], "g string, trained_at string, promoted_auc double")
    feedback = spark.createDataFrame([("m", 1, 0.9), ("m", 0, 0.1)], "g string, label int, score double")
    reports = spark.createDataFrame(
        [("m", "2024-01-11", ["x"]), ("m", "2024-01-12", [])], "g string, checked_at string, drift_warnings array<string>")
    row = gather_signals(registry, feedback, reports, "2024-01-25", ["g"]).first()
    assert tuple(row) == ("m", 15, 0.8, 1.0, False)


def test_guardrail_boundaries(spark):
    cases = {"a": (0.81, 0.80, "candidate"), "b": (0.8201, 0.81, "baseline"), "c": (0.70, 0.7999, "baseline"),
             "d": (0.8532, 0.8507, "candidate"), "e": (0.9, None, "baseline")}
    rows = [(k, m, "validation", "roc_auc", v) for k, (b, c, _) in cases.items() for m, v in (("baseline", b), ("candidate", c))]
    metrics = spark.createDataFrame(rows, "g string, model string, split string, metric string, value double")
    got = {r["g"]: r["promoted_model"] for r in promotion_decision(metrics, ["g"]).collect()}
    assert got == {k: want for k, (_, _, want) in cases.items()}
    one = metrics.filter("g = 'd'")
    assert promotion_decision(one, incumbent_auc=0.87).first()["promoted_model"] == "baseline"
    assert promotion_decision(one, guard=GuardrailConfig(min_auc=0.86)).first()["promoted_model"] == "baseline"


def test_alert_windows(spark):
    rows = [("00:01", 301.0, False), ("00:02", 301.0, False), ("00:06", 10.0, False), ("00:07", 10.0, True), ("00:11", 300.0, False)]
    log = spark.createDataFrame(rows, "t string, latency_ms double, is_error boolean").select(
        F.concat(F.lit("2024-01-01 "), F.col("t"), F.lit(":00")).cast("timestamp").alias("started_at"), "latency_ms", "is_error")
    got = {str(r["window_start"])[11:16]: (r["n_requests"], r["errors"], r["latency_alert"], r["error_alert"]) for r in latency_alerts(log).collect()}
    assert got == {"00:00": (2, 0, True, False), "00:05": (2, 1, False, True), "00:10": (1, 0, False, False)}


def test_positive_rate_moves(spark):
    rows = [("2024-01-01", 1)] * 5 + [("2024-01-01", 0)] * 5 + [("2024-01-02", 1)] * 2 + [("2024-01-02", 0)] * 8
    df = spark.createDataFrame(rows, "d string, churn_prediction int").withColumn("at", F.col("d").cast("timestamp"))
    for ref, want in ((0.2, [True, False]), (0.25, [False, False]), (0.5, [False, True])):
        got = positive_rate_alerts(df, ref, "at").orderBy("window_start").collect()
        assert [r["rate_alert"] for r in got] == want


def test_feedback_alerts_and_quarantined_feedback(spark):
    signals = spark.createDataFrame([("a", 0.79), ("b", 0.80), ("c", None)], "g string, recent_labeled_auc double")
    assert {r["g"]: r["auc_alert"] for r in feedback_alerts(signals).collect()} == {"a": True, "b": False, "c": False}
    registry = spark.createDataFrame([("g", "2024-01-01", 0.9)], "g string, trained_at string, promoted_auc double")
    rows = [("g", 1, 0.9, "ok"), ("g", 0, 0.1, "ok"), ("g", 1, 0.1, "bad"), ("g", 0, 0.9, "bad")]
    feedback = spark.createDataFrame(rows, "g string, label int, score double, batch string")
    reports = spark.createDataFrame([("g", "2024-01-02", [])], "g string, checked_at string, drift_warnings array<string>")
    held = spark.createDataFrame([("bad",)], "batch string")
    row = gather_signals(registry, feedback, reports, "2024-01-25", ["g"], quarantined=held).first()
    assert row["recent_labeled_auc"] == 1.0


def test_drift_uses_the_newest_statistics(customers, spark):
    stats = spark.createDataFrame([("v1", "monthly_charges", 10.0, 1.0, 5), ("v2", "monthly_charges", 81.0, 1.0, 5)], STATS)
    assert drift_warnings(customers(), stats).count() == 0
