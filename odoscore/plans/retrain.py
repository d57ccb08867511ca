"""Retraining signals and decision."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.metrics import classification_metrics
from ..schemas import FEEDBACK_MIN_AUC, RETRAIN_MAX_AUC_DROP, RETRAIN_MAX_DAYS
from ..sources.tables import latest_entry
from .monitor import accepted_batches


def _three(column: Column) -> Column:
    return F.bround(column, 3).try_cast("decimal(38,3)").cast("string")


def retrain_decisions(signals: DataFrame) -> DataFrame:
    """Add ``reasons`` (staleness, performance, drift, in that order) and ``should_retrain``.

    Signals: days_since_last_training, current_model_promotion_auc,
    recent_labeled_auc (NULL without enough feedback), drift_detected.
    The AUC drop is rounded before it meets its threshold, so a drop of
    exactly the threshold counts in binary floats too.
    """
    days, was, now = (
        F.col("days_since_last_training"), F.col("current_model_promotion_auc"), F.col("recent_labeled_auc"),
    )
    drop = was - now
    stale = F.when(
        days >= RETRAIN_MAX_DAYS,
        F.concat(F.lit("staleness: "), days.cast("string"),
                 F.lit(f" days since last training (threshold={RETRAIN_MAX_DAYS})")),
    )
    worse = F.when(
        F.round(drop, 10) >= RETRAIN_MAX_AUC_DROP,
        F.concat(F.lit("performance drop: AUC fell from "), _three(was), F.lit(" to "), _three(now),
                 F.lit(" (drop="), _three(drop), F.lit(f", threshold={RETRAIN_MAX_AUC_DROP})")),
    )
    drift = F.when(F.col("drift_detected"), F.lit("feature drift detected by the monitoring job"))
    return signals.withColumn("reasons", F.array_compact(F.array(stale, worse, drift))).withColumn(
        "should_retrain", F.size("reasons") > 0
    )


def feedback_alerts(signals: DataFrame, floor: float = FEEDBACK_MIN_AUC) -> DataFrame:
    """Add ``auc_alert``: the AUC on labelled feedback is known and below the floor."""
    low = F.round("recent_labeled_auc", 10) < floor
    return signals.withColumn("auc_alert", F.coalesce(low, F.lit(False)))


def gather_signals(
    registry: DataFrame, feedback: DataFrame, reports: DataFrame, as_of, group: list[str],
    label: str = "label", score: str = "score", quarantined: DataFrame | None = None,
) -> DataFrame:
    """Signals per model group: newest registry entry, AUC on feedback, newest report.

    ``registry`` has (group..., trained_at, promoted_auc), ``feedback``
    (group..., label, score), ``reports`` (group..., checked_at,
    drift_warnings).  ``as_of`` is the decision date.  Feedback of the batches that
    ``quarantined`` names does not count.
    """
    newest = latest_entry(registry, "trained_at", group)
    recent = classification_metrics(accepted_batches(feedback, quarantined), label, score, group).select(
        *group, F.col("roc_auc").alias("recent_labeled_auc")
    )
    drift = latest_entry(reports, "checked_at", group).select(
        *group, (F.size("drift_warnings") > 0).alias("drift_detected")
    )
    return newest.join(recent, group, "left").join(drift, group, "left").select(
        *group,
        F.datediff(F.lit(as_of).cast("date"), F.col("trained_at").cast("date")).alias("days_since_last_training"),
        F.col("promoted_auc").alias("current_model_promotion_auc"),
        "recent_labeled_auc",
        F.coalesce("drift_detected", F.lit(False)).alias("drift_detected"),
    )
