"""Promotion guardrail."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import GuardrailConfig


def promotion_decision(
    metrics: DataFrame,
    by: list[str] | None = None,
    guard: GuardrailConfig = GuardrailConfig(),
    incumbent_auc: float | None = None,
) -> DataFrame:
    """Candidate or baseline, from long metrics (by..., model, split, metric, value).

    The candidate wins with a validation AUC of at least ``min_auc`` that is at
    most ``max_regression`` below the baseline of the same run (or below
    ``incumbent_auc`` when given).  The gap is rounded before the comparison.
    """
    by = by or []
    val_auc = (F.col("split") == "validation") & (F.col("metric") == "roc_auc")
    pivot = metrics.filter(val_auc).groupBy(*by).agg(
        *[F.max(F.when(F.col("model") == m, F.col("value"))).alias(f"{m}_val_auc") for m in ("baseline", "candidate")]
    )
    base = F.col("baseline_val_auc") if incumbent_auc is None else F.lit(float(incumbent_auc))
    gap = F.round(base - F.col("candidate_val_auc"), 10)
    no = F.lit(False)
    return (
        pivot.withColumn("meets_min_auc", F.coalesce(F.col("candidate_val_auc") >= guard.min_auc, no))
        .withColumn("not_much_worse", F.coalesce(gap <= guard.max_regression, no))
        .withColumn(
            "promoted_model",
            F.when(F.col("meets_min_auc") & F.col("not_much_worse"), "candidate").otherwise("baseline"),
        )
    )
