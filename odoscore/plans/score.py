"""Scoring: one projection for batch and stream."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.contract import validate_rows
from ..functions.features import features
from ..schemas import DECISION_THRESHOLD
from .train import positive_probability


REJECT_COLUMNS = ["violations", "model_version"]


def score_or_reject(
    df: DataFrame, model: PipelineModel, version: str, promoted: str, keep: list[str], received_at: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """(predictions, rejected payloads with their violations): every input row is in one of the two."""
    valid, rejected = validate_rows(df)
    return (
        score(valid, model, version, promoted, keep, received_at),
        rejected.withColumn("model_version", F.lit(version)).select(*keep, *REJECT_COLUMNS),
    )


def write_scores(
    df: DataFrame, table: str, rejects: str, model: PipelineModel, version: str, promoted: str, keep: list[str], batch: int = 0
) -> None:
    """Both halves as the partition ``batch`` of their tables; running a batch again replaces its rows."""
    for rows, path in zip(score_or_reject(df, model, version, promoted, keep), (table, rejects)):
        rows.write.mode("overwrite").parquet(f"{path}/batch={batch}")


def score(
    df: DataFrame,
    model: PipelineModel,
    version: str,
    promoted: str,
    keep: list[str] | None = None,
    received_at: str | None = None,
) -> DataFrame:
    """Prediction records for rows that satisfy the payload contract.

    The label compares the unrounded probability (>=) with the threshold; the
    probability is rounded afterwards.  ``latency_ms`` is the time since
    ``received_at`` when that column is given.
    """
    keep = list(keep or [])
    carried = keep + ([received_at] if received_at and received_at not in keep else [])
    p = positive_probability()
    latency = F.lit(None).cast("double")
    if received_at:
        now = F.unix_micros(F.current_timestamp())
        latency = F.bround((now - F.unix_micros(F.col(received_at).cast("timestamp"))) / 1000, 3)
    return model.transform(features(df, carried)).select(
        *keep,
        F.bround(p, 4).alias("churn_probability"),
        (p >= DECISION_THRESHOLD).cast("int").alias("churn_prediction"),
        F.lit(version).alias("model_version"),
        F.lit(promoted).alias("promoted_model_type"),
        latency.alias("latency_ms"),
    )
