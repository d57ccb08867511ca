"""Data quality, drift, the combined report, and quarantine of bad batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.lineage import cut_lineage
from ..operators.stats import batch_checks, drift_issues, quality_issues
from ..schemas import DQ_MAX_NULL_RATE
from ..sources.tables import append_rows, read_or_none


def dq_issues(df: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Broken quality rules: (by..., check, column, rate, threshold, message)."""
    threshold = f"CASE check WHEN 'null_rate' THEN {DQ_MAX_NULL_RATE}D WHEN 'out_of_range' THEN 0.0D END"
    return quality_issues(batch_checks(df, by)).filter("issue IS NOT NULL").select(
        *(by or []), "check", F.col("name").alias("column"), F.col("value").alias("rate"),
        F.expr(threshold).alias("threshold"), F.col("issue").alias("message"),
    )


def drift_warnings(df: DataFrame, stats: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Shifted features: (by..., feature, ref_mean, recent_mean, rel_shift, message)."""
    return drift_issues(batch_checks(df, by), stats).filter("warning IS NOT NULL").select(
        *(by or []), F.col("name").alias("feature"), "ref_mean", F.col("value").alias("recent_mean"),
        "rel_shift", F.col("warning").alias("message"),
    )


def monitor_report(df: DataFrame, stats: DataFrame | None, by: list[str] | None = None) -> DataFrame:
    """One report row per batch, from one scan of the batch.

    Without reference statistics, or when a payload column is missing, the
    drift list is empty and the quality list still stands.
    """
    by = by or []
    found = quality_issues(batch_checks(df, by))
    if stats is None:
        found = found.withColumn("warning", F.lit(None).cast("string"))
    else:
        found = drift_issues(found, stats)

    def messages(column: str) -> str:
        # One entry per check at most; NULL entries are skipped.
        kept = f"collect_list(CASE WHEN {column} IS NOT NULL THEN struct(pos, {column} AS m) END)"
        return f"transform(array_sort({kept}), e -> e.m)"

    return (
        found.groupBy(*by)
        .agg(
            F.max("n_rows").alias("n_rows_checked"),
            F.expr(messages("issue")).alias("data_quality_issues"),
            F.expr(messages("warning")).alias("drift_warnings"),
        )
        .withColumn("any_issue_detected", F.expr("size(data_quality_issues) > 0 OR size(drift_warnings) > 0"))
    )


def run_monitor(spark: SparkSession, recent: DataFrame, stats_path: str, report_path: str) -> DataFrame | None:
    """Monitoring job: append the report row and return it.

    Without stored statistics only the quality issues can be known; then no
    report is written and None is returned (see :func:`dq_issues`).
    """
    stats = read_or_none(spark, stats_path)
    if stats is None:
        return None
    newest = stats.agg(F.max("version")).scalar()
    report = monitor_report(recent, stats.filter(F.col("version") == newest)).withColumn(
        "checked_at", F.current_timestamp()
    )
    # One row per batch: stored before it is appended, so that the caller sees what the table has.
    report = cut_lineage(report, "table")
    append_rows(report, report_path)
    return report


def accepted_batches(df: DataFrame, quarantined: DataFrame | None) -> DataFrame:
    """The rows whose batch is not among ``quarantined`` (null-safe on its columns); None quarantines nothing."""
    if quarantined is None:
        return df
    held = quarantined.select(*[F.col(c).alias(f"_q_{c}") for c in quarantined.columns]).distinct()
    return df.join(held, [F.col(c).eqNullSafe(F.col(f"_q_{c}")) for c in quarantined.columns], "left_anti")


def with_quarantine(df: DataFrame, stats: DataFrame, batch: list[str]) -> DataFrame:
    """All rows with ``quarantined``: true when their batch has any issue or warning.

    Such a batch is kept out of training and feedback metrics until a person
    has looked at it.  The reports are stored first: their size is then known
    to the planner, which broadcasts them while they are small, and the rows
    themselves are not shuffled.
    """
    flagged = cut_lineage(monitor_report(df, stats, batch).filter("any_issue_detected"), "table")
    flagged = flagged.select(*[F.col(b).alias(f"_b_{b}") for b in batch], F.lit(True).alias("_flag"))
    same = [F.col(b).eqNullSafe(F.col(f"_b_{b}")) for b in batch]
    return df.join(flagged, same, "left").withColumn(
        "quarantined", F.coalesce("_flag", F.lit(False))
    ).drop("_flag", *[f"_b_{b}" for b in batch])


def quarantine_split(df: DataFrame, stats: DataFrame, batch: list[str]) -> tuple[DataFrame, DataFrame]:
    """(accepted rows, quarantined rows)."""
    marked = with_quarantine(df, stats, batch)
    return marked.filter("NOT quarantined").drop("quarantined"), marked.filter("quarantined").drop("quarantined")
