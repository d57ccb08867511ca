"""Table sinks: lake writes, partition swaps, append-only logs, model registry."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import FEATURES

# Written by one training run; metrics are nested as in the exported JSON record.
_METRICS = "struct<accuracy:double,roc_auc:double,n_samples:bigint,positive_rate:double>"
_MODEL = f"struct<model_type:string,params:map<string,double>,val_metrics:{_METRICS},test_metrics:{_METRICS}>"
REGISTRY = (
    "version string, promoted_model string, trained_at_utc timestamp, "
    f"metrics struct<baseline:{_MODEL},candidate:{_MODEL}>, "
    "decision struct<baseline_val_auc:double,candidate_val_auc:double,rule:string,"
    "meets_min_auc:boolean,not_much_worse_than_baseline:boolean,promoted_model:string>, "
    "feature_columns array<string>"
)


def write_parts(df: DataFrame, path: str, mode: str = "error") -> None:
    """One part file per task."""
    df.write.mode(mode).parquet(path)


def write_lake(df: DataFrame, path: str, time: str = "event_ts", mode: str = "append") -> None:
    """Partition the raw lake by event date, for time-window queries with pruning.

    The rebalance hint lets AQE split a hot date over several tasks and merge
    thin ones, so neither one huge nor many tiny files come out.
    """
    dated = df.withColumn("event_date", F.col(time).cast("date"))
    dated.hint("rebalance", "event_date").write.mode(mode).partitionBy("event_date").parquet(path)


def read_or_none(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def replace_partitions(df: DataFrame, path: str, partition: str) -> None:
    """Overwrite only the partitions present in ``df`` (files are swapped in at commit)."""
    (
        df.hint("rebalance", partition)
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)
    )


def append_rows(df: DataFrame, path: str) -> None:
    """Append to a log-like table (ingest log, registry, evaluation, statistics, reports)."""
    df.write.mode("append").parquet(path)


def export_json(df: DataFrame, path: str) -> None:
    """Small report (a few rows) as one JSON file."""
    df.coalesce(1).write.mode("overwrite").json(path)


def latest_entry(table: DataFrame, time: str, by: list[str] | None = None, tie: str | None = None) -> DataFrame:
    """The newest row, or the newest row per ``by`` group.

    ``max_by`` combines on the map side: one row per group and task is moved.
    """
    by = by or []
    order = F.struct(time, tie) if tie else F.col(time)
    rest = [c for c in table.columns if c not in by]
    newest = F.max_by(F.struct(*rest), order).alias("_r")
    # Without groups the aggregate has a row even for an empty table.
    out = table.groupBy(*by).agg(newest).filter(F.col("_r").isNotNull()).select(*by, "_r.*")
    return out.select(*table.columns)


def read_registry_json(spark: SparkSession, path: str) -> DataFrame:
    """An exported registry file: a list or a single record; a broken file is an empty history."""
    rows = (
        spark.read.schema(REGISTRY + ", _broken string")
        .option("multiLine", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_broken")
        .json(path)
    )
    # The column is compared next to a data column: Spark forbids reading it alone.
    return rows.filter(F.col("_broken").isNull() & F.col("version").isNotNull()).drop("_broken")


def registry_entry(metrics: DataFrame, decision: DataFrame, config, trained_at: str, version: str) -> DataFrame:
    """One registry row from long metrics (model, split, metric, value) and the decision row."""

    def model(name: str, spec) -> Column:
        def split(which: str):
            def value(metric: str):
                return F.max(F.when(
                    (F.col("model") == name) & (F.col("split") == which) & (F.col("metric") == metric), F.col("value")
                ))

            return F.struct(
                value("accuracy"), value("roc_auc"), value("n_samples").cast("bigint"), value("positive_rate")
            )

        params = F.create_map(*[F.lit(x) for k, v in spec.params.items() for x in (k, float(v))])
        return F.struct(F.lit(spec.kind), params, split("validation"), split("test")).cast(_MODEL)

    row = metrics.agg(
        F.struct(model("baseline", config.baseline), model("candidate", config.candidate)).alias("metrics")
    )
    guard = config.guardrail
    rule = (
        f"promote candidate if candidate_auc >= {guard.min_auc} "
        f"AND (baseline_auc - candidate_auc) <= {guard.max_regression}"
    )
    chosen = decision.select(F.struct(
        "baseline_val_auc", "candidate_val_auc", F.lit(rule).alias("rule"), "meets_min_auc",
        F.col("not_much_worse").alias("not_much_worse_than_baseline"), "promoted_model",
    )).scalar()
    return (
        row.withColumn("decision", chosen)
        .select(
            F.lit(version).alias("version"),
            F.col("decision.promoted_model").alias("promoted_model"),
            F.lit(trained_at).cast("timestamp").alias("trained_at_utc"),
            F.col("metrics").cast(f"struct<baseline:{_MODEL},candidate:{_MODEL}>").alias("metrics"),
            "decision",
            F.array(*[F.lit(f) for f in FEATURES]).alias("feature_columns"),
        )
    )


def version_stamp(time) -> Column:
    """Version string of a training time: vYYYYMMDD_HHMMSS."""
    return F.date_format(time, "'v'yyyyMMdd_HHmmss")
