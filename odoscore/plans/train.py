"""Training: split, scale, fit both models, evaluate, decide, store."""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import JobConfig, ModelConfig
from ..functions.cleaning import unusable
from ..functions.features import features, featureless
from ..operators.lineage import cut_lineage
from ..operators.metrics import classification_metrics, long_metrics
from ..operators.ranking import stratified_split
from ..operators.stats import feature_stats
from ..schemas import FEATURES
from ..session import shared_root
from ..sources.tables import export_json, latest_entry, read_or_none, registry_entry, replace_partitions
from .monitor import accepted_batches
from .promotion import promotion_decision

Scaler = dict[str, tuple[float, float]]

#: A task of fewer rows costs more than it saves; one of more rows holds too much in memory.
TASK_ROWS = (20_000, 1_000_000)


@dataclass(frozen=True)
class TrainingRun:
    version: str
    models: dict[str, PipelineModel]
    metrics: DataFrame        # version, model, split, metric, value
    decision: DataFrame       # one row
    stats: DataFrame          # reference feature statistics of the train split
    promoted: str


def trainable(label: str = "churn") -> Column:
    """Rows with a label, a tenure bin and both charges; the rest belong in quarantine."""
    charges = [F.col(c).isNotNull() & ~F.isnan(c) for c in ("monthly_charges", "total_charges")]
    return ~unusable(label) & ~featureless() & charges[0] & charges[1]


def untrainable_rows(snapshots: DataFrame, config: JobConfig, version: str) -> DataFrame:
    """The rows training leaves out: key, reason, version."""
    missing = [
        F.when(F.col(c).isNull() | F.isnan(c), F.lit(f"no {c}")) for c in ("monthly_charges", "total_charges")
    ]
    reasons = F.concat_ws("; ", F.when(unusable(config.label), F.lit("no usable label")), F.when(featureless(), F.lit("tenure out of range")), *missing)
    return snapshots.filter(~trainable(config.label)).select(config.key, reasons.alias("reason"), F.lit(version).alias("version"))


def split_features(snapshots: DataFrame, config: JobConfig) -> DataFrame:
    """Key, label, the 16 features and ``split``."""
    frame = features(snapshots.filter(trainable(config.label)), [config.key, config.label])
    s = config.split
    return stratified_split(frame, config.label, config.key, s.validation, s.test, s.seed)


def fit_scaler(train: DataFrame) -> Scaler:
    """Mean and population deviation per feature, in one pass: 32 numbers for the driver.

    A constant feature is divided by 1.
    """
    row = train.agg(
        *[F.avg(f).alias(f"m_{f}") for f in FEATURES], *[F.stddev_pop(f).alias(f"s_{f}") for f in FEATURES]
    ).first()
    return {f: (float(row[f"m_{f}"]), float(row[f"s_{f}"]) or 1.0) for f in FEATURES}


def standardize(df: DataFrame, scaler: Scaler, keep: list[str] | None = None) -> DataFrame:
    return df.select(*(keep or []), *[((F.col(f) - m) / s).alias(f) for f, (m, s) in scaler.items()])


def standardized_features(split: DataFrame, keep: list[str]) -> DataFrame:
    """Fit on the train rows of ``split``, applied to all rows, as one lazy plan."""
    stats = split.filter("split = 'train'").agg(
        F.struct(*[
            F.struct(F.avg(f).alias("m"), F.when(F.stddev_pop(f) > 0, F.stddev_pop(f)).otherwise(1.0).alias("s")).alias(f)
            for f in FEATURES
        ]).alias("z")
    )
    scaled = [((F.col(f) - F.col(f"_z.{f}.m")) / F.col(f"_z.{f}.s")).alias(f) for f in FEATURES]
    return split.withColumn("_z", stats.scalar()).select(*keep, *scaled)


def scaling_stages(scaler: Scaler) -> list:
    """The scaler as persistable pipeline stages, so scoring cannot use another one."""
    scaled = ", ".join(f"(CAST({f} AS DOUBLE) - ({m!r}D)) / ({s!r}D) AS z_{f}" for f, (m, s) in scaler.items())
    return [
        SQLTransformer(statement=f"SELECT *, {scaled} FROM __THIS__"),
        VectorAssembler(inputCols=[f"z_{f}" for f in FEATURES], outputCol="scaled"),
    ]


def training_tasks(n_rows: int, cores: int) -> int:
    """Tasks of each pass over the training rows: one per core, fewer for few rows, whole rounds of all cores for many."""
    least, most = TASK_ROWS
    return max(1, min(cores, math.ceil(n_rows / least))) * max(1, math.ceil(n_rows / (most * cores)))


def training_rows(train: DataFrame, stages: list, label: str, n_train: int) -> DataFrame:
    """Label and scaled features, dealt evenly: boosting passes over them hundreds of times.

    Without that a pass has a task per stored file or row group, and one file is one task on any cluster.
    """
    rows = PipelineModel(stages).transform(train).select(label, "scaled")
    return rows.repartition(training_tasks(n_train, train.sparkSession.sparkContext.defaultParallelism))


def estimator(spec: ModelConfig, label: str, n_train: int, seed: int):
    p = spec.params
    if spec.kind == "logistic_regression":
        # An L2 weight C on the summed loss equals 1/(C*n) on the mean loss.
        return LogisticRegression(
            featuresCol="scaled", labelCol=label, regParam=1.0 / (p.get("C", 1.0) * n_train), elasticNetParam=0.0,
            standardization=False, maxIter=int(p.get("max_iter", 100)), tol=1e-8,
        )
    if spec.kind == "gradient_boosting":
        return GBTClassifier(
            featuresCol="scaled", labelCol=label, maxIter=int(p.get("n_estimators", 100)),
            maxDepth=int(p.get("max_depth", 3)), stepSize=float(p.get("learning_rate", 0.1)), seed=seed,
            checkpointInterval=10,
        )
    raise ValueError(f"unknown model kind {spec.kind!r}")


def positive_probability() -> Column:
    return F.get(vector_to_array("probability"), F.lit(1))


def evaluate(models: dict[str, PipelineModel], held_out: DataFrame, label: str, version: str) -> DataFrame:
    """Long metrics of every model on every held-out split, from one scored frame."""
    scored = [
        model.transform(held_out).select(
            F.lit(name).alias("model"), "split", F.col(label).alias("label"), positive_probability().alias("score")
        )
        for name, model in models.items()
    ]
    every = reduce(DataFrame.unionByName, scored)
    table = long_metrics(classification_metrics(every, by=["model", "split"]), ["model", "split"])
    return table.select(F.lit(version).alias("version"), "model", "split", "metric", "value")


def train_and_evaluate(
    spark: SparkSession, snapshots: DataFrame, version: str, trained_at: str, config: JobConfig = JobConfig(),
    quarantined: DataFrame | None = None,
) -> TrainingRun:
    """Full run.  With ``config.artifact_root`` it also stores models, registry, metrics, statistics and rejected rows.

    Rows of the batches that ``quarantined`` names (by the columns it has) take no part.  The stored outputs are
    partitions of their version: a run that is repeated replaces its own.
    """
    shared_root(spark)      # tree training checkpoints there
    snapshots = accepted_batches(snapshots, quarantined)
    # Stored, not cached: read four times, column by column, and safe from lost executors.
    split = cut_lineage(split_features(snapshots, config), "table")
    train = split.filter("split = 'train'")
    scaler = fit_scaler(train)
    stages = scaling_stages(scaler)
    n_train = train.count()
    prepared = training_rows(train, stages, config.label, n_train).persist()
    models = {}
    for name, spec in (("baseline", config.baseline), ("candidate", config.candidate)):
        fitted = estimator(spec, config.label, n_train, config.split.seed).fit(prepared)
        models[name] = PipelineModel([*stages, fitted])
    prepared.unpersist()
    # 16 metric rows and 16 statistics rows: kept as local tables, so nothing
    # below trains or scores twice.
    metrics = _small(evaluate(models, split.filter("split <> 'train'"), config.label, version))
    stats = _small(feature_stats(train, version))
    decision = promotion_decision(metrics, guard=config.guardrail)
    promoted = decision.first()["promoted_model"]
    if config.artifact_root is not None:
        for name, model in models.items():
            model.write().overwrite().save(config.table(f"models/{version}/{name}"))
        entry = registry_entry(metrics, decision, config, trained_at, version)
        export_json(entry, config.table(f"reports/{version}"))
        rejected = untrainable_rows(snapshots, config, version)
        tables = {"model_eval": metrics, "feature_stats": stats, "train_rejects": rejected, "model_registry": entry}
        for name, rows in tables.items():
            replace_partitions(rows, config.table(name), "version")
    return TrainingRun(version, models, metrics, decision, stats, promoted)


def _small(df: DataFrame) -> DataFrame:
    return df.sparkSession.createDataFrame(df.collect(), df.schema)


def load_current(spark: SparkSession, config: JobConfig) -> tuple[PipelineModel, str, str]:
    """(model, version, promoted model) of the newest registry entry."""
    registry = read_or_none(spark, config.table("model_registry"))
    row = None if registry is None else latest_entry(registry, "trained_at_utc").first()
    if row is None:
        raise FileNotFoundError("no model in the registry: train one first")
    path = config.table(f"models/{row['version']}/{row['promoted_model']}")
    return PipelineModel.load(path), row["version"], row["promoted_model"]
