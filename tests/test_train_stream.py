import numpy as np
import pytest
from pyspark.sql import functions as F

from odoscore.config import JobConfig, ModelConfig
from odoscore.functions.features import features
from odoscore.operators.aggregate import average_by_key
from odoscore.plans import train as t
from odoscore.plans.ingest import STORED, IngestPaths
from odoscore.plans.score import score, score_or_reject
from odoscore.schemas import FEATURES, SNAPSHOT, SNAPSHOT_COLUMNS, TELEMETRY
from odoscore.sources.customers import generate_customers
from odoscore.sources.tables import read_or_none
from odoscore.streaming import jobs
from odoscore.workload import decisions
from odoscore.workload.customers import clean


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    config = JobConfig(
        candidate=ModelConfig("gradient_boosting", {"n_estimators": 8, "max_depth": 3, "learning_rate": 0.1}),
        artifact_root=str(tmp_path_factory.mktemp("artifacts")),
    )
    rows = generate_customers(spark, 800, seed=123)
    return config, rows, t.train_and_evaluate(spark, rows, "v20240101_000000", "2024-01-01 00:00:00", config)


def test_metrics_table(run):
    _, _, result = run
    got = {(r["model"], r["split"], r["metric"]): r["value"] for r in result.metrics.collect()}
    assert len(got) == 16
    for model in ("baseline", "candidate"):
        assert 0.6 < got[(model, "validation", "roc_auc")] < 0.95
        assert got[(model, "validation", "n_samples")] + got[(model, "test", "n_samples")] == 240


def test_logistic_regression_solves_the_penalised_problem(run, spark):
    """Gradient of 0.5*|w|^2 + sum of losses (C = 1) is zero on population-scaled inputs."""
    config, rows, result = run
    train = t.split_features(rows, config).filter("split = 'train'").toPandas()
    x = train[FEATURES].to_numpy(float)
    std = x.std(axis=0)
    std[std == 0] = 1
    x, y = (x - x.mean(axis=0)) / std, train["churn"].to_numpy(float)
    model = result.models["baseline"].stages[-1]
    w, b = model.coefficients.toArray(), model.intercept
    p = 1 / (1 + np.exp(-(x @ w + b)))
    assert np.abs(x.T @ (p - y) + w).max() < 0.05 and abs((p - y).sum()) < 0.05


def test_artifacts_and_reload(run, spark):
    config, rows, result = run
    registry = spark.read.parquet(config.table("model_registry")).first()
    assert registry["version"] == result.version and registry["promoted_model"] == result.promoted
    assert registry["feature_columns"] == FEATURES
    auc = result.metrics.filter("model = 'candidate' AND split = 'validation' AND metric = 'roc_auc'").first()["value"]
    assert registry["metrics"]["candidate"]["val_metrics"]["roc_auc"] == auc
    assert registry["decision"]["promoted_model"] == result.promoted
    assert read_or_none(spark, config.table("feature_stats")).count() == 16
    assert spark.read.parquet(config.table("model_eval")).count() == 16
    assert spark.read.json(config.table(f"reports/{result.version}")).count() == 1
    model, version, promoted = t.load_current(spark, config)
    one = score(rows, model, version, promoted, ["customer_id"])
    two = score(rows, result.models[result.promoted], version, promoted, ["customer_id"])
    assert one.exceptAll(two).isEmpty() and one.count() == 800
    with pytest.raises(FileNotFoundError):
        t.load_current(spark, JobConfig(artifact_root="/nowhere/at/all"))


def test_scores_have_the_right_direction_and_shape(run, customers):
    """Over a sweep of tenures, a longer contract lowers the probability."""
    _, _, result = run
    contracts, tenures = ["month_to_month", "one_year", "two_year"], [1, 7, 18, 33, 66]
    rows = customers(*[
        {"customer_id": f"{c}/{t}", "contract_type": c, "tenure_months": t, "total_charges": 81.25 * t} for c in contracts for t in tenures
    ])
    got = {r["customer_id"]: r for r in score(rows, result.models["baseline"], "v", "baseline", ["customer_id"]).collect()}
    for t_ in tenures:
        chances = [got[f"{c}/{t_}"]["churn_probability"] for c in contracts]
        assert chances == sorted(chances, reverse=True) and chances[0] > chances[2]
    for r in got.values():
        assert r["churn_prediction"] == int(r["churn_probability"] >= 0.5) and r["model_version"] == "v"
        assert r["churn_probability"] == round(r["churn_probability"], 4)


def test_every_payload_is_scored_or_kept_with_its_violations(run, spark, customers, tmp_path):
    _, _, result = run
    rows = customers({}, {"customer_id": "b", "tenure_months": -1}, {"customer_id": "c", "contract_type": None, "total_charges": None})
    model = result.models["baseline"]
    good, bad = score_or_reject(rows, model, "v", "baseline", ["customer_id"])
    assert [r["customer_id"] for r in good.collect()] == ["C1"]
    assert {r["customer_id"]: r["violations"] for r in bad.collect()} == {"b": ["tenure_months"], "c": ["contract_type", "total_charges"]}
    paths = [str(tmp_path / n) for n in ("in", "scores", "rejects")]
    rows.write.parquet(paths[0])
    for attempt in ("a", "b"):      # a replay replaces its rows
        stream = spark.readStream.schema(rows.schema).parquet(paths[0])
        jobs.start_scores(stream, *paths[1:], str(tmp_path / attempt), model, "v", "baseline", ["customer_id"]).awaitTermination()
        assert (spark.read.parquet(paths[1]).count(), spark.read.parquet(paths[2]).count()) == (1, 2)


def test_a_repeated_training_run_replaces_its_outputs(spark, tmp_path):
    config = JobConfig(candidate=ModelConfig("gradient_boosting", {"n_estimators": 2, "max_depth": 2, "learning_rate": 0.1}),
                       artifact_root=str(tmp_path / "art"))
    rows = generate_customers(spark, 300, seed=4).withColumn("batch", F.when(F.col("tenure_months") < 5, "early").otherwise("late"))
    odd = rows.limit(3).withColumns({"churn": F.lit(None).cast("int"), "customer_id": F.concat(F.lit("x"), "customer_id"), "batch": F.lit("late")})
    held = spark.createDataFrame([("early",)], "batch string")
    n = rows.filter("batch = 'late'").count()
    for _ in range(2):
        result = t.train_and_evaluate(spark, rows.unionByName(odd), "v1", "2024-01-01 00:00:00", config, held)
    tables = {name: spark.read.parquet(config.table(name)).count() for name in ("model_eval", "feature_stats", "train_rejects", "model_registry")}
    assert tables == {"model_eval": 16, "feature_stats": 16, "train_rejects": 3, "model_registry": 1}
    assert {r["reason"] for r in spark.read.parquet(config.table("train_rejects")).collect()} == {"no usable label"}
    held_out = result.metrics.filter("model = 'baseline' AND metric = 'n_samples'").agg(F.sum("value")).first()[0]
    assert abs(held_out - 0.3 * n) <= 3


def test_standardised_forms_agree_and_constant_feature_is_safe(spark, customers):
    frame = features(customers({}, {"customer_id": "b", "tenure_months": 20}, {"customer_id": "c", "monthly_charges": 10.0}),
                     ["customer_id"]).withColumn("split", F.when(F.col("customer_id") == "c", "test").otherwise("train"))
    scaler = t.fit_scaler(frame.filter("split = 'train'"))
    assert scaler["senior_citizen"] == (0.0, 1.0) and scaler["tenure_months"] == (14.5, 5.5)
    a = t.standardize(frame, scaler, ["customer_id"]).orderBy("customer_id").collect()
    b = t.standardized_features(frame, ["customer_id"]).orderBy("customer_id").collect()
    assert a == b


def test_untrainable_rows_are_left_out(customers):
    rows = customers({}, {"customer_id": "b", "churn": None}, {"customer_id": "c", "tenure_months": 1001},
                     {"customer_id": "d", "monthly_charges": float("nan")}, {"customer_id": "e", "contract_type": None})
    assert {r["customer_id"] for r in rows.filter(t.trainable()).collect()} == {"C1", "e"}


def rows_by_task(df):
    return sorted(r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect())


def test_training_rows_of_one_file_go_to_every_core(spark, monkeypatch):
    """Each pass over the training rows is shared out, even if the snapshots are one file."""
    seen = {}

    class Recorder:
        def fit(self, rows):
            seen["tasks"] = rows_by_task(rows)
            raise InterruptedError

    monkeypatch.setattr(t, "estimator", lambda *_: Recorder())
    monkeypatch.setattr(t, "TASK_ROWS", (500, 1000), raising=False)
    with pytest.raises(InterruptedError):
        t.train_and_evaluate(spark, generate_customers(spark, 8000, seed=5).coalesce(1), "v", "2024-01-01 00:00:00")
    assert len(seen["tasks"]) == 8 and sum(seen["tasks"]) == 5600 and seen["tasks"][-1] <= 2 * seen["tasks"][0]
    assert [t.training_tasks(n, 4) for n in (0, 500, 501, 4000, 4001)] == [1, 1, 2, 4, 8]


def test_customers_of_one_file_are_prepared_by_every_core(spark, tmp_path, monkeypatch):
    """Filters and the label are not computed in the task that reads the file; repeated and null keys are kept."""
    keys = F.when(F.col("id") % 50 != 0, F.col("id") % 1500)
    table = spark.range(2000).select(keys.alias("c_custkey"), (F.col("id") % 25).cast("int").alias("c_nationkey"))
    table.coalesce(1).write.parquet(str(tmp_path / "customer.parquet"))
    monkeypatch.setattr(decisions, "train_and_evaluate", lambda spark, snapshots, *_: snapshots)
    monkeypatch.setattr(decisions, "_RUNS", {})
    rows, plain = decisions.training_run(spark, str(tmp_path)), clean(spark, str(tmp_path))
    tasks = rows_by_task(rows.filter(t.trainable()))
    assert len(tasks) == 4 and tasks[-1] <= 2 * tasks[0]
    assert rows.count() == 2000 and rows.exceptAll(plain).isEmpty() and plain.exceptAll(rows).isEmpty()


# --- streams -------------------------------------------------------------------
def reading(minute, model, temp):
    return f"EV-1,{model},{'' if temp is None else temp},1,1,1,1,1,2024-01-01 00:{minute:02d}:00"


HEAD = "vehicle_id,vehicle_model,engine_temp,speed,latitude,longitude,battery_efficiency,miles,event_ts\n"
STREAM_SCHEMA = TELEMETRY + ", event_ts timestamp"


def feed(folder, name, *lines):
    (folder / name).write_text(HEAD + "\n".join(lines) + "\n")


def test_late_rows_and_archive(spark, tmp_path):
    """Files one by one: a row behind the watermark is dropped, an in-time one is not."""
    inbox, archive = tmp_path / "in", tmp_path / "done"
    inbox.mkdir()
    out, state = str(tmp_path / "out"), str(tmp_path / "state")

    def drain():
        stream = jobs.telemetry_csv_stream(spark, str(inbox), STREAM_SCHEMA, str(archive))
        query = jobs.start_table(jobs.average_temperature(stream), out, state)
        query.awaitTermination()
        return query

    feed(inbox, "1.csv", reading(1, "a", 10.0), reading(2, "a", None), reading(6, "a", 30.0))
    drain()
    feed(inbox, "2.csv", reading(3, "a", 20.0), reading(40, "a", 1.0))      # minute 3 is late but still open
    drain()
    feed(inbox, "3.csv", reading(4, "a", 99.0), reading(59, "a", 1.0))      # minute 4 is closed by now
    drain()
    got = {str(r["window_start"])[14:16]: (r["avg_engine_temp"], r["n_records"]) for r in spark.read.parquet(out).collect()}
    assert got == {"00": (15.0, 2), "05": (30.0, 1), "40": (1.0, 1)}
    assert list(archive.rglob("1.csv"))


def test_closed_windows_equal_batch(spark, tmp_path):
    inbox = tmp_path / "in"
    inbox.mkdir()
    feed(inbox, "all.csv", *[reading(i % 50, "ab"[i % 2], float(i)) for i in range(120)], reading(59, "flush", 1.0))
    stream = jobs.telemetry_csv_stream(spark, str(inbox), STREAM_SCHEMA)
    out = jobs.run_to_table(jobs.average_temperature(stream, lateness="1 minute"), "t").filter("vehicle_model <> 'flush'")
    batch = spark.read.schema(STREAM_SCHEMA).option("header", True).csv(str(inbox)).filter("vehicle_model <> 'flush'")
    batch = average_by_key(batch.withColumn("w", F.window("event_ts", "5 minutes").start).withColumn(
        "key", F.struct("w", "vehicle_model")), "key").select("key.w", "key.vehicle_model", "avg_engine_temp", "n_records")
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, batch.collect()))


def test_repeated_deliveries_count_once(spark, tmp_path):
    inbox = tmp_path / "in"
    inbox.mkdir()
    feed(inbox, "1.csv", reading(1, "a", 1.0), reading(1, "a", 1.0), reading(2, "b", 1.0))
    stream = jobs.telemetry_csv_stream(spark, str(inbox), STREAM_SCHEMA)
    out, state = str(tmp_path / "o"), str(tmp_path / "s")
    jobs.start_table(jobs.deduplicated(stream, ["vehicle_model", "event_ts"], "event_ts"), out, state).awaitTermination()
    feed(inbox, "2.csv", reading(1, "a", 1.0), reading(3, "c", 1.0))
    jobs.start_table(jobs.deduplicated(jobs.telemetry_csv_stream(spark, str(inbox), STREAM_SCHEMA), ["vehicle_model", "event_ts"],
                                       "event_ts"), out, state).awaitTermination()
    assert sorted(r["vehicle_model"] for r in spark.read.parquet(out).collect()) == ["a", "b", "c"]


def test_stream_features_and_scores_equal_batch(run, spark, tmp_path):
    _, rows, result = run
    path = str(tmp_path / "payloads")
    rows.write.parquet(path)
    stream = spark.readStream.schema(SNAPSHOT).parquet(path)
    got = jobs.run_to_table(features(stream, ["customer_id"]), "f")
    assert got.exceptAll(features(rows, ["customer_id"])).isEmpty() and got.count() == 800
    model = result.models["candidate"]
    rows.limit(3).withColumns({"tenure_months": F.lit(-5), "customer_id": F.concat("customer_id", F.lit("x"))}).write.mode("append").parquet(path)
    good, bad = jobs.scored_and_rejected(stream, model, "v", "candidate", ["customer_id"])
    scores, rejects = jobs.run_to_table(good, "s"), jobs.run_to_table(bad, "r")
    assert scores.exceptAll(score(rows, model, "v", "candidate", ["customer_id"])).isEmpty() and scores.count() == 800
    assert rejects.count() == 3 and rejects.where("size(violations) = 0").isEmpty()


def test_customer_files_are_ingested_as_they_land(spark, tmp_path):
    paths = IngestPaths(*[str(tmp_path / n) for n in ("in", "processed", "log", "quarantine")])
    (tmp_path / "in").mkdir()

    def land(name, columns, n):
        rows = generate_customers(spark, n, seed=n).toPandas()
        rows[columns].to_csv(tmp_path / "in" / name, index=False)
        jobs.start_landing(spark, paths, "2024-01-05", str(tmp_path / "state")).awaitTermination()

    land("a b.csv", SNAPSHOT_COLUMNS, 20)
    land("short.csv", [c for c in SNAPSHOT_COLUMNS if c != "contract_type"], 5)
    log = {r["file_name"]: (r["status"], r["n_rows"], r["batch_seq"]) for r in spark.read.parquet(paths.log).collect()}
    assert log == {"a b.csv": ("accepted", 20, 1), "short.csv": ("rejected", 5, 2)}
    assert spark.read.parquet(paths.processed).count() == 20 and spark.read.parquet(paths.quarantine).count() == 5


def test_late_readings_are_corrected_from_the_lake(spark):
    def frame(*rows):
        return spark.createDataFrame(rows, "event_ts string, vehicle_model string, engine_temp double").withColumn("event_ts", F.col("event_ts").cast("timestamp"))

    lake = frame(("2024-01-01 00:01:00", "a", 10.0), ("2024-01-01 00:02:00", "a", 30.0), ("2024-01-01 00:07:00", "a", 5.0))
    emitted = spark.createDataFrame([("2024-01-01 00:00:00", "a", 10.0, 1), ("2024-01-01 00:05:00", "a", 5.0, 1)],
                                    "w string, vehicle_model string, avg_engine_temp double, n_records long")
    emitted = emitted.select(F.col("w").cast("timestamp").alias("window_start"), "vehicle_model", "avg_engine_temp", "n_records")
    fixed = jobs.corrected_averages(emitted, lake, lake.filter("engine_temp = 30"))
    assert {str(r["window_start"])[14:16]: (r["avg_engine_temp"], r["n_records"]) for r in fixed.collect()} == {"00": (20.0, 2), "05": (5.0, 1)}


def test_stream_ingest_replay_changes_nothing(spark, tmp_path):
    rows = generate_customers(spark, 40).withColumns({
        "batch_seq": F.lit(1).cast("long"), "file_name": F.lit("f.csv"), "split_start": F.lit(0).cast("long"),
        "row_pos": F.col("tenure_months").cast("long")}).select(*STORED)
    path, table = str(tmp_path / "in"), str(tmp_path / "table")
    rows.write.parquet(path)
    for attempt in ("a", "b"):     # a fresh checkpoint replays every file
        jobs.start_ingest(spark.readStream.schema(rows.schema).parquet(path), table, str(tmp_path / attempt),
                          str(tmp_path / "q"), SNAPSHOT_COLUMNS).awaitTermination()
        stored = spark.read.parquet(table).select(*STORED)
        assert stored.count() == 40 and stored.exceptAll(rows).isEmpty()
