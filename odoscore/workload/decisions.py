"""Queries on metrics, monitoring, decisions, training and scoring."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import JobConfig
from ..operators import metrics as m
from ..operators.lineage import cut_lineage
from ..operators.stats import feature_stats
from ..plans.alerts import positive_rate_alerts
from ..plans.monitor import dq_issues as quality_issues
from ..plans.monitor import drift_warnings as drift_rows
from ..plans.monitor import monitor_report as report
from ..plans.monitor import with_quarantine
from ..plans.promotion import promotion_decision as promote
from ..plans.retrain import gather_signals
from ..plans.retrain import retrain_decisions as decide
from ..plans.score import score_or_reject
from ..plans.train import TrainingRun, train_and_evaluate
from ..schemas import DQ_RANGES, FEATURES, PAYLOAD_COLUMNS
from ..sources.tables import latest_entry, version_stamp
from ..views import read_table
from .catalog import query
from .customers import clean, split, staged
from .fragments import CLEAN, FEATURE_SQL, FEATURE_ROWS, SPLIT, STAGED, auc_sql
from .telemetry import rounded

# --- classification metrics over a score column with ties -------------------
SCORE = "least(1.0D, 0.3D * churn + cast((k * 7919) % 700 AS double) / 1000)"
RIVAL = "least(1.0D, 0.28D * churn + cast((k * 6151) % 700 AS double) / 1000)"
_SCORED = CLEAN + f""",
scored AS (SELECT customer_id, k, nation, churn AS label, {SCORE.replace('D ', '::double ').replace('D,', '::double,')} AS score,
 {RIVAL.replace('D ', '::double ').replace('D,', '::double,')} AS rival FROM clean)"""


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = clean(spark, sf_dir, ["k", "nation"])
    return rows.select(
        "customer_id", "k", "nation", F.col("churn").alias("label"), F.expr(SCORE).alias("score"), F.expr(RIVAL).alias("rival")
    )


@query(f"WITH {_SCORED} {auc_sql('scored', [])}")
def classification_metrics(spark, sf_dir):
    return m.classification_metrics(scored(spark, sf_dir))


@query(f"WITH {_SCORED} {auc_sql('scored', ['nation'])}")
def classification_metrics_by_nation(spark, sf_dir):
    return m.classification_metrics(scored(spark, sf_dir), by=["nation"])


@query(f"WITH {_SCORED}, best AS (SELECT label FROM scored ORDER BY score DESC, customer_id LIMIT 100)" + """
SELECT count(*)::bigint AS n_selected, sum(label)::bigint AS n_hits, round_even(avg(label::double), 4) AS precision_at_k FROM best""")
def precision_at_k(spark, sf_dir):
    return m.precision_at_k(scored(spark, sf_dir), 100, "customer_id")


_MODEL_METRICS = _SCORED + f""",
base_m AS ({auc_sql('scored', ['nation'])}),
cand_m AS ({auc_sql('scored', ['nation'], score='rival')})"""


@query(f"WITH {_MODEL_METRICS}" + """
SELECT nation, b.roc_auc AS baseline_val_auc, c.roc_auc AS candidate_val_auc,
 coalesce(c.roc_auc >= 0.80, false) AS meets_min_auc,
 coalesce(round(b.roc_auc - c.roc_auc, 10) <= 0.01, false) AS not_much_worse,
 CASE WHEN coalesce(c.roc_auc >= 0.80 AND round(b.roc_auc - c.roc_auc, 10) <= 0.01, false) THEN 'candidate' ELSE 'baseline' END
  AS promoted_model
FROM base_m b JOIN cand_m c USING (nation)""")
def promotion_decision(spark, sf_dir):
    """Two scores per nation as the two models' validation results."""
    rows = scored(spark, sf_dir)
    both = rows.select("nation", "label", F.explode(F.array(
        F.struct(F.lit("baseline").alias("model"), F.col("score")),
        F.struct(F.lit("candidate").alias("model"), F.col("rival").alias("score")),
    )).alias("s")).select("nation", "label", "s.*")
    table = m.long_metrics(m.classification_metrics(both, by=["nation", "model"]), ["nation", "model"])
    return promote(table.withColumn("split", F.lit("validation")), by=["nation"])


# --- data quality and drift -------------------------------------------------
# Day 4 arrives in cents, day 6 has NULL tenures, day 8 a few absurd ones.
BATCH = {
    "monthly_charges": "CASE WHEN day(snapshot_date) = 4 THEN monthly_charges * 100 ELSE monthly_charges END",
    "total_charges": "CASE WHEN day(snapshot_date) = 4 THEN total_charges * 100 ELSE total_charges END",
    "internet_service": "CASE WHEN day(snapshot_date) = 6 AND k % 8 = 0 THEN NULL ELSE internet_service END",
    "tenure_months": "CASE WHEN day(snapshot_date) = 8 AND k % 40 = 0 THEN 601 ELSE tenure_months END",
}
_BATCHES = STAGED + ",\nbatches AS (SELECT * REPLACE (" + ", ".join(
    f"{sql} AS {name}" for name, sql in BATCH.items()
) + "), cast(snapshot_date AS string) AS batch FROM staged)"


def batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = staged(spark, sf_dir, ["k"])
    spoilt = rows.withColumns({n: F.expr(sql) for n, sql in BATCH.items()}).withColumn(
        "batch", F.col("snapshot_date").cast("string")
    )
    # Read several times by each query, so derived once.
    return cut_lineage(spoilt, "table")


def reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cut_lineage(feature_stats(split(spark, sf_dir).filter("split = 'train'"), "v1"), "table")


def _pct(sql: str) -> str:
    return f"concat(cast(cast(round_even(({sql}) * 100, 1) AS decimal(38,1)) AS string), '%')"


_RANGE_SQL = {
    name: f"avg(CASE WHEN {name} < {low} OR {name} > {high} THEN 1.0::double ELSE 0.0::double END)"
    for name, (low, high) in DQ_RANGES.items()
}
_DQ_ROWS = " UNION ALL ".join(
    [f"SELECT batch, {i} AS pos, 'null_rate' AS \"check\", '{c}' AS \"column\", avg(({c} IS NULL)::int::double) AS rate, "
     f"0.05::double AS threshold, concat('HIGH NULL RATE: {c} = ', {_pct(f'avg(({c} IS NULL)::int::double)')}) AS message "
     f"FROM batches GROUP BY batch HAVING round(avg(({c} IS NULL)::int::double), 10) > 0.05"
     for i, c in enumerate(PAYLOAD_COLUMNS)]
    + [f"SELECT batch, {100 + i} AS pos, 'out_of_range', '{c}', {sql}, 0.0::double, "
       f"concat('OUT-OF-RANGE {c}: ', {_pct(sql)}, ' of rows') FROM batches GROUP BY batch HAVING {sql} > 0"
       for i, (c, sql) in enumerate(_RANGE_SQL.items())]
)
# The reference comes from the untouched split, the batches from the spoilt rows.
_DRIFT = f"""
batch_features AS (SELECT batch, {FEATURE_SQL} FROM batches),
drift_all AS (
 {' UNION ALL '.join(
    f"SELECT r.batch, {i} AS pos, '{f}' AS feature, ref_mean, recent_mean FROM "
    f"(SELECT batch, avg({f}::double) AS recent_mean FROM batch_features GROUP BY batch) r, "
    f"(SELECT avg({f}::double) AS ref_mean FROM split_rows WHERE split = 'train') t"
    for i, f in enumerate(FEATURES))}),
drift AS (
 SELECT *, abs(recent_mean - ref_mean) / abs(ref_mean) AS rel_shift,
  concat('DRIFT in ''', feature, ''': train_mean=', cast(cast(round_even(ref_mean, 3) AS decimal(38,3)) AS string),
   ' recent_mean=', cast(cast(round_even(recent_mean, 3) AS decimal(38,3)) AS string), ' (relative shift=',
   {_pct('abs(recent_mean - ref_mean) / abs(ref_mean)')}, ', threshold=20%)') AS message
 FROM drift_all WHERE ref_mean <> 0 AND round(abs(recent_mean - ref_mean) / abs(ref_mean), 10) > 0.20)"""
_TAIL = SPLIT.split("feature_rows AS", 1)[1]
_MONITOR = _BATCHES + ",\nfeature_rows AS" + _TAIL + ",\ndq AS (" + _DQ_ROWS + ")," + _DRIFT + """,
report AS (
 SELECT b.batch, b.n AS n_rows_checked,
  coalesce((SELECT string_agg(message, '; ' ORDER BY pos) FROM dq WHERE dq.batch = b.batch), '') AS data_quality_issues,
  coalesce((SELECT string_agg(message, '; ' ORDER BY pos) FROM drift WHERE drift.batch = b.batch), '') AS drift_warnings
 FROM (SELECT batch, count(*)::bigint AS n FROM batches GROUP BY batch) b)"""


@query(f"WITH {_BATCHES}, dq AS ({_DQ_ROWS})" + """
SELECT batch, "check", "column", round(rate, 6) AS rate, threshold, message FROM dq""")
def dq_issues(spark, sf_dir):
    return rounded(quality_issues(batches(spark, sf_dir), ["batch"]), "rate")


@query(f"WITH {_MONITOR}" + """
SELECT batch, feature, round(ref_mean, 6) AS ref_mean, round(recent_mean, 6) AS recent_mean, round(rel_shift, 6) AS rel_shift, message
FROM drift""")
def drift_warnings(spark, sf_dir):
    rows = drift_rows(batches(spark, sf_dir), reference(spark, sf_dir), ["batch"])
    return rounded(rows, "ref_mean", "recent_mean", "rel_shift")


@query(f"WITH {_MONITOR}" + """
SELECT batch, n_rows_checked, data_quality_issues, drift_warnings,
 data_quality_issues <> '' OR drift_warnings <> '' AS any_issue_detected FROM report""")
def monitor_report(spark, sf_dir):
    out = report(batches(spark, sf_dir), reference(spark, sf_dir), ["batch"])
    return out.withColumns({
        c: F.array_join(c, "; ") for c in ("data_quality_issues", "drift_warnings")
    })


@query(f"WITH {_MONITOR}" + """
SELECT b.batch, CASE WHEN data_quality_issues <> '' OR drift_warnings <> '' THEN 'quarantine' ELSE 'accepted' END AS status,
 count(*)::bigint AS n_rows, round(sum(monthly_charges), 2) AS sum_charges
FROM batches b JOIN report r USING (batch) GROUP BY ALL""")
def quarantine_split(spark, sf_dir):
    marked = with_quarantine(batches(spark, sf_dir), reference(spark, sf_dir), ["batch"])
    status = F.when(F.col("quarantined"), "quarantine").otherwise("accepted").alias("status")
    out = marked.groupBy("batch", status).agg(F.count("*").alias("n_rows"), F.sum("monthly_charges").alias("sum_charges"))
    return rounded(out, "sum_charges", digits=2)


# --- retraining --------------------------------------------------------------
SIGNALS = {
    "vehicle_id": "concat('EV-', cast(user_id AS string))",
    "current_model_promotion_auc": "cast(80 + user_id % 10 AS double) / 100",
    "recent_labeled_auc": "CASE WHEN user_id % 7 = 0 THEN NULL ELSE cast(76 + user_id % 13 AS double) / 100 END",
    "drift_detected": "user_id % 11 = 0",
}
_DEC3 = "cast(cast(round_even({0}, 3) AS decimal(38,3)) AS string)"
_REASONS = f"""concat_ws('; ',
  CASE WHEN days_since_last_training >= 14
   THEN concat('staleness: ', days_since_last_training::string, ' days since last training (threshold=14)') END,
  CASE WHEN round(current_model_promotion_auc - recent_labeled_auc, 10) >= 0.03
   THEN concat('performance drop: AUC fell from ', {_DEC3.format('current_model_promotion_auc')}, ' to ',
    {_DEC3.format('recent_labeled_auc')}, ' (drop=', {_DEC3.format('(current_model_promotion_auc - recent_labeled_auc)')},
    ', threshold=0.03)') END,
  CASE WHEN drift_detected THEN 'feature drift detected by the monitoring job' END)"""


@query(f"""
WITH signals AS (
 SELECT user_id, {', '.join(f'{sql} AS {name}' for name, sql in SIGNALS.items())},
  date_diff('day', last_day, date '2024-02-11')::int AS days_since_last_training
 FROM (SELECT user_id, max(CASE WHEN event_type = 'signup' THEN ts::date END) AS last_day FROM events GROUP BY user_id))
SELECT vehicle_id, days_since_last_training, {_REASONS} AS reasons, {_REASONS} <> '' AS should_retrain FROM signals""")
def retrain_decisions(spark, sf_dir):
    """One decision per vehicle; the last signup event stands for the last training day."""
    last = read_table(spark, sf_dir, "events").groupBy("user_id").agg(
        F.max(F.when(F.col("event_type") == "signup", F.col("ts").cast("date"))).alias("last_day")
    )
    signals = last.select(
        *[F.expr(sql).alias(name) for name, sql in SIGNALS.items()],
        F.datediff(F.lit("2024-02-11").cast("date"), "last_day").alias("days_since_last_training"),
    )
    return decide(signals).select(
        "vehicle_id", "days_since_last_training", F.array_join("reasons", "; ").alias("reasons"), "should_retrain"
    )


@query(f"WITH {_SCORED}" + f""",
dated AS (SELECT *, k % 10 AS d FROM scored),
history AS ({auc_sql('dated', ['nation', 'd'])}),
newest AS (SELECT nation, d, roc_auc FROM history QUALIFY row_number() OVER (PARTITION BY nation ORDER BY d DESC) = 1),
late AS (SELECT nation, label, rival FROM dated WHERE d >= 5),
feedback AS ({auc_sql('late', ['nation'], score='rival')}),
drift AS (SELECT nation, avg(label) > 0.18 AS drifted FROM dated WHERE d = (SELECT max(d) FROM dated x WHERE x.nation = dated.nation)
 GROUP BY nation)
SELECT n.nation, date_diff('day', date '2024-01-01' + n.d::int, date '2024-01-23')::int AS days_since_last_training,
 n.roc_auc AS current_model_promotion_auc, f.roc_auc AS recent_labeled_auc, coalesce(x.drifted, false) AS drift_detected
FROM newest n LEFT JOIN feedback f USING (nation) LEFT JOIN drift x USING (nation)""")
def retrain_signals(spark, sf_dir):
    """Signals per nation from a registry, labelled feedback and reports built out of dated scores."""
    dated = scored(spark, sf_dir).withColumn("d", F.col("k") % 10)
    day = F.date_add(F.lit("2024-01-01").cast("date"), F.col("d").cast("int"))
    registry = m.classification_metrics(dated, by=["nation", "d"]).select(
        "nation", day.alias("trained_at"), F.col("roc_auc").alias("promoted_auc")
    )
    feedback = dated.filter("d >= 5").select("nation", "label", F.col("rival").alias("score"))
    reports = dated.groupBy("nation", "d").agg(F.avg("label").alias("rate")).select(
        "nation", day.alias("checked_at"),
        F.array_compact(F.array(F.when(F.col("rate") > 0.18, "positive rate"))).alias("drift_warnings"),
    )
    return gather_signals(registry, feedback, reports, "2024-01-23", ["nation"])


@query(f"WITH {STAGED}" + """,
runs AS (SELECT snapshot_date::timestamp + to_seconds(count(*)) AS trained_at, round_even(avg(churn::double), 4) AS positive_rate,
  count(*)::bigint AS n_rows FROM staged GROUP BY snapshot_date)
SELECT strftime(trained_at, 'v%Y%m%d_%H%M%S') AS version, positive_rate, n_rows FROM runs ORDER BY trained_at DESC LIMIT 1""")
def registry_latest(spark, sf_dir):
    """Newest of one registry row per snapshot date."""
    runs = staged(spark, sf_dir).groupBy("snapshot_date").agg(
        F.bround(F.avg("churn"), 4).alias("positive_rate"), F.count("*").alias("n_rows")
    )
    trained_at = F.timestamp_seconds(F.unix_date("snapshot_date") * F.lit(86400).cast("long") + F.col("n_rows"))
    rows = runs.select(trained_at.alias("trained_at"), "positive_rate", "n_rows").withColumn(
        "version", version_stamp("trained_at")
    )
    return latest_entry(rows, "trained_at").select("version", "positive_rate", "n_rows")


@query(f"WITH {_SCORED}" + """,
predictions AS (SELECT timestamp '2024-01-01' + to_days((k % 10)::int) AS moment,
  CASE WHEN score >= 0.5 AND (k % 10 <> 4 OR k % 3 = 0) OR k % 10 = 7 THEN 1 ELSE 0 END AS pred FROM scored),
ref AS (SELECT avg(pred::double) AS rate FROM predictions)
SELECT strftime(moment, '%Y-%m-%d') AS day, count(*)::bigint AS n_scored, round(avg(pred::double), 6) AS positive_rate,
 avg(pred::double) > 2 * (SELECT rate FROM ref) OR 2 * avg(pred::double) < (SELECT rate FROM ref) AS rate_alert
FROM predictions GROUP BY moment""")
def positive_rate_alerts_daily(spark, sf_dir):
    rows = scored(spark, sf_dir)
    day = F.col("k") % 10
    usual = (F.col("score") >= 0.5) & ((day != 4) | (F.col("k") % 3 == 0))
    predictions = rows.select(
        F.date_add(F.lit("2024-01-01").cast("date"), day.cast("int")).cast("timestamp").alias("at"),
        (usual | (day == 7)).cast("int").alias("churn_prediction"),
    )
    reference_rate = predictions.agg(F.avg("churn_prediction"))
    out = positive_rate_alerts(predictions, reference_rate, "at")
    return out.select(
        F.date_format("window_start", "yyyy-MM-dd").alias("day"), "n_scored",
        F.round("positive_rate", 6).alias("positive_rate"), "rate_alert",
    )


# --- training and scoring ------------------------------------------------------
_RUNS: dict[tuple[str, str], TrainingRun] = {}


def training_run(spark: SparkSession, sf_dir: str) -> TrainingRun:
    """The published settings.  Three queries ask for the same models; a session fits them once per table."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _RUNS:
        _RUNS[key] = train_and_evaluate(spark, clean(spark, sf_dir, dealt=True), "v20240201_000000", "2024-02-01 00:00:00", JobConfig())
    return _RUNS[key]


@query(f"WITH {SPLIT}" + """,
held AS (SELECT split, count(*)::bigint AS n_samples, round_even(avg(churn::double), 4) AS positive_rate FROM split_rows WHERE split <> 'train' GROUP BY split)
SELECT model, split, n_samples, positive_rate, true AS auc_near_rule, true AS accuracy_near_majority FROM held, (VALUES ('baseline'), ('candidate')) m(model)""")
def train_eval_metrics(spark, sf_dir):
    """One row per model and held-out split.  Scores are the models' own, so they are checked by bands.

    About half of the positive labels follow the feature ``is_new_high_risk``, the others no feature at all, so no model
    can do better than that feature alone does on the same rows.  The AUC must lie within three standard errors of the
    feature's (at least 0.03), and the accuracy at most two below that of the larger class.
    """
    value = lambda name: F.max(F.when(F.col("metric") == name, F.col("value")))
    names = ("n_samples", "positive_rate", "roc_auc", "accuracy")
    wide = training_run(spark, sf_dir).metrics.groupBy("model", "split").agg(*[value(n).alias(n) for n in names])
    held = split(spark, sf_dir, dealt=True).filter("split <> 'train'")
    rule = m.classification_metrics(held, "churn", "is_new_high_risk", ["split"]).select("split", F.col("roc_auc").alias("rule_auc"))
    n, p = F.col("n_samples"), F.col("positive_rate")
    auc_error = F.sqrt((n + 1) / (12 * n * p * n * (1 - p)))
    majority = F.greatest(p, 1 - p)
    near = F.abs(F.col("roc_auc") - F.col("rule_auc")) <= F.greatest(F.lit(0.03), 3 * auc_error)
    return wide.join(rule, "split").select(
        "model", "split", n.cast("long").alias("n_samples"), "positive_rate", near.alias("auc_near_rule"),
        (F.col("accuracy") >= majority - 2 * F.sqrt(majority * (1 - majority) / n)).alias("accuracy_near_majority"),
    )


SCORE_CHECK = f"WITH {CLEAN}" + """,
checked AS (SELECT customer_id, concat_ws(',',
 CASE WHEN coalesce(tenure_months BETWEEN 0 AND 200, false) THEN NULL ELSE 'tenure_months' END,
 CASE WHEN contract_type IS NULL THEN 'contract_type' END,
 CASE WHEN payment_method IS NULL THEN 'payment_method' END,
 CASE WHEN internet_service IS NULL THEN 'internet_service' END,
 CASE WHEN coalesce(monthly_charges >= 0, false) THEN NULL ELSE 'monthly_charges' END,
 CASE WHEN coalesce(total_charges >= 0, false) THEN NULL ELSE 'total_charges' END) AS violations FROM clean)
SELECT customer_id, CASE WHEN violations = '' THEN 'scored' ELSE 'rejected' END AS status, violations,
 CASE WHEN violations = '' THEN true END AS consistent, 'v20240201_000000' AS model_version FROM checked"""


def score_check(scores: DataFrame, rejects: DataFrame) -> DataFrame:
    """Accepted and rejected rows together; a score is consistent if its label follows the probability."""
    p = F.col("churn_probability")
    label = F.col("churn_prediction")
    sound = p.between(0, 1) & (((p > 0.5) & (label == 1)) | ((p < 0.5) & (label == 0)) | (p == 0.5))
    return scores.select(
        "customer_id", F.lit("scored").alias("status"), F.lit("").alias("violations"), sound.alias("consistent"), "model_version"
    ).unionByName(rejects.select(
        "customer_id", F.lit("rejected").alias("status"), F.array_join("violations", ",").alias("violations"),
        F.lit(None).cast("boolean").alias("consistent"), "model_version",
    ))


@query(SCORE_CHECK)
def batch_scores(spark, sf_dir):
    """Every customer is scored or kept with what it violates."""
    run = training_run(spark, sf_dir)
    return score_check(*score_or_reject(clean(spark, sf_dir), run.models[run.promoted], run.version, run.promoted, ["customer_id"]))
