"""Streaming queries, drained once and compared with their batch meaning."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import views
from ..functions.cleaning import clean_customers
from ..plans.ingest import STORED
from ..schemas import SNAPSHOT_COLUMNS
from ..session import scratch_path
from ..streaming import jobs
from .catalog import query
from .decisions import SCORE_CHECK, score_check, training_run
from .fragments import CLEAN, CLEAN_COLUMNS, REQUEST_LOG
from .telemetry import ALERT_SQL, READINGS, alert_rows, rounded


_AVERAGES = READINGS + """
SELECT strftime(time_bucket(INTERVAL '5 minutes', event_ts), '%Y-%m-%d %H:%M:%S') AS window_start, vehicle_model,
 round(avg(engine_temp), 6) AS avg_engine_temp, count(*)::bigint AS n_records
FROM readings GROUP BY ALL"""


def averaged(stream, latest, purpose):
    """The windows of a reading stream, drained and then flushed."""
    root = scratch_path(stream.sparkSession, purpose)
    flush = jobs.Flush(stream)
    for last in (False, True):
        if last:
            flush.push("event_ts", latest, engine_temp=0.0)
        jobs.start_table(jobs.average_temperature(flush.stream), f"{root}/out", f"{root}/state").awaitTermination()
    return stream.sparkSession.read.parquet(f"{root}/out")


def window_rows(df):
    return rounded(df, "avg_engine_temp").withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd HH:mm:ss"))


def newest(spark, sf_dir):
    return views.read_table(spark, sf_dir, "events").agg(F.max("ts")).first()[0]


@query(_AVERAGES)
def stream_avg_temp_5min(spark, sf_dir):
    """Every window: the watermark closes most, a flush row the last ones."""
    stream = views.telemetry_from_events(views.stream_table(spark, sf_dir, "events"))
    return window_rows(averaged(stream, newest(spark, sf_dir), "stream-avg"))


@query(_AVERAGES)
def late_readings_corrected(spark, sf_dir):
    """Every 50th reading misses the stream; its windows are aggregated again from the lake."""
    late = F.col("event_id") % 50 == 0
    stream = views.telemetry_from_events(views.stream_table(spark, sf_dir, "events")).filter(~late)
    emitted = averaged(stream, newest(spark, sf_dir), "stream-late")
    lake = views.telemetry(spark, sf_dir)
    return window_rows(jobs.corrected_averages(emitted, lake, lake.filter(late)))


@query("""
SELECT event_type, count(*)::bigint AS n_events, round(sum(value), 4) AS sum_value FROM events GROUP BY event_type""")
def stream_dedup(spark, sf_dir):
    """Every third event is delivered twice; each counts once."""
    events = views.stream_table(spark, sf_dir, "events")
    twice = F.when(F.col("event_id") % 3 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    delivered = events.withColumn("delivery", F.explode(twice))
    once = jobs.deduplicated(delivered, ["event_id"], "ts").select("event_id", "event_type", "value")
    out = jobs.run_to_table(once, "stream-dedup").groupBy("event_type").agg(
        F.count("*").alias("n_events"), F.sum("value").alias("sum_value")
    )
    return rounded(out, "sum_value", digits=4)


@query(f"WITH {CLEAN} SELECT " + CLEAN_COLUMNS.replace(
    "monthly_charges", "CASE WHEN k % 20 = 0 THEN monthly_charges + 1.0::double ELSE monthly_charges END AS monthly_charges"
) + ", cast(date '2024-01-01' + (k % 10)::int AS string) AS snapshot_date FROM clean WHERE k % 10 <> 3")
def stream_ingest(spark, sf_dir):
    """Micro-batch ingest: one file is rejected, every 20th customer comes again with a new charge."""
    raw = views.raw_customers_from_table(views.stream_table(spark, sf_dir, "customer"), ["k"])
    day = "date_add(date '2024-01-01', cast(k % 10 AS int))"
    rows = clean_customers(raw, snapshot_date=day, keep=["k"])
    times = F.when(F.col("k") % 20 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    rows = rows.withColumn("batch_seq", F.explode(times)).withColumns({
        "batch_seq": F.col("batch_seq").cast("long"),
        "monthly_charges": F.col("monthly_charges") + (F.col("batch_seq") - 1),
        # The file of day 4 has no payment method at all.
        "payment_method": F.when(F.col("k") % 10 != 3, F.col("payment_method")),
        "file_name": F.format_string("customers_%s_%s.csv", F.col("snapshot_date").cast("string"), F.col("batch_seq").cast("string")),
        "split_start": F.lit(0).cast("long"),
        "row_pos": F.col("k"),
    }).select(*STORED)
    root = scratch_path(spark, "stream-ingest")
    jobs.start_ingest(rows, f"{root}/table", f"{root}/state", f"{root}/quarantine", SNAPSHOT_COLUMNS).awaitTermination()
    out = spark.read.parquet(f"{root}/table").select(*SNAPSHOT_COLUMNS)
    return out.withColumn("snapshot_date", F.col("snapshot_date").cast("string"))


@query(SCORE_CHECK)
def stream_score(spark, sf_dir):
    run = training_run(spark, sf_dir)
    raw = views.raw_customers_from_table(views.stream_table(spark, sf_dir, "customer"))
    root = scratch_path(spark, "stream-score")
    paths = [f"{root}/{name}" for name in ("scores", "rejects", "state")]
    jobs.start_scores(clean_customers(raw), *paths, run.models[run.promoted], run.version, run.promoted, ["customer_id"]).awaitTermination()
    return score_check(*[spark.read.parquet(p) for p in paths[:2]])


@query(f"WITH {REQUEST_LOG}" + ALERT_SQL.format(where=""))
def stream_alerts(spark, sf_dir):
    """The same rows as the batch form, the windows still open at the end included."""
    flush = jobs.Flush(views.request_log_from_events(views.stream_table(spark, sf_dir, "events")))
    root = scratch_path(spark, "stream-alerts")
    for last in (False, True):
        if last:
            flush.push("started_at", newest(spark, sf_dir), latency_ms=0.0, is_error=False)
        jobs.start_alerts(flush.stream, f"{root}/table", f"{root}/state", views.request_log(spark, sf_dir)).awaitTermination()
    return alert_rows(spark.read.parquet(f"{root}/table"))
