"""Telemetry queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import views
from ..functions.telemetry import cycle_step, with_temperature
from ..operators import aggregate, lineage, metrics, reconcile, skew
from ..plans.alerts import latency_alerts
from ..session import scratch_path
from ..sources.tables import write_lake
from ..sources.telemetry import read_lake
from .catalog import query
from .fragments import REQUEST_LOG, TELEMETRY

READINGS = f"WITH {TELEMETRY}, readings AS (SELECT * FROM telemetry WHERE engine_temp IS NOT NULL)"
SALT_ON = ["event_id"]
TEMP = {"avg_engine_temp": ("avg", "engine_temp"), "n_records": ("count", "engine_temp")}


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_temperature(views.telemetry(spark, sf_dir))


def rounded(df: DataFrame, *names: str, digits: int = 6) -> DataFrame:
    """Float results differ in the last bits with the order of addition."""
    return df.withColumns({n: F.round(n, digits) for n in names})


@query(READINGS + """
SELECT vehicle_model, round(avg(engine_temp), 6) AS avg_engine_temp, count(*)::bigint AS n_records
FROM readings GROUP BY vehicle_model""")
def avg_temp_by_model(spark, sf_dir):
    return rounded(aggregate.average_by_key(readings(spark, sf_dir)), "avg_engine_temp")


@query(f"WITH {TELEMETRY}" + """
SELECT vehicle_model, count(*)::bigint AS record_count,
 round(count(*) * 100.0::double / sum(count(*)) OVER ()::double, 2) AS pct_of_total
FROM telemetry GROUP BY vehicle_model""")
def model_counts_pct(spark, sf_dir):
    return aggregate.with_share(aggregate.counts_by_key(views.telemetry(spark, sf_dir)))


@query(READINGS + """
SELECT count(*)::bigint AS n_keys, max(n)::bigint AS max_count, min(n)::bigint AS min_count,
 round(max(n)::double / min(n), 6) AS skew_ratio
FROM (SELECT count(*) AS n FROM readings GROUP BY vehicle_model)""")
def skew_ratio(spark, sf_dir):
    return rounded(aggregate.skew_ratio(readings(spark, sf_dir)), "skew_ratio")


@query(READINGS + """
SELECT vehicle_model, count(*)::bigint AS record_count FROM readings
GROUP BY vehicle_model ORDER BY record_count DESC, vehicle_model LIMIT 1""")
def hot_model_top1(spark, sf_dir):
    return aggregate.top_keys(readings(spark, sf_dir))


@query(f"WITH {TELEMETRY}" + """
SELECT event_id, vehicle_id, vehicle_model, engine_temp, speed, latitude, longitude, battery_efficiency, miles
FROM telemetry ORDER BY event_id LIMIT 5""")
def first_readings(spark, sf_dir):
    return aggregate.preview(views.telemetry(spark, sf_dir).drop("event_ts"), ["event_id"])


@query(READINGS + """
SELECT vehicle_model, round(avg(engine_temp), 6) AS avg_engine_temp, count(engine_temp)::bigint AS n_records
FROM readings GROUP BY vehicle_model""")
def salted_avg_temp(spark, sf_dir):
    return rounded(
        skew.salted_aggregate(readings(spark, sf_dir), ["vehicle_model"], TEMP, SALT_ON), "avg_engine_temp"
    )


@query(f"WITH {TELEMETRY}" + """
SELECT vehicle_model, round(sum(miles), 4) AS sum_miles, min(engine_temp) AS min_temp, max(engine_temp) AS max_temp,
 count(*)::bigint AS n_rows, count(engine_temp)::bigint AS n_temps
FROM telemetry GROUP BY vehicle_model""")
def salted_totals(spark, sf_dir):
    aggs = {
        "sum_miles": ("sum", "miles"), "min_temp": ("min", "engine_temp"), "max_temp": ("max", "engine_temp"),
        "n_rows": ("count", "*"), "n_temps": ("count", "engine_temp"),
    }
    df = skew.salted_aggregate(views.telemetry(spark, sf_dir), ["vehicle_model"], aggs, SALT_ON)
    return rounded(df, "sum_miles", digits=4)


@query(READINGS + """
SELECT count(DISTINCT vehicle_model)::bigint AS n_keys, 0::bigint AS n_unmatched, true AS matches FROM readings""")
def salted_vs_direct_max_diff(spark, sf_dir):
    df = readings(spark, sf_dir)
    salted = skew.salted_aggregate(df, ["vehicle_model"], TEMP, SALT_ON)
    verdict = reconcile.reconcile(
        salted, aggregate.average_by_key(df), ["vehicle_model"], "avg_engine_temp", "avg_engine_temp"
    )
    # The difference itself is float noise, so the verdict is compared.
    return verdict.select("n_keys", "n_unmatched", "matches")


@query(READINGS + """
SELECT vehicle_model, count(DISTINCT vehicle_id)::bigint AS n_vehicles FROM readings GROUP BY vehicle_model""")
def salted_distinct_vehicles(spark, sf_dir):
    return skew.salted_distinct(readings(spark, sf_dir), ["vehicle_model"], "vehicle_id", "n_vehicles")


@query(READINGS + """, means AS (SELECT vehicle_model, avg(engine_temp) AS mean_temp FROM readings GROUP BY vehicle_model)
SELECT vehicle_model, count(*)::bigint AS n_records, round(sum(miles), 4) AS sum_miles,
 sum(CASE WHEN engine_temp > mean_temp + 1 THEN 1 ELSE 0 END)::bigint AS n_above_mean
FROM readings JOIN means USING (vehicle_model) GROUP BY vehicle_model""")
def salted_join_totals(spark, sf_dir):
    df = readings(spark, sf_dir)
    means = df.groupBy("vehicle_model").agg(F.avg("engine_temp").alias("mean_temp"))
    joined = skew.salted_join(
        df.select("event_id", "vehicle_model", "engine_temp", "miles"), means, ["vehicle_model"], SALT_ON, min_rows=1
    )
    out = joined.groupBy("vehicle_model").agg(
        F.count("*").alias("n_records"),
        F.sum("miles").alias("sum_miles"),
        F.count_if(F.col("engine_temp") > F.col("mean_temp") + 1).alias("n_above_mean"),
    )
    return rounded(out, "sum_miles", digits=4)


_AMPLIFIED = READINGS + """,
hot AS (SELECT vehicle_model FROM readings GROUP BY vehicle_model ORDER BY count(*) DESC, vehicle_model LIMIT 1)"""


@query(_AMPLIFIED + """
SELECT vehicle_model, (count(*) * CASE WHEN vehicle_model IN (SELECT vehicle_model FROM hot) THEN 181 ELSE 1 END)::bigint
 AS record_count
FROM readings GROUP BY vehicle_model""")
def amplified_skew_counts(spark, sf_dir):
    hot = skew.amplify_top_key(readings(spark, sf_dir), "vehicle_model", 180)
    return aggregate.counts_by_key(hot)


@query(_AMPLIFIED + """
SELECT vehicle_model, round(avg(engine_temp), 6) AS avg_engine_temp,
 (count(*) * CASE WHEN vehicle_model IN (SELECT vehicle_model FROM hot) THEN 181 ELSE 1 END)::bigint AS n_records
FROM readings GROUP BY vehicle_model""")
def amplified_salted_avg(spark, sf_dir):
    hot = skew.amplify_top_key(readings(spark, sf_dir), "vehicle_model", 180)
    return rounded(
        skew.salted_aggregate(hot, ["vehicle_model"], TEMP, ["event_id", "copy_no"]), "avg_engine_temp"
    )


@query(READINGS + """,
parts AS (SELECT vehicle_model, ('0x' || substr(md5(event_id::varchar), 1, 8))::bigint % 8 AS salt, count(*)::bigint AS n FROM readings GROUP BY ALL)
SELECT vehicle_model, sum(n)::bigint AS n_rows, count(*)::bigint AS n_salts, max(n) AS largest_part, min(n) AS smallest_part
FROM parts GROUP BY vehicle_model""")
def salted_key_balance(spark, sf_dir):
    return skew.key_balance(readings(spark, sf_dir), "vehicle_model", SALT_ON, 8)


@query(f"WITH {TELEMETRY}" + """
SELECT vehicle_model, round(sum(miles), 4) AS sum_miles, count(*)::bigint AS n_records FROM telemetry GROUP BY vehicle_model""")
def total_miles_by_model(spark, sf_dir):
    return rounded(aggregate.total_by_key(views.telemetry(spark, sf_dir)), "sum_miles", digits=4)


@query(f"WITH {TELEMETRY}" + """
SELECT vehicle_model, round(sum(span), 4) AS distance_driven, count(*)::bigint AS n_vehicles
FROM (SELECT vehicle_model, vehicle_id, max(miles) - min(miles) AS span FROM telemetry GROUP BY ALL)
GROUP BY vehicle_model""")
def distance_driven_by_model(spark, sf_dir):
    return rounded(aggregate.distance_by_key(views.telemetry(spark, sf_dir)), "distance_driven", digits=4)


@query(f"WITH {TELEMETRY}" + """
SELECT count(*)::bigint AS rows_total, count(engine_temp)::bigint AS rows_kept,
 (count(*) - count(engine_temp))::bigint AS rows_removed,
 count(DISTINCT CASE WHEN engine_temp IS NOT NULL THEN vehicle_model END)::bigint AS n_groups
FROM telemetry""")
def row_counts_profile(spark, sf_dir):
    return aggregate.profile(views.telemetry(spark, sf_dir))


def _iterated_sql() -> str:
    ctes, last = [], "readings"
    steps = {
        0: "SELECT event_id, vehicle_model, engine_temp + 0.01::double AS engine_temp FROM {src}",
        1: "SELECT event_id, vehicle_model, CASE WHEN engine_temp > 100::double THEN engine_temp "
           "ELSE engine_temp * 1.001::double END AS engine_temp FROM {src}",
        2: "SELECT event_id, vehicle_model, engine_temp FROM {src} WHERE engine_temp > 0",
    }
    for i in range(1, 16):
        ctes.append(f"step_{i} AS ({steps[i % 3].format(src=last)})")
        last = f"step_{i}"
    return READINGS + ", " + ", ".join(ctes) + f" SELECT event_id, vehicle_model, round(engine_temp, 9) AS engine_temp FROM {last}"


@query(_iterated_sql())
def iterative_15_steps(spark, sf_dir):
    start = readings(spark, sf_dir).select("event_id", "vehicle_model", "engine_temp")
    return rounded(lineage.iterate(start, cycle_step, 15, 5), "engine_temp", digits=9)


@query(READINGS + """
SELECT cast(cast(event_ts AS date) AS string) AS event_date, count(*)::bigint AS n_records, round(avg(engine_temp), 6) AS avg_engine_temp
FROM readings WHERE cast(event_ts AS date) BETWEEN date '2024-01-08' AND date '2024-01-14' GROUP BY 1""")
def lake_week_summary(spark, sf_dir):
    """Write the lake by event date, then read one week of it."""
    path = scratch_path(spark, "lake")
    write_lake(views.telemetry(spark, sf_dir), path)
    week = with_temperature(read_lake(spark, path, "2024-01-08", "2024-01-14"))
    out = week.groupBy(F.col("event_date").cast("string").alias("event_date")).agg(
        F.count("*").alias("n_records"), F.avg("engine_temp").alias("avg_engine_temp")
    )
    return rounded(out, "avg_engine_temp")


@query(f"WITH {REQUEST_LOG}" + """,
w AS (SELECT (max(epoch_us(started_at) + round(latency_ms * 1000)::bigint) - min(epoch_us(started_at))) / 1e6::double AS wall FROM request_log)
SELECT count(*)::bigint AS n_requests, sum(is_error::int)::bigint AS errors,
 round_even((SELECT wall FROM w), 3) AS total_wall_seconds,
 round_even(count(*) / (SELECT wall FROM w), 2) AS throughput_req_per_sec,
 round_even(avg(latency_ms) FILTER (NOT is_error), 2) AS avg_latency_ms,
 round_even(quantile_cont(latency_ms, 0.50) FILTER (NOT is_error), 2) AS p50_latency_ms,
 round_even(quantile_cont(latency_ms, 0.95) FILTER (NOT is_error), 2) AS p95_latency_ms,
 round_even(quantile_cont(latency_ms, 0.99) FILTER (NOT is_error), 2) AS p99_latency_ms
FROM request_log""")
def request_latency_summary(spark, sf_dir):
    return metrics.request_latency_summary(views.request_log(spark, sf_dir))


def alert_rows(df: DataFrame) -> DataFrame:
    return df.select(
        F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"),
        "n_requests", "errors", F.round("error_rate", 6).alias("error_rate"),
        F.round("p95_latency_ms", 4).alias("p95_latency_ms"), "latency_alert", "error_alert",
    )


ALERT_SQL = """
SELECT strftime(time_bucket(INTERVAL '5 minutes', started_at), '%Y-%m-%d %H:%M:%S') AS window_start,
 count(*)::bigint AS n_requests, sum(is_error::int)::bigint AS errors,
 round(sum(is_error::int)::double / count(*), 6) AS error_rate,
 round(quantile_cont(latency_ms, 0.95) FILTER (NOT is_error), 4) AS p95_latency_ms,
 coalesce(quantile_cont(latency_ms, 0.95) FILTER (NOT is_error) > 300, false) AS latency_alert,
 sum(is_error::int)::double / count(*) > 0.02 AS error_alert
FROM request_log {where} GROUP BY 1"""


@query(f"WITH {REQUEST_LOG}" + ALERT_SQL.format(where=""))
def latency_alerts_5min(spark, sf_dir):
    return alert_rows(latency_alerts(views.request_log(spark, sf_dir)))
