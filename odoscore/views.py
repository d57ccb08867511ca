"""Adapter views that shape the given tables like the library's inputs.

The expressions are plain SQL shared by Spark and the SQL checks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .operators.lineage import cut_lineage

TELEMETRY_EXPRS = [
    "event_id",
    "ts AS event_ts",
    "concat('EV-', lpad(cast(user_id AS string), 3, '0')) AS vehicle_id",
    "CASE event_type WHEN 'signup' THEN 'Model_Y' WHEN 'purchase' THEN 'Model_3' ELSE event_type END AS vehicle_model",
    "CASE WHEN event_id % 17 = 0 THEN NULL ELSE value END AS engine_temp",
    "cast(event_id % 121 AS double) AS speed",
    "cast(1300 + user_id % 40 AS double) / 100 AS latitude",
    "cast(8010 + user_id % 30 AS double) / 100 AS longitude",
    "cast(300 + event_id % 100 AS double) / 100 AS battery_efficiency",
    "cast((event_id * 37) % 150000 AS double) / 10 AS miles",
]

REQUEST_LOG_EXPRS = [
    "event_id AS request_id",
    "ts AS started_at",
    "value AS latency_ms",
    "event_type = 'error' AS is_error",
]

CUSTOMER_BASE_EXPRS = [
    "c_custkey AS k",
    "c_nationkey AS nation",
    "(c_custkey * 7) % 73 AS tn",
    "1825 + (c_custkey * 13) % 10000 AS cents",
    "CASE c_nationkey % 3 WHEN 0 THEN 'DSL' WHEN 1 THEN 'Fiber optic' ELSE 'No' END AS net",
    "CASE WHEN c_custkey % 101 = 100 THEN 'Weekly' WHEN c_custkey % 4 IN (0, 1) THEN 'Month-to-month' "
    "WHEN c_custkey % 4 = 2 THEN 'One year' ELSE 'Two year' END AS con",
]


def _service(condition: str, name: str) -> str:
    return (
        f"CASE WHEN net = 'No' THEN 'No internet service' WHEN {condition} THEN 'Yes' ELSE 'No' END AS {name}"
    )


RAW_CUSTOMER_EXPRS = [
    "concat('C', cast(100000 + k AS string)) AS customerID",
    "cast(tn AS int) AS tenure",
    "con AS Contract",
    "CASE k % 5 WHEN 1 THEN 'Mailed check' WHEN 2 THEN 'Bank transfer (automatic)' "
    "WHEN 3 THEN 'Credit card (automatic)' ELSE 'Electronic check' END AS PaymentMethod",
    "net AS InternetService",
    "cast(cents AS double) / 100 AS MonthlyCharges",
    "CASE WHEN tn = 0 THEN ' ' ELSE concat(cast(cast(floor(cents * tn / 100) AS bigint) AS string), '.', "
    "lpad(cast((cents * tn) % 100 AS string), 2, '0')) END AS TotalCharges",
    "cast(CASE WHEN k % 6 = 0 THEN 1 ELSE 0 END AS int) AS SeniorCitizen",
    _service("k % 3 = 0", "OnlineSecurity"),
    _service("k % 2 = 0", "OnlineBackup"),
    _service("k % 5 < 2", "DeviceProtection"),
    _service("k % 7 < 2", "TechSupport"),
    _service("k % 8 < 3", "StreamingTV"),
    _service("k % 9 < 4", "StreamingMovies"),
    "CASE WHEN k % 10 = 9 THEN 'No phone service' WHEN k % 10 < 4 THEN 'Yes' ELSE 'No' END AS MultipleLines",
    "CASE WHEN k % 2 = 1 THEN 'Yes' ELSE 'No' END AS Partner",
    "CASE WHEN k % 3 = 1 THEN 'Yes' ELSE 'No' END AS Dependents",
    "CASE WHEN k % 97 = 0 THEN NULL WHEN k % 5 < 3 THEN 'Yes' ELSE 'No' END AS PaperlessBilling",
    "CASE WHEN (con = 'Month-to-month' AND tn <= 12) OR k % 11 = 0 THEN 'Yes' ELSE 'No' END AS Churn",
]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stream_table(spark: SparkSession, sf_dir: str, name: str, **options: str) -> DataFrame:
    """The same table as a file stream.

    The last letter is written as a glob so the path may be one file or a
    folder of files.
    """
    path = f"{sf_dir.rstrip('/')}/{name}.parque[t]"
    schema = read_table(spark, sf_dir, name).schema
    return spark.readStream.schema(schema).options(**options).parquet(path)


def telemetry_from_events(events: DataFrame) -> DataFrame:
    return events.selectExpr(*TELEMETRY_EXPRS)


def request_log_from_events(events: DataFrame) -> DataFrame:
    return events.selectExpr(*REQUEST_LOG_EXPRS)


def dealt_out(df: DataFrame) -> DataFrame:
    """The same rows, stored as one file per core: of a file of one row group all that follows is done by one task.

    Stored, because filters with all they compute would else be moved before the exchange, into that task.
    """
    return cut_lineage(df.repartition(df.sparkSession.sparkContext.defaultParallelism), "table")


def raw_customers_from_table(customer: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """``keep`` may name ``k`` (customer number) and ``nation``."""
    return customer.selectExpr(*CUSTOMER_BASE_EXPRS).selectExpr(*RAW_CUSTOMER_EXPRS, *(keep or []))


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return telemetry_from_events(read_table(spark, sf_dir, "events"))


def request_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return request_log_from_events(read_table(spark, sf_dir, "events"))


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_customers_from_table(read_table(spark, sf_dir, "customer"))
