"""Customer readers and the synthetic generator."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.cleaning import clean_customers
from ..schemas import CONTRACT_CODES, PAYMENT_CODES, RAW_CUSTOMER_COLUMNS, SNAPSHOT_COLUMNS, SNAPSHOT_TYPES


def read_raw_export(spark: SparkSession, path: str) -> DataFrame:
    """Vendor CSV as all-string columns, matched by header name, then cleaned."""
    raw = spark.read.option("header", True).option("inferSchema", False).csv(path)
    missing = [c for c in RAW_CUSTOMER_COLUMNS if c not in raw.columns]
    if missing:
        raise ValueError(f"raw export lacks columns {missing}")
    return clean_customers(raw)


def read_processed(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).select(*SNAPSHOT_COLUMNS)


def _uniform(key: str, seed: int, draw: int) -> Column:
    """Uniform number in [0, 1) from 32 bits of an md5 of (seed, draw block, key).

    A hash instead of ``rand``: a row keeps its values when a task is retried
    or the input is partitioned differently.
    """
    block, lane = divmod(draw, 4)
    digest = F.md5(F.concat(F.lit(f"{seed}:{block}:"), F.col(key).cast("string")))
    return F.conv(F.substring(digest, 8 * lane + 1, 8), 16, 10).cast("double") / F.lit(2.0 ** 32)


def _normal(key: str, seed: int, draw: int) -> Column:
    """Standard normal by Box-Muller from draws ``draw`` and ``draw + 1``."""
    radius = F.sqrt(-2 * F.ln(1 - _uniform(key, seed, draw)))
    return radius * F.cos(2 * math.pi * _uniform(key, seed, draw + 1))


def _choice(u: Column, values: list[str], weights: list[float]) -> Column:
    edge, case = 0.0, None
    for value, weight in list(zip(values, weights))[:-1]:
        edge = round(edge + weight, 10)
        case = F.when(u < edge, value) if case is None else case.when(u < edge, value)
    return case.otherwise(values[-1])


def synthesize_customers(ids: DataFrame, key: str, start_date: str = "2024-01-01", seed: int = 42) -> DataFrame:
    """One synthetic snapshot row per id, with the published distributions.

    Contract, internet service and the flags are weighted draws, charges are
    normal around a base per service, and churn follows a logistic model.
    """
    # --- fixed values: distributions of the generator ---------------------
    contract_weights = [0.55, 0.25, 0.20]
    internet = ["dsl", "fiber_optic", "none"]
    internet_weights = [0.35, 0.45, 0.20]
    base_charge = {"dsl": 55, "fiber_optic": 85, "none": 25}
    flag_rates = {
        "online_security": 0.3, "online_backup": 0.35, "device_protection": 0.35, "tech_support": 0.3,
        "streaming_tv": 0.4, "streaming_movies": 0.4, "multiple_lines": 0.4, "senior_citizen": 0.16,
        "has_partner": 0.48, "has_dependents": 0.3, "paperless_billing": 0.6,
    }
    # -----------------------------------------------------------------------
    def u(draw: int) -> Column:
        return _uniform(key, seed, draw)

    def z(draw: int) -> Column:
        return _normal(key, seed, draw)

    first = ids.select(
        F.col(key).alias("_k"),
        F.floor(u(0) * 72).cast("int").alias("tenure_months"),
        _choice(u(1), CONTRACT_CODES, contract_weights).alias("contract_type"),
        _choice(u(2), PAYMENT_CODES, [0.25] * 4).alias("payment_method"),
        _choice(u(3), internet, internet_weights).alias("internet_service"),
        z(4).alias("_z1"), z(6).alias("_z2"), z(8).alias("_z3"), u(10).alias("_u"),
        *[(u(11 + i) < rate).cast("int").alias(name) for i, (name, rate) in enumerate(flag_rates.items())],
    )
    service = F.col("internet_service")
    base = F.when(service == "dsl", base_charge["dsl"]).when(
        service == "fiber_optic", base_charge["fiber_optic"]).otherwise(base_charge["none"])
    second = first.withColumn("_monthly", F.greatest(base + 10 * F.col("_z1"), F.lit(15.0))).withColumn(
        "_total", F.greatest(F.col("_monthly") * F.col("tenure_months") + 20 * F.col("_z2"), F.lit(0.0))
    )
    # --- fixed values: coefficients of the churn model ----------------------
    logit = (
        F.lit(-1.0)
        + 1.4 * (F.col("contract_type") == "month_to_month").cast("int")
        - 0.9 * (F.col("contract_type") == "two_year").cast("int")
        + 0.01 * (F.col("_monthly") - 60)
        - 0.015 * F.col("tenure_months")
        - 0.35 * (F.col("online_security") + F.col("tech_support"))
        + 0.3 * F.col("senior_citizen")
        - 0.3 * F.col("has_partner")
        + 0.6 * F.col("_z3")
    )
    # -----------------------------------------------------------------------
    computed = {
        "customer_id": F.concat(F.lit("C"), (F.col("_k") + 100000).cast("string")),
        "snapshot_date": F.lit(start_date).cast("date"),
        "monthly_charges": F.bround("_monthly", 2),
        "total_charges": F.bround("_total", 2),
        "churn": (F.col("_u") < 1 / (1 + F.exp(-logit))).cast("int"),
    }
    return second.select(*[
        computed.get(c, F.col(c)).cast(SNAPSHOT_TYPES[c]).alias(c) for c in SNAPSHOT_COLUMNS
    ])


def generate_customers(spark: SparkSession, n_rows: int, start_date: str = "2024-01-01", seed: int = 42) -> DataFrame:
    """``n_rows`` synthetic customers with consecutive ids."""
    return synthesize_customers(spark.range(n_rows), "id", start_date, seed)
