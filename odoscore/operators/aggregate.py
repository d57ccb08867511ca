"""Group aggregates over telemetry.

Every aggregate is algebraic, so map tasks combine before the shuffle and a
hot key costs one row per task, however many readings it has.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def average_by_key(df: DataFrame, key: str = "vehicle_model", value: str = "engine_temp") -> DataFrame:
    return df.groupBy(key).agg(F.avg(value).alias(f"avg_{value}"), F.count("*").alias("n_records"))


def counts_by_key(df: DataFrame, key: str = "vehicle_model") -> DataFrame:
    return df.groupBy(key).agg(F.count("*").alias("record_count"))


def with_share(counts: DataFrame, count: str = "record_count") -> DataFrame:
    """Percentage of the total, two decimals.

    The total is a scalar subquery over the counts: no driver value, no
    one-task window, and the shuffle of ``counts`` is reused for it.
    """
    total = counts.agg(F.sum(count)).scalar()
    return counts.withColumn("pct_of_total", F.round(F.col(count) * 100.0 / total, 2))


def skew_ratio(df: DataFrame, key: str = "vehicle_model") -> DataFrame:
    """One row: number of keys, largest and smallest group, and their ratio."""
    n = F.col("record_count")
    return counts_by_key(df, key).agg(
        F.count("*").alias("n_keys"),
        F.max(n).alias("max_count"),
        F.min(n).alias("min_count"),
        F.try_divide(F.max(n), F.min(n)).alias("skew_ratio"),
    )


def top_keys(df: DataFrame, key: str = "vehicle_model", k: int = 1) -> DataFrame:
    """The ``k`` largest groups; equal counts are ordered by key."""
    return counts_by_key(df, key).orderBy(F.desc("record_count"), F.asc(key)).limit(k)


def preview(df: DataFrame, order_by: list[str], n: int = 5) -> DataFrame:
    """First ``n`` rows of a stated order."""
    return df.orderBy(*order_by).limit(n)


def profile(df: DataFrame, key: str = "vehicle_model", value: str = "engine_temp") -> DataFrame:
    """Rows, usable rows, removed rows and groups among the usable rows, in one pass."""
    usable = F.col(value).isNotNull()
    return df.agg(
        F.count("*").alias("rows_total"),
        F.count_if(usable).alias("rows_kept"),
        F.count_if(~usable).alias("rows_removed"),
        F.count_distinct(F.when(usable, F.col(key))).alias("n_groups"),
    )


def total_by_key(df: DataFrame, key: str = "vehicle_model", value: str = "miles") -> DataFrame:
    """Literal sum of the readings (the odometer is summed as it stands)."""
    return df.groupBy(key).agg(F.sum(value).alias(f"sum_{value}"), F.count("*").alias("n_records"))


def distance_by_key(
    df: DataFrame, key: str = "vehicle_model", entity: str = "vehicle_id", odometer: str = "miles"
) -> DataFrame:
    """Distance from a running odometer: per vehicle max - min, summed per key."""
    per_vehicle = df.groupBy(key, entity).agg((F.max(odometer) - F.min(odometer)).alias("_span"))
    return per_vehicle.groupBy(key).agg(
        F.sum("_span").alias("distance_driven"), F.count("*").alias("n_vehicles")
    )
