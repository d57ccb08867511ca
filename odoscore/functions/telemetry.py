"""Row-level telemetry expressions: all narrow, all built-in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_temperature(df: DataFrame, column: str = "engine_temp") -> DataFrame:
    """Drop readings without a temperature; Parquet scans see ``IsNotNull``."""
    return df.filter(F.col(column).isNotNull())


def only_positive(df: DataFrame, column: str = "engine_temp") -> DataFrame:
    return df.filter(F.col(column) > 0)


def shift(df: DataFrame, column: str = "engine_temp", by: float = 0.01) -> DataFrame:
    return df.withColumn(column, F.col(column) + F.lit(by))


def scale_unless_hot(
    df: DataFrame, column: str = "engine_temp", ceiling: float = 100, factor: float = 1.001
) -> DataFrame:
    """Multiply by ``factor`` except above ``ceiling``."""
    value = F.col(column)
    return df.withColumn(column, F.when(value > ceiling, value).otherwise(value * F.lit(factor)))


def cycle_step(df: DataFrame, number: int) -> DataFrame:
    """Step ``number`` of the iterative workload: shift, scale and filter in turn."""
    return (shift, scale_unless_hot, only_positive)[number % 3](df)


def abs_difference(left: Column, right: Column) -> Column:
    return F.abs(left - right)
