"""Telemetry readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.telemetry import with_temperature
from ..schemas import TELEMETRY


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header and the declared schema: no inference pass.

    A cell that does not parse is NULL and its line is kept in
    ``_corrupt_record``, so bad rows can be counted instead of vanishing.
    """
    return (
        spark.read.schema(TELEMETRY + ", _corrupt_record string")
        .option("header", True).option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_corrupt_record")
        .csv(path)
    )


def read_csv_with_temperature(spark: SparkSession, path: str) -> DataFrame:
    """Scan fused with the NULL filter."""
    return with_temperature(read_csv(spark, path).drop("_corrupt_record"))


def read_lake(spark: SparkSession, path: str, first_day: str | None = None, last_day: str | None = None) -> DataFrame:
    """Date-partitioned lake; the bounds prune partitions."""
    df = spark.read.parquet(path)
    if first_day is not None:
        df = df.filter(F.col("event_date") >= F.lit(first_day).cast("date"))
    if last_day is not None:
        df = df.filter(F.col("event_date") <= F.lit(last_day).cast("date"))
    return df
