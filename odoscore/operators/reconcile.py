"""Compare two keyed results."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.telemetry import abs_difference
from ..schemas import RECONCILE_TOLERANCE


def differences(left: DataFrame, right: DataFrame, keys: list[str], left_value: str, right_value: str) -> DataFrame:
    """Key-wise values and absolute difference; keys on one side only are kept."""
    l = left.select(*[F.col(k).alias(f"_l_{k}") for k in keys], F.col(left_value).alias("left_value"), F.lit(1).alias("_l"))
    r = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys], F.col(right_value).alias("right_value"), F.lit(1).alias("_r"))
    same = [F.col(f"_l_{k}").eqNullSafe(F.col(f"_r_{k}")) for k in keys]
    return l.join(r, same, "full_outer").select(
        *[F.coalesce(f"_l_{k}", f"_r_{k}").alias(k) for k in keys],
        "left_value",
        "right_value",
        abs_difference(F.col("left_value"), F.col("right_value")).alias("diff"),
        F.col("_r").isNull().alias("only_left"),
        F.col("_l").isNull().alias("only_right"),
    )


def reconcile(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    left_value: str,
    right_value: str,
    tolerance: float = RECONCILE_TOLERANCE,
) -> DataFrame:
    """One verdict row.  A missing key or a one-sided NULL fails, not only a large difference."""
    one_null = F.col("left_value").isNull() != F.col("right_value").isNull()
    return (
        differences(left, right, keys, left_value, right_value)
        .agg(
            F.count("*").alias("n_keys"),
            F.count_if(F.col("only_left") | F.col("only_right") | one_null).alias("n_unmatched"),
            F.max("diff").alias("max_abs_diff"),
        )
        .withColumn(
            "matches",
            (F.col("n_unmatched") == 0) & (F.coalesce("max_abs_diff", F.lit(0.0)) < tolerance),
        )
    )
