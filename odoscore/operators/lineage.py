"""Iteration with lineage control, and plan inspection helpers."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import delete_path, scratch_path, shared_root


def lineage_depth(df: DataFrame) -> int:
    """Nodes of the logical plan as written (one per line; classic sessions only)."""
    text = df._jdf.queryExecution().logical().toString()
    return sum(1 for line in text.splitlines() if line.strip())


def cut_lineage(df: DataFrame, how: str = "checkpoint") -> DataFrame:
    """Start a new plan root from stored rows.

    ``checkpoint`` keeps Spark's reliable checkpoint; ``table`` writes Parquet
    to the shared folder, which stays columnar and prunable for later steps.
    Both survive lost executors.
    """
    spark = df.sparkSession
    if how == "checkpoint":
        shared_root(spark)
        return df.checkpoint(eager=True)
    if how == "table":
        path = scratch_path(spark, "lineage")
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)
    raise ValueError(f"unknown way to cut lineage: {how!r}")


class Scratch:
    """Stored copies of one job; :meth:`release` deletes them once their last reader is done."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def store(self, df: DataFrame) -> DataFrame:
        path = scratch_path(self.spark, "stored")
        df.write.parquet(path)
        self.paths.append(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def release(self) -> None:
        for path in self.paths:
            delete_path(self.spark, path)
        self.paths = []

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_) -> None:
        self.release()


def iterate(
    df: DataFrame,
    step: Callable[[DataFrame, int], DataFrame],
    n_steps: int = 15,
    checkpoint_every: int = 5,
    how: str = "checkpoint",
    on_step: Callable[[int, DataFrame, bool], None] | None = None,
) -> DataFrame:
    """Apply ``step(df, i)`` for i = 1..n, storing the rows every ``checkpoint_every`` steps.

    ``checkpoint_every=0`` never stores.  ``on_step(i, df, stored)`` sees each state.
    """
    for number in range(1, n_steps + 1):
        df = step(df, number)
        stored = checkpoint_every > 0 and number % checkpoint_every == 0
        if stored:
            df = cut_lineage(df, how)
        if on_step is not None:
            on_step(number, df, stored)
    return df


def depth_trace(df: DataFrame, step, n_steps: int = 15, checkpoint_every: int = 5) -> list[tuple[int, int, bool]]:
    """(step, plan depth, stored) for every step, the start included."""
    trace = [(0, lineage_depth(df), False)]
    iterate(
        df, step, n_steps, checkpoint_every,
        on_step=lambda i, state, stored: trace.append((i, lineage_depth(state), stored)),
    )
    return trace


def executed_plan(df: DataFrame) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def count_exchanges(df: DataFrame) -> int:
    """Shuffles in the planned query: 0 means every dependency is narrow."""
    return len(re.findall(r"\bExchange\b", executed_plan(df)))


def explain(df: DataFrame) -> str:
    """The formatted plan as text (what ``df.explain('formatted')`` prints)."""
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
