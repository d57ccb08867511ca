"""Small helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.lineage import cut_lineage

#: A word of a document: a run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def without(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """``df`` less the columns that an operator is about to add (names compare without case)."""
    taken = {name.lower() for name in names}
    return df.select([F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


def set_aside(df: DataFrame, names: Iterable[str]) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``df`` with the columns of these names renamed, and a function that selects all its columns back under their names."""
    taken = {name.lower() for name in names}
    held = {c: f"__held_{i}" if c.lower() in taken else c for i, c in enumerate(df.columns)}
    renamed = df.select([F.col(f"`{c}`").alias(to) for c, to in held.items()])
    return renamed, lambda out: out.select([F.col(f"`{to}`").alias(c) for c, to in held.items()])


def stored(df: DataFrame) -> DataFrame:
    """Rows written once to the shared folder and read from there; survives lost executors."""
    return cut_lineage(df, "table")


def word_count(text: Column | str) -> Column:
    """Number of words; null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def step_up(value: str, bounds: list[int]) -> str:
    """SQL for the number of ``bounds`` (ascending) at or below ``value``, as a balanced tree of comparisons."""

    def tree(low: int, high: int) -> str:
        if low == high:
            return str(low)
        middle = (low + high) // 2
        return f"if({value} < {bounds[middle]}L, {tree(low, middle)}, {tree(middle + 1, high)})"

    return tree(0, len(bounds))
