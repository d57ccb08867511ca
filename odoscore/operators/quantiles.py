"""Exact percentiles with linear interpolation, without collecting a group.

Values are first counted (equal values collapse on the map side).  The wanted
ranks are then located coarse to fine: a fixed logarithmic cell, a linear cell
inside it, and only then single values.  No task holds more than the cells of
a group or the values of one fine cell.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

COARSE_CELLS_PER_E = 1000      # cells per factor e; about 0.1 % of a large value each
FINE_CELLS = 4096


def _coarse_cell(value: Column) -> Column:
    return (F.signum(value) * F.floor(F.log1p(F.abs(value)) * COARSE_CELLS_PER_E)).cast("long")


def exact_percentiles(
    df: DataFrame,
    value: str,
    probs: list[float],
    by: list[str] | None = None,
    weight: str | None = None,
    fine: bool = True,
) -> DataFrame:
    """``by`` columns and ``q``, an array with one percentile per entry of ``probs``.

    NULL and NaN are ignored.  ``weight`` names a count column when the input
    already has one row per group and value.  ``fine=False`` leaves out the second step;
    it suits groups that are limited by themselves, such as short time windows.
    """
    by = by or []
    usable = df.filter(F.col(value).isNotNull() & ~F.isnan(value))
    v = F.col(value).cast("double").alias("_v")
    if weight is None:
        values = usable.groupBy(*by, v).agg(F.count("*").alias("_n"))
    else:
        values = usable.select(*by, v, F.col(weight).alias("_n"))
    values = values.withColumn("_cell", _coarse_cell(F.col("_v")))

    # 1. the coarse cell of every wanted rank
    cells = values.groupBy(*by, "_cell").agg(
        F.sum("_n").alias("_in"), F.min("_v").alias("_low"), F.max("_v").alias("_high")
    )
    group = Window.partitionBy(*by)
    upto = group.orderBy("_cell").rowsBetween(Window.unboundedPreceding, 0)
    cells = cells.withColumn("_end", F.sum("_in").over(upto)).withColumn("_total", F.sum("_in").over(group))
    # Two neighbouring ranks per percentile; the second is clamped to the last row.
    ranks = ", ".join(
        f"struct({2 * i + side} AS slot, least(floor((_total - 1) * {float(p)!r}D) + {side}, _total - 1) AS rank, "
        f"(_total - 1) * {float(p)!r}D % 1 AS part)"
        for i, p in enumerate(probs) for side in (0, 1)
    )
    hit = (
        cells.withColumn("_base", F.col("_end") - F.col("_in"))
        .select(*by, "_cell", "_base", "_low", "_high", "_end", F.expr(f"inline(array({ranks}))"))
        .filter("rank >= _base AND rank < _end")
        .drop("_end")
    )
    # Two rows per percentile and group; without groups that is a fixed handful.
    near = _join_groups(values, hit if by else F.broadcast(hit), [*by, "_cell"])

    # 2. the fine cell inside it
    if fine:
        near = _narrow(near, by)

    # 3. the value itself
    last = Window.partitionBy(*by, "slot").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    found = near.withColumn("_end", F.col("_base") + F.sum("_n").over(last)).filter(
        "rank < _end AND rank >= _end - _n"
    )

    def picked(column: str, slot: int) -> str:
        return f"max(CASE WHEN slot = {slot} THEN {column} END)"

    q = ", ".join(
        f"{picked('_v', 2 * i)} + ({picked('_v', 2 * i + 1)} - {picked('_v', 2 * i)}) * {picked('part', 2 * i)}"
        for i in range(len(probs))
    )
    return found.groupBy(*by).agg(F.expr(f"array({q})").alias("q"))


def _narrow(near: DataFrame, by: list[str]) -> DataFrame:
    """Keep, per wanted rank, the values of the linear sub-cell that holds it."""
    near = near.withColumn(
        "_fine", F.expr(f"coalesce(floor(try_divide(_v - _low, _high - _low) * {FINE_CELLS}), 0)")
    )
    upto = Window.partitionBy(*by, "slot").orderBy("_fine").rowsBetween(Window.unboundedPreceding, 0)
    hit = (
        near.groupBy(*by, "slot", "rank", "_base", "_fine").agg(F.sum("_n").alias("_in"))
        .withColumn("_end", F.col("_base") + F.sum("_in").over(upto))
        .withColumn("_base", F.col("_end") - F.col("_in"))
        .filter("rank >= _base AND rank < _end")
        .select(*by, "slot", "_fine", "_base")
    )
    return _join_groups(near.drop("_base"), hit if by else F.broadcast(hit), [*by, "slot", "_fine"])


def _join_groups(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Equi-join in which NULL group keys match each other."""
    renamed = right.select(*[F.col(k).alias(f"_r_{k}") if k in keys else F.col(k) for k in right.columns])
    same = [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys]
    return left.join(renamed, same).drop(*[f"_r_{k}" for k in keys])
