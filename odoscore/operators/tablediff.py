"""Differences between two large tables, found by digests that do not depend on order.

Rows fall into buckets by a hash of their key, and buckets into leaves.  A digest is a count and two sums of row hashes; it is
combined on the map side, so a level costs one scan and a few numbers per bucket, whatever keys are hot.  Only buckets whose
digests differ are looked into: their leaves first, then the rows of differing leaves, which are the only rows shuffled.  Equal
tables cost one scan of each.  All rows of a key lie in one leaf, so a hot key that differs is compared whole, spread over
tasks by its rows.  Two different buckets pass as equal only if the count and both sums of 64-bit hashes agree.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .lineage import Scratch

#: Buckets of the first level, and leaves of each; digests of a level are never more than the first times the second.
BUCKETS, LEAVES = 4096, 4096
_SEEDS = (1, 2)


@dataclass
class TableDiff:
    """``keys``: one row per differing key; ``rows``: the rows that one side has more often; sizes of what was looked into."""

    keys: DataFrame
    rows: DataFrame
    differing_buckets: int
    differing_leaves: int
    compared_rows: int


def _place(keys: list[str], seed: int, parts: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(seed), *[F.col(f"`{k}`") for k in keys]), F.lit(parts)).cast("int")


def digests(df: DataFrame, keys: list[str], buckets: int = BUCKETS, by: list[str] = ()) -> DataFrame:
    """``bucket`` (after the columns ``by``), row count and two order-free sums of row hashes over all other columns.

    The result is small and can be kept beside a version of a table, so that a later comparison need not read it.
    """
    columns = [F.col(f"`{c}`") for c in sorted(set(df.columns) - set(by))]
    # Nulls leave a hash unchanged, so which columns are null is hashed, too.
    nulls = F.concat_ws("", *[F.when(c.isNull(), "1").otherwise("0") for c in columns])
    sums = [F.sum(F.xxhash64(F.lit(s), nulls, *columns).cast("decimal(38,0)")).alias(f"sum_{s}") for s in _SEEDS]
    at = _place(keys, 11 if not by else 12, buckets).alias("bucket")
    return df.groupBy(*by, at).agg(F.count("*").alias("n_rows"), *sums)


def differing(left: DataFrame, right: DataFrame) -> DataFrame:
    """The buckets whose digests are not the same on both sides, those of one side only included."""
    same = ["n_rows", *[f"sum_{s}" for s in _SEEDS]]
    names = [c for c in left.columns if c not in same]
    both = left.withColumn("side", F.lit(1)).unionByName(right.withColumn("side", F.lit(-1)))
    # Equal digests cancel out.
    net = both.groupBy(*names).agg(*[F.sum(F.col(c) * F.col("side")).alias(c) for c in same])
    return net.where(" OR ".join(f"{c} != 0" for c in same)).select(*names)


def diff_tables(
    left: DataFrame, right: DataFrame, keys: list[str], scratch: Scratch,
    left_digests: DataFrame | None = None, buckets: int = BUCKETS, leaves: int = LEAVES,
) -> TableDiff:
    """Compare two tables of the same columns as bags of rows; null keys and null values equal themselves.

    ``left_digests`` are those of an earlier call of :func:`digests` with the same buckets, if they were kept.  The change of a key is
    ``missing`` (no row on the right), ``added`` (none on the left), ``repeated`` (the same distinct rows in other numbers) or
    ``changed``.  ``left_more`` and ``right_more`` count the rows that one side has and the other lacks.
    """
    if sorted(left.columns) != sorted(right.columns):
        raise ValueError(f"columns differ: {sorted(set(left.columns) ^ set(right.columns))}")
    if taken := {"_bucket", "_leaf", "_left", "_right"} & set(left.columns):
        raise ValueError(f"reserved names: {sorted(taken)}")
    names = left.columns
    sides = [left, right.select(*[F.col(f"`{c}`") for c in names])]
    known = [left_digests if left_digests is not None else digests(sides[0], keys, buckets), digests(sides[1], keys, buckets)]
    # At most ``buckets`` rows.
    hit = scratch.store(differing(*known).withColumnRenamed("bucket", "_bucket"))
    inside = [df.withColumn("_bucket", _place(keys, 11, buckets)).join(F.broadcast(hit), "_bucket", "left_semi") for df in sides]
    hit_leaves = scratch.store(differing(*[digests(df, keys, leaves, ["_bucket"]) for df in inside]).withColumnRenamed("bucket", "_leaf"))
    n_buckets, n_leaves = hit.count(), hit_leaves.count()
    # Up to buckets x leaves rows of two numbers: stored, so the planner knows the size and chooses the join.
    marked = [
        df.withColumn("_leaf", _place(keys, 12, leaves)).join(hit_leaves, ["_bucket", "_leaf"], "left_semi").select(
            *[F.col(f"`{c}`") for c in names], F.lit(i == 0).cast("long").alias("_left"), F.lit(i == 1).cast("long").alias("_right")
        ) for i, df in enumerate(inside)
    ]
    # Grouped by whole rows: the rows of one hot key spread, and repeats combine before the shuffle.
    bags = scratch.store(marked[0].unionByName(marked[1]).groupBy(*[F.col(f"`{c}`") for c in names]).agg(
        F.sum("_left").alias("_left"), F.sum("_right").alias("_right")
    ))
    compared = bags.agg(F.coalesce(F.sum(F.col("_left") + F.col("_right")), F.lit(0))).first()[0]
    more_left, more_right = F.greatest(F.col("_left") - F.col("_right"), F.lit(0)), F.greatest(F.col("_right") - F.col("_left"), F.lit(0))
    one_side = F.count_if((F.col("_left") == 0) | (F.col("_right") == 0))
    change = F.when(F.sum("_right") == 0, "missing").when(F.sum("_left") == 0, "added").when(one_side == 0, "repeated").otherwise("changed")
    per_key = bags.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(
        change.alias("change"), F.sum(more_left).alias("left_more"), F.sum(more_right).alias("right_more")
    ).where("left_more > 0 OR right_more > 0")
    rows = bags.where("_left != _right").withColumnsRenamed({"_left": "left_rows", "_right": "right_rows"})
    return TableDiff(per_key, rows, n_buckets, n_leaves, compared)
