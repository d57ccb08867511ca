"""Skew: salted aggregation, distinct and join, amplification, key balance.

A salt is a hash of columns that tell rows apart, never a random number: a
retried task must send each row to the partition it went to before.
"""

from __future__ import annotations

from functools import reduce
from operator import add, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import SALT_COUNT
from .lineage import cut_lineage

#: A key with fewer bytes is no burden to a task, whatever its share.
HOT_BYTES = 256 * 1024 * 1024
#: Rows weigh as many units of this many bytes as they fill.
UNIT_BYTES = 256


def salt(columns: list[str], n_salts: int = SALT_COUNT) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(n_salts)).cast("int")


def add_salt(df: DataFrame, salt_on: list[str], n_salts: int = SALT_COUNT) -> DataFrame:
    """Add ``salt`` beside the key; the key itself is left alone, whatever it contains."""
    return df.withColumn("salt", salt(salt_on, n_salts))


def remove_salt(df: DataFrame) -> DataFrame:
    return df.drop("salt")


def _partial(name: str, fn: str, column: str) -> list[Column]:
    if fn == "avg":
        return [F.sum(column).alias(f"{name}__s"), F.count(column).alias(f"{name}__n")]
    if fn == "count" and column == "*":
        return [F.count("*").alias(f"{name}__n")]
    make = {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max}[fn]
    return [make(column).alias(f"{name}__{'n' if fn == 'count' else 's'}")]


def _final(name: str, fn: str) -> Column:
    if fn == "avg":
        return F.try_divide(F.sum(f"{name}__s"), F.sum(f"{name}__n")).alias(name)
    if fn == "count":
        return F.sum(f"{name}__n").alias(name)
    return {"sum": F.sum, "min": F.min, "max": F.max}[fn](f"{name}__s").alias(name)


def salted_partials(
    df: DataFrame, keys: list[str], aggs: dict[str, tuple[str, str]], salt_on: list[str], n_salts: int = SALT_COUNT
) -> DataFrame:
    """Phase 1: partial columns per (key, salt)."""
    columns = [c for name, (fn, col) in aggs.items() for c in _partial(name, fn, col)]
    return add_salt(df, salt_on, n_salts).groupBy(*keys, "salt").agg(*columns)


def merge_partials(partials: DataFrame, keys: list[str], aggs: dict[str, tuple[str, str]]) -> DataFrame:
    """Phase 2: drop the salt and merge; averages divide once, here."""
    return remove_salt(partials).groupBy(*keys).agg(*[_final(n, fn) for n, (fn, _) in aggs.items()])


def salted_aggregate(
    df: DataFrame,
    keys: list[str],
    aggs: dict[str, tuple[str, str]],
    salt_on: list[str],
    n_salts: int = SALT_COUNT,
) -> DataFrame:
    """Two-phase aggregate; ``aggs`` maps output name to (sum|count|avg|min|max, column).

    Spark's own partial aggregation already reduces a hot key to one row per
    map task, so this form is for parity and for measuring, not for speed.
    """
    return merge_partials(salted_partials(df, keys, aggs, salt_on, n_salts), keys, aggs)


def salted_distinct(df: DataFrame, keys: list[str], value: str, name: str = "n_distinct") -> DataFrame:
    """Exact distinct values per key with the value itself as the salt.

    Rows are deduplicated on (key, value), so a hot key spreads over all
    partitions; only the per-partition counts meet on the key.
    """
    pairs = df.select(*keys, value).distinct()
    return pairs.groupBy(*keys).agg(F.count(value).alias(name))


def row_bytes(df: DataFrame) -> Column:
    """About the bytes of a row: the length of texts and of nested values as text, and eight for any other value."""

    def of(field: T.StructField) -> Column:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            return F.coalesce(F.octet_length(column), F.lit(0)) + 8
        if isinstance(field.dataType, T.ArrayType):
            return F.coalesce(8 * F.size(column), F.lit(0)) + 8
        if isinstance(field.dataType, (T.StructType, T.MapType)):
            return F.coalesce(F.octet_length(F.to_json(column)), F.lit(0)) + 8
        return F.lit(8)

    return reduce(add, [of(f) for f in df.schema])


def heavy_keys(
    df: DataFrame, keys: list[str], n_partitions: int | None = None, min_rows: int | None = None, min_bytes: int = HOT_BYTES
) -> DataFrame:
    """(keys..., n_rows, n_salts) of the keys with more bytes than one task should get.

    A task's fair part is all bytes over ``n_partitions`` (default: the session's shuffle partitions), and at least
    ``min_bytes``.  With ``min_rows`` every row weighs the same, and the fair part is at least that many rows.  There are fewer
    hot keys than partitions, and ``n_salts`` parts of a hot key are fair again.

    One scan finds the candidates with a frequent-items sketch, a few numbers per task instead of all distinct keys; a second one looks at
    wide rows, if there are any.  The sketch tracks sixteen items a partition, so a key above half the fair part is always
    among them; only the candidates are then counted, and where there are none, nothing is.
    """
    hot = _hot_keys(df, keys, n_partitions, min_rows, min_bytes)
    if hot is None:
        empty = df.select(*keys, F.lit(0).cast("long").alias("n_rows"), F.lit(0).alias("n_salts"))
        return df.sparkSession.createDataFrame([], empty.schema)
    return hot


def _hot_keys(df: DataFrame, keys: list[str], n_partitions: int | None, min_rows: int | None, min_bytes: int) -> DataFrame | None:
    n_partitions = n_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    least = min_rows if min_rows is not None else max(1, min_bytes // UNIT_BYTES)
    units = F.lit(1) if min_rows is not None else F.ceil(row_bytes(df) / UNIT_BYTES).cast("int")
    weighed = df.select(*keys, F.xxhash64(*keys).alias("_h"), units.alias("_units"))
    tracked = min(1_000_000, max(1024, 16 * n_partitions))
    # A hash of the key stands for it: two keys that share one are candidates together.
    sketch = F.expr(f"approx_top_k(_h, {min(tracked, 8 * n_partitions + 64)}, {tracked})")
    top, rows, total = weighed.agg(sketch, F.count("*"), F.sum("_units")).first()
    fair = max((total or 0) / n_partitions, least)
    # Rows that weigh more than one unit are sketched once more, by what they weigh beyond it.
    if (total or 0) > rows:
        more = weighed.where("_units > 1").select(F.explode(F.array_repeat("_h", F.col("_units") - 1)).alias("_h"))
        top = [*top, *more.agg(sketch).first()[0]]
    # Estimates are never below the count, and half of a hot key's weight is in one of the two.
    found = [(h,) for h in {item["item"] for item in top or [] if item["count"] > fair / 2}]
    if not found:
        return None
    some = weighed.join(F.broadcast(df.sparkSession.createDataFrame(found, "_h long")), "_h", "left_semi")
    counts = some.groupBy(*keys).agg(F.count("*").alias("n_rows"), F.sum("_units").alias("_weight")).filter(F.col("_weight") > fair)
    return counts.select(*keys, "n_rows", F.ceil(F.col("_weight") / fair).cast("int").alias("n_salts"))


def salted_join(
    big: DataFrame,
    small: DataFrame,
    keys: list[str],
    salt_on: list[str],
    how: str = "inner",
    hot: DataFrame | None = None,
    n_partitions: int | None = None,
    min_rows: int | None = None,
    min_bytes: int = HOT_BYTES,
) -> DataFrame:
    """Equi-join that splits only the hot keys of ``big``.

    Rows of a hot key get one of its salts from ``salt_on`` (columns of ``big`` that differ within the key); the matching rows
    of ``small`` are repeated once per salt.  All other keys keep salt 0.  Where nothing is hot the join is the plain one.
    ``hot`` is a table as :func:`heavy_keys` makes it, if one is known; else the keys are looked for first.  It has
    fewer rows than there are partitions, so it is broadcast.  ``how`` is inner, left, left_semi or left_anti.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"salted_join keeps the big side on the left: {how!r} is not supported")
    if hot is None:
        hot = _hot_keys(big, keys, n_partitions, min_rows, min_bytes)
        if hot is None:
            return big.join(small, keys, how)
        hot = cut_lineage(hot, "table")
    # A NULL key matches nothing, so its rows may be spread as widely as the widest key.
    widest = hot.agg(F.max("n_salts")).first()[0]
    if widest is None:
        return big.join(small, keys, how)
    salts = F.broadcast(hot.select(*keys, F.col("n_salts").alias("_n")))
    no_key = reduce(or_, [F.col(k).isNull() for k in keys])
    parts = F.when(no_key, F.lit(widest)).otherwise(F.coalesce("_n", F.lit(1)))
    big_salted = big.join(salts, keys, "left").withColumn("_salt", F.pmod(F.xxhash64(*salt_on), parts).cast("int")).drop("_n")
    copies = F.sequence(F.lit(0), F.coalesce("_n", F.lit(1)) - 1)
    small_copied = small.join(salts, keys, "left").withColumn("_salt", F.explode(copies)).drop("_n")
    return big_salted.join(small_copied, [*keys, "_salt"], how).drop("_salt")


def amplify(df: DataFrame, hot: Column, copies: int) -> DataFrame:
    """Repeat every row where ``hot`` holds ``copies`` more times, as one plan node.

    ``copy_no`` (0 for the original) keeps the repeats apart for salting.
    """
    numbers = F.when(hot, F.sequence(F.lit(0), F.lit(copies))).otherwise(F.array(F.lit(0)))
    return df.withColumn("copy_no", F.explode(numbers))


def amplify_top_key(df: DataFrame, key: str, copies: int) -> DataFrame:
    """Amplify the largest key; the key is found by a one-row scalar subquery."""
    from .aggregate import top_keys

    return amplify(df, F.col(key) == top_keys(df, key, 1).select(key).scalar(), copies)


def partition_sizes(df: DataFrame) -> DataFrame:
    """Rows per physical partition of ``df`` as it stands."""
    return df.groupBy(F.spark_partition_id().alias("partition_id")).agg(F.count("*").alias("n_rows"))


def stable_salt(columns: list[str], n_salts: int = SALT_COUNT) -> Column:
    """A salt that other engines can compute too: from the MD5 of the columns' text."""
    text = F.concat_ws(":", *[F.col(c).cast("string") for c in columns])
    return (F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long") % n_salts).cast("int")


def key_balance(df: DataFrame, key: str, salt_on: list[str], n_salts: int = SALT_COUNT) -> DataFrame:
    """What salting does to the largest group: per key its rows, and the rows of its largest and smallest (key, salt)."""
    salted = df.groupBy(key, stable_salt(salt_on, n_salts).alias("salt")).agg(F.count("*").alias("n"))
    return salted.groupBy(key).agg(
        F.sum("n").alias("n_rows"), F.count("*").alias("n_salts"), F.max("n").alias("largest_part"), F.min("n").alias("smallest_part")
    )
