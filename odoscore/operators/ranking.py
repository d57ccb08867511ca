"""Seeded order, exact cuts of that order, stratified split and dated batches.

The order is the md5 of ``seed:key``.  Cutting it at exact positions needs no
global sort: rows are counted per hash prefix (one small aggregate), only the
prefixes that hold a cut are looked at row by row, and every row then compares
its hash with the cut values.  The data itself is never shuffled, and repeats
of one key share a hash, so they stay on the same side of every cut.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PREFIX = 4      # hex digits: 65,536 counting cells


def hash_order(key: str, seed: int) -> Column:
    """Never NULL (a NULL key counts as empty), so joins on it add no filter and plans share their shuffles."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))))


def shuffled(df: DataFrame, key: str, seed: int = 42) -> DataFrame:
    """All rows in seeded order."""
    return df.orderBy(hash_order(key, seed), key)


def order_cuts(
    df: DataFrame,
    key: str,
    seed: int,
    positions: Column | Callable[[DataFrame], DataFrame],
    by: list[str] | None = None,
    prefix: int = PREFIX,
) -> DataFrame:
    """Hash value at each wanted position, as a sorted array ``cuts`` per group.

    A position p means "after p rows": rows with a hash above the cut come
    later.  Without ``by``, ``positions`` is an array column over ``n_rows``.
    With ``by``, it maps the table (by..., n_rows) to (by..., positions).
    """
    by = by or []
    rows = df.select(*by, hash_order(key, seed).alias("_h"))
    rows = rows.withColumn("_cell", F.substring("_h", 1, prefix))
    cells = rows.groupBy(*by, "_cell").agg(F.count("*").alias("_n"))
    # At most 16**prefix rows per group reach these windows.
    upto = Window.partitionBy(*by).orderBy("_cell").rowsBetween(Window.unboundedPreceding, 0)
    placed = cells.withColumn("_end", F.sum("_n").over(upto)).withColumn("_start", F.col("_end") - F.col("_n"))
    if by:
        placed = placed.join(positions(cells.groupBy(*by).agg(F.sum("_n").alias("n_rows"))), by)
    else:
        placed = placed.withColumn("n_rows", F.sum("_n").over(Window.partitionBy()))
        placed = placed.withColumn("positions", positions)
    at_zero = (F.col("_pos") == 0) & (F.col("_start") == 0)
    inside = (F.col("_pos") > F.col("_start")) & (F.col("_pos") <= F.col("_end"))
    hit = placed.select(*by, "_cell", "_start", "_end", F.posexplode("positions").alias("_slot", "_pos")).filter(
        at_zero | inside
    ).drop("_end")
    # One row per cut and group: safe to broadcast, so the rows stay where they are.
    edge = rows.join(F.broadcast(hit), [*by, "_cell"]).groupBy(*by, "_slot", "_pos", "_start", "_h").agg(F.count("*").alias("_n"))
    along = Window.partitionBy(*by, "_slot").orderBy("_h").rowsBetween(Window.unboundedPreceding, 0)
    last = F.col("_start") + F.sum("_n").over(along)
    cut = edge.withColumn("_last", last).withColumn("_first", F.col("_last") - F.col("_n")).filter(
        ((F.col("_first") < F.col("_pos")) & (F.col("_pos") <= F.col("_last")))
        | ((F.col("_pos") == 0) & (F.col("_first") == 0))
    )
    value = F.when(F.col("_pos") == 0, F.lit("")).otherwise(F.col("_h"))
    return cut.groupBy(*by).agg(F.array_sort(F.collect_list(value)).alias("cuts"))


def with_part(df: DataFrame, key: str, seed: int, cuts: Column, n_cuts: int, name: str) -> DataFrame:
    """Add the part number: 0 up to the first cut, 1 up to the second, and so on; NULL without cuts.

    The hash is a column of its own and compared cut by cut: inside an array
    function it would be computed once per cut.
    """
    above = " + ".join(f"coalesce(cast(_h > get(_cuts, {i}) AS int), 0)" for i in range(n_cuts))
    return (
        df.withColumns({"_h": hash_order(key, seed), "_cuts": cuts})
        .withColumn(name, F.expr(f"CASE WHEN _cuts IS NOT NULL THEN {above} END"))
        .drop("_h", "_cuts")
    )


def near_equal_positions(n_parts: int, n_rows: str = "n_rows") -> Column:
    """Cut positions for sizes that differ by at most one, the larger parts first."""
    return F.expr(
        f"transform(sequence(1, {n_parts - 1}), "
        f"i -> ({n_rows} div {n_parts}) * i + least({n_rows} % {n_parts}, cast(i AS bigint)))"
    )


def stage_batches(
    df: DataFrame, key: str = "customer_id", n_batches: int = 10, start_date: str = "2024-01-01", seed: int = 42,
    date_column: str = "snapshot_date",
) -> DataFrame:
    """Give every row of a static table one of ``n_batches`` consecutive dates."""
    if n_batches == 1:
        return df.withColumn(date_column, F.lit(start_date).cast("date"))
    cuts = order_cuts(df, key, seed, near_equal_positions(n_batches)).select("cuts").scalar()
    return (
        with_part(df, key, seed, cuts, n_batches - 1, "_day")
        .withColumn(date_column, F.date_add(F.lit(start_date).cast("date"), F.coalesce("_day", F.lit(0))))
        .drop("_day")
    )


def _share(count: str, total: Column, draw: Column, by: str) -> Column:
    """Largest-remainder share of ``draw`` for each class: integers that add up to ``draw``."""
    exact = F.col(count).cast("decimal(19,0)") * draw.cast("decimal(19,0)")
    whole = F.floor((exact - exact % total) / total).cast("long")
    rest = (exact % total).cast("decimal(38,0)")
    missing = draw - F.sum(whole).over(Window.partitionBy())
    place = F.row_number().over(Window.orderBy(F.desc(rest), F.asc(by)))
    return whole + (place <= missing).cast("long")


def split_positions(totals: DataFrame, label: str, validation: float, test: float) -> DataFrame:
    """Per class: rows in train, and rows in train + validation.

    Overall sizes follow the two-step rule (held-out rows rounded up, then the
    test half rounded up); classes share them by largest remainder.  One row
    per class reaches the windows.
    """
    held = validation + test
    everything = Window.partitionBy()
    t = totals.filter(F.col(label).isNotNull()).withColumn("_all", F.sum("n_rows").over(everything))
    t = t.withColumn("_held", F.ceil(F.round(F.col("_all") * F.lit(held), 9)).cast("long"))
    t = t.withColumn("_train", _share("n_rows", F.col("_all"), F.col("_all") - F.col("_held"), label))
    t = t.withColumn("_rest", F.col("n_rows") - F.col("_train"))
    t = t.withColumn("_test", F.ceil(F.round(F.col("_held") * F.lit(test / held), 9)).cast("long"))
    t = t.withColumn("_val", _share("_rest", F.col("_held"), F.col("_held") - F.col("_test"), label))
    return t.select(label, F.array("_train", F.col("_train") + F.col("_val")).alias("positions"))


def stratified_split(
    df: DataFrame,
    label: str = "churn",
    key: str = "customer_id",
    validation: float = 0.15,
    test: float = 0.15,
    seed: int = 42,
) -> DataFrame:
    """Add ``split`` (train / validation / test), stratified by ``label``.

    Rows without a label get no split.  The cuts come back as one map from
    class to hash values, so adding the split moves no row.
    """
    cuts = order_cuts(
        df.filter(F.col(label).isNotNull()), key, seed,
        lambda totals: split_positions(totals, label, validation, test), by=[label],
    )
    by_class = cuts.agg(F.map_from_entries(F.collect_list(F.struct(label, "cuts")))).scalar()
    parts = with_part(df, key, seed, F.try_element_at(by_class, F.col(label)), 2, "_part")
    return parts.withColumn(
        "split", F.expr("CASE _part WHEN 0 THEN 'train' WHEN 1 THEN 'validation' WHEN 2 THEN 'test' END")
    ).drop("_part")
