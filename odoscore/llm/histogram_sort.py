"""Sharding by histogram sort: shards of near-equal bytes over rows sorted by a 60-bit key.

The rows are stored once.  Each round counts the exact bytes below candidate key boundaries in every
partition at once, and refines the candidates around the splitters that are not yet within tolerance.
When all are, one exchange moves every row to its place.  Only DataFrame functions are used.

The key is a hash of the identifying columns; its last bits come from the row's position in the stored
input, so even a row repeated a billion times can be split.  The driver sees at most
``(n_shards - 1) * 2**STEP`` counts a round, whatever the number of rows.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import step_up, stored, without

KEY_BITS = 60
SALT_BITS = 20
FIRST_STEP, STEP = 12, 8
ADDED = ["law", "shard", "slot", "grown_shard"]


def _keyed(rows: DataFrame, id_cols: list[str]) -> DataFrame:
    low = (1 << SALT_BITS) - 1
    content = F.shiftrightunsigned(F.xxhash64(*[F.col(f"`{c}`") for c in id_cols]), 64 - KEY_BITS)
    salt = F.xxhash64(F.monotonically_increasing_id()).bitwiseAND(F.lit(low))
    return rows.withColumn("__key", content.bitwiseAND(F.lit(((1 << KEY_BITS) - 1) ^ low)).bitwiseOR(salt))


def find_splitters(keyed: DataFrame, size_col: str, n_shards: int, tolerance: float) -> list[int]:
    """Ascending keys; rows below the j-th hold j/n of all bytes, within ``tolerance`` of a shard's mean.

    A splitter between two rows cannot come closer than the smaller side of the row it would have to cut.
    """
    total = keyed.agg(F.sum(size_col)).first()[0] or 0
    if not total:
        return []
    targets = {j: j * total / n_shards for j in range(1, n_shards)}
    slack = tolerance * total / n_shards
    found: dict[int, int] = {}
    # Open cells: key prefix of ``bits`` bits -> (bytes below it, the splitters that lie inside).
    bits, cells = 0, {0: (0, sorted(targets))}
    while cells:
        finer = min(KEY_BITS, bits + (FIRST_STEP if bits == 0 else STEP))
        probe = F.shiftright("__key", KEY_BITS - finer)
        narrowed = keyed if bits == 0 else keyed.where(F.shiftright("__key", KEY_BITS - bits).isin(list(cells)))
        counts = narrowed.groupBy(probe.alias("prefix")).agg(F.sum(size_col).alias("bytes"), F.count("*").alias("n"))
        inside: dict[int, list] = {}
        for prefix, size, n in counts.collect():
            inside.setdefault(prefix >> (finer - bits), []).append((prefix, size, n))
        opened: dict[int, tuple[int, list[int]]] = {}
        for parent, (below, wanted) in cells.items():
            children, at = sorted(inside[parent]), 0
            for j in wanted:
                while at + 1 < len(children) and below + children[at][1] < targets[j]:
                    below += children[at][1]
                    at += 1
                prefix, size, n = children[at]
                start, end = prefix << (KEY_BITS - finer), (prefix + 1) << (KEY_BITS - finer)
                to_start, to_end = targets[j] - below, below + size - targets[j]
                if n == 1 or finer == KEY_BITS or min(to_start, to_end) <= slack:
                    found[j] = start if to_start <= to_end else end
                else:
                    opened.setdefault(prefix, (below, []))[1].append(j)
        bits, cells = finer, opened
    return [found[j] for j in sorted(found)]


def shard_by_bytes(
    rows: DataFrame,
    n_shards: int,
    size_col: str = "size",
    id_cols: list[str] | None = None,
    tolerance: float = 1e-3,
    rows_per_cell: int = 250_000,
) -> DataFrame:
    """``rows`` plus ``law`` ('bytes'), ``shard`` (int), ``slot`` (long, gapless from 0) and a null ``grown_shard``.

    A null size counts as 0.  With no rows the result is empty; with no bytes at all every row is in shard 0.
    Rows that are equal in every identifying column are neighbours in the order and may be divided between
    shards.  Columns of the input that bear the names of the added ones are replaced.

    A shard's rows are placed by cells of about ``rows_per_cell`` rows, so no task sorts a whole shard.
    """
    rows = without(rows, [*ADDED, "__key"])
    keyed = stored(_keyed(rows.withColumn(size_col, F.coalesce(size_col, F.lit(0)).cast("long")), id_cols or rows.columns))
    n_rows = keyed.count()
    splitters = find_splitters(keyed, size_col, n_shards, tolerance)
    bounds = [0, *splitters, 1 << KEY_BITS] if splitters else [0, 1 << KEY_BITS]
    parts = max(1, math.ceil(n_rows / max(1, len(bounds) - 1) / rows_per_cell))
    placed = keyed.withColumn("shard", F.expr(step_up("__key", splitters)).cast("int"))
    place = ["shard"]
    if parts > 1:
        low, high = (F.element_at(F.lit(side), F.col("shard") + 1) for side in (bounds[:-1], bounds[1:]))
        share = (F.col("__key") - low).cast("double") / F.greatest(high - low, F.lit(1)).cast("double")
        placed = placed.withColumn("__cell", F.least(F.floor(share * parts), F.lit(parts - 1)).cast("long"))
        place = ["shard", "__cell"]
    order = ["__key", *[F.col(f"`{c}`") for c in id_cols or []]]
    sorted_rows = placed.withColumn("slot", F.row_number().over(Window.partitionBy(*place).orderBy(*order)).cast("long") - 1)
    if parts > 1:
        ahead = Window.partitionBy("shard").orderBy("__cell").rowsBetween(Window.unboundedPreceding, -1)
        starts = placed.groupBy(*place).agg(F.count("*").alias("__n"))
        starts = starts.select(*place, F.coalesce(F.sum("__n").over(ahead), F.lit(0)).alias("__start"))
        sorted_rows = sorted_rows.join(starts, place).withColumn("slot", F.col("slot") + F.col("__start"))
    return sorted_rows.select(
        *[F.col(f"`{c}`") for c in rows.columns], F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
