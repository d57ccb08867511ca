"""Hard-negative mining by slot-decomposed selection.

A positive p of an anchor asks for the best negatives whose score lies between ``low`` and ``high`` per cent of its own.
The windows of one anchor overlap, so they are not searched one by one: the upper limits of its positives split the
scores into disjoint slots.  A negative falls into one slot; every task keeps the first k of each (anchor, slot), the
combination of tasks keeps the first k again, and a window's answer is the first k of its own slot and those
below it, in descending order.  What lies under a window's lower limit is at the end of that list and falls off.

Anchors meet rows in cells of a grid: a cell holds a bounded part of the rows and a bounded slab of the anchors, so no
task holds all anchors or a whole label, and a cell computes its scores as one matrix product.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored
from .pivot_topk import usable

#: Vector components of the rows and of the anchors in one cell (16 MB and 2 MB of integers).
ROW_COMPONENTS, ANCHOR_COMPONENTS = 1 << 21, 1 << 18
#: Scores computed at once.
SCORES = 1 << 21
#: Vectors at least this long take no part: a hundredfold score may not fit a long.
LONGEST = float(1 << 28)
_EXACT = float(1 << 53)


def integer_rows(vectors: DataFrame, scale: int, vector_col: str, label_col: str) -> DataFrame:
    """(uid, vec_id, label, dim, v) of the rows that take part, with v = floor(scale * x)."""
    doubles = F.col(vector_col).cast("array<double>")
    scaled = F.transform(doubles, lambda x: F.floor(F.when(F.abs(x * scale) < LONGEST, x * scale)))
    rows = vectors.where(usable(doubles) & F.col(label_col).isNotNull() & F.col("vec_id").isNotNull()).select(
        F.monotonically_increasing_id().alias("uid"), F.col("vec_id").cast("long").alias("vec_id"),
        F.col(label_col).alias("label"), F.size(vector_col).alias("dim"), scaled.alias("v"),
    )
    square = F.aggregate("v", F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double"))
    return rows.where(square < LONGEST * LONGEST)


def _matrix(table: pa.Table) -> np.ndarray:
    flat = table.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(table.num_rows, -1) if len(flat) else np.zeros((table.num_rows, 0), np.int64)


def _longest(matrix: np.ndarray) -> float:
    return float(np.sqrt((matrix.astype(np.float64) ** 2).sum(axis=1).max(initial=0.0)))


def products(anchors: np.ndarray, rows: np.ndarray):
    """Exact integer scores, some anchors at a time: (first anchor, scores).

    Sums of doubles are exact while the product of the lengths is below 2^53; beyond that integers are multiplied.
    """
    exact = _longest(anchors) * _longest(rows) < _EXACT / 2
    left, right = (anchors.astype(np.float64), rows.astype(np.float64)) if exact else (anchors, rows)
    step = max(1, SCORES // max(1, len(rows)))
    for first in range(0, len(left), step):
        yield first, (left[first: first + step] @ right.T).astype(np.int64)


def first_k(scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to the earlier place."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        above, equal = np.nonzero(scores > least)[0], np.nonzero(scores == least)[0]
        return np.concatenate([above, equal[: k - len(above)]])
    return np.arange(len(scores))


def _cells(rows: DataFrame, anchors: DataFrame, by: list[str], work, schema: str) -> DataFrame:
    """``work(anchors, rows)`` on every cell; both sides have the columns ``by`` and only equal ones meet."""
    sizes = rows.groupBy(*by).agg(F.ceil(F.count("*") * F.max("dim") / ROW_COMPONENTS).alias("parts"))
    own_sizes = anchors.groupBy(*by).agg(F.ceil(F.count("*") * F.max("dim") / ANCHOR_COMPONENTS).alias("slabs"))
    grid = stored(sizes.join(own_sizes, by).select(*by, *[F.greatest(F.col(c), F.lit(1)).alias(c) for c in ("parts", "slabs")]))

    def dealt(df: DataFrame, own: str, own_count: str, other: str, other_count: str) -> DataFrame:
        placed = df.join(grid, by).withColumn(own, F.pmod(F.xxhash64("uid"), F.col(own_count)))
        copies = F.sequence(F.lit(0).cast("long"), F.col(other_count).cast("long") - 1)
        return placed.withColumn(other, F.explode(copies)).drop("parts", "slabs")

    cell = [*by, "part", "slab"]
    # Both sides may come from one table; new names of the same columns keep them apart.
    asked = dealt(anchors, "slab", "slabs", "part", "parts")
    left = asked.select([F.col(c).alias(f"_{c}") for c in asked.columns]).toDF(*asked.columns).groupBy(*cell)
    right = dealt(rows, "part", "parts", "slab", "slabs").groupBy(*cell)
    empty = pa.schema([(f.split()[0], pa.int64()) for f in schema.split(", ")]).empty_table()

    def run(asked: pa.Table, found: pa.Table) -> pa.Table:
        if not asked.num_rows or not found.num_rows:
            return empty
        parts = [p for p in work(asked, found.sort_by("vec_id")) if len(p[0])]
        if not parts:
            return empty
        return pa.table([pa.array(np.concatenate(c).astype(np.int64)) for c in zip(*parts)], schema=empty.schema)

    return left.cogroup(right).applyInArrow(run, schema)


def _ranked(found: DataFrame, by: list[str], k: int, name: str) -> DataFrame:
    """The first k per group; the group limit works below the exchange, too."""
    order = Window.partitionBy(*by).orderBy(F.desc("score"), "vec_id")
    return found.withColumn(name, F.row_number().over(order)).where(F.col(name) <= k)


def best_positives(rows: DataFrame, anchors: DataFrame, n: int) -> DataFrame:
    """(uid of the anchor, score, vec_id, place): each anchor's first n other rows of its label."""

    def work(asked: pa.Table, found: pa.Table):
        own, ids, uids = asked.column("uid").to_numpy(), found.column("vec_id").to_numpy(), found.column("uid").to_numpy()
        for first, scores in products(_matrix(asked), _matrix(found)):
            for i, line in enumerate(scores, first):
                others = np.nonzero(uids != own[i])[0]
                best = others[first_k(line[others], n)]
                yield np.full(len(best), own[i]), line[best], ids[best]

    found = _cells(rows, anchors, ["dim", "label"], work, "uid long, score long, vec_id long")
    return _ranked(found, ["uid"], n, "place")


def slot_negatives(rows: DataFrame, anchors: DataFrame, k: int) -> DataFrame:
    """(uid, slot, score, vec_id): the first k negatives of each slot.

    ``anchors`` have ``limits``, the upper ends of their slots in descending order, and ``least``, the lowest score that
    any of their windows admits.
    """

    def work(asked: pa.Table, found: pa.Table):
        own, names = asked.column("uid").to_numpy(), found.column("vec_id").to_numpy()
        # Labels as numbers that both sides share; they may be of any type.
        both = pa.concat_tables([asked.select(["label"]), found.select(["label"])]).column("label").combine_chunks()
        codes = both.dictionary_encode().indices.to_numpy(zero_copy_only=False)
        mine, theirs = codes[: len(own)], codes[len(own):]
        limits, least = asked.column("limits").to_pylist(), asked.column("least").to_numpy()
        for first, scores in products(_matrix(asked), _matrix(found)):
            for i, line in enumerate(scores, first):
                rising = np.array(limits[i][::-1])
                open_rows = np.nonzero((theirs != mine[i]) & (line <= rising[-1]) & (line >= least[i]))[0]
                slots = len(rising) - 1 - np.searchsorted(rising, line[open_rows])
                for slot in np.unique(slots):
                    of_slot = open_rows[slots == slot]
                    best = of_slot[first_k(line[of_slot], k)]
                    yield np.full(len(best), own[i]), np.full(len(best), slot), line[best], names[best]

    found = _cells(rows, anchors, ["dim"], work, "uid long, slot long, score long, vec_id long")
    return _ranked(found, ["uid", "slot"], k, "_place").drop("_place")


def hard_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    k: int = 3,
    n_positives: int = 5,
    low: int = 50,
    high: int = 95,
    scale: int = 256,
    vector_col: str = "embedding",
    label_col: str = "label",
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Scores are integer inner products of floor(scale * x); an anchor's positives are its first ``n_positives`` other rows
    of the same label, and of each positive the first ``k`` rows of another label with ``low * positive_score <=
    100 * negative_score <= high * positive_score`` are returned.  Higher scores come first, ties by smaller
    vec_id.  ``is_anchor`` may use vec_id only.

    Rows without id, label or vector, with a null or non-finite component, or of a length of 2^28 and more after scaling
    (whose scores may leave the range of a long) take no part.  Vectors of different lengths do not meet.  A row is no
    positive of itself; a repeated row is, and repeated anchors are answered each.  A positive with a negative score has an
    empty window, an anchor alone with its label has no rows, and an empty table gives an empty result.
    """
    if not 0 < low <= high:
        raise ValueError(f"a window needs 0 < low <= high, not {low} and {high}")
    rows = stored(integer_rows(vectors, scale, vector_col, label_col))
    anchors = rows.where(is_anchor)
    positives = best_positives(rows, anchors, n_positives).where("score >= 0")
    positives = stored(positives.withColumn("upper", F.expr(f"({high} * score) div 100")).withColumnRenamed("vec_id", "positive_id"))
    slots = positives.groupBy("uid").agg(
        F.reverse(F.array_sort(F.collect_set("upper"))).alias("limits"),
        F.expr(f"({low} * min(score) + 99) div 100").alias("least"),
    )
    # At most n_positives slots of k entries per anchor.
    entry = F.struct("slot", (-F.col("score")).alias("order"), "vec_id")
    kept = slot_negatives(rows, anchors.join(slots, "uid"), k).groupBy("uid").agg(F.array_sort(F.collect_list(entry)).alias("kept"))
    asked = positives.join(slots, "uid").withColumn("slot", (F.array_position("limits", F.col("upper")) - 1).cast("long"))
    asked = asked.join(kept, "uid").join(anchors.select("uid", F.col("vec_id").alias("anchor_id")), "uid")
    window = F.slice(F.filter("kept", lambda n: n["slot"] >= F.col("slot")), 1, k)
    found = asked.select("anchor_id", "positive_id", F.col("score").alias("positive_score"), F.posexplode(window).alias("at", "n"))
    return found.select(
        "anchor_id", "positive_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("n.vec_id").alias("negative_id"),
        "positive_score", (-F.col("n.order")).alias("negative_score"),
    ).where(low * F.col("positive_score") <= 100 * F.col("negative_score"))
