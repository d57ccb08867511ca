"""SimHash near-duplicates: fingerprints linked exactly by vantage-point trees.

Two 64-bit fingerprints that differ in at most T bits differ in at most T // 2 bits of one of their halves.  Each
half gets a vantage-point tree under the Hamming distance.  Its upper levels are built from a bounded
sample of fingerprints and route every fingerprint to its home shard, and as a visitor to each shard that its
ball overlaps: by the triangle inequality the inner branch cannot hold a partner if d > mu + radius, nor the
outer one if d <= mu - radius.  Inside a shard the same pruning goes on until few fingerprints are left;
those are compared in full.  Shards over a size limit are divided into (home part, visitor part) tasks, so
no pair is lost and no task holds a whole dense region.  Tasks return spanning stars, never all pairs.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import set_aside, stored
from .components import components, spanning_stars

BITS, HALF = 64, 32
SHINGLE = 3
#: Fingerprints that the upper tree levels are fitted on; every fingerprint is indexed whatever their number.
SAMPLE = 50_000
#: Fingerprints that a shard is meant to have at home, and the most of either role that one task gets.
SHARD_ROWS, TASK_ROWS = 20_000, 60_000
#: A fingerprint with at least this share of all rows is hot; there can be no more than one over the share of them.
HOT_SHARE = 0.001
_LEAF, _BLOCK = 256, 4096


def fingerprint(text: str | None) -> int:
    """Bit i is set if it is set in over half of the shingle hashes; 0 without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if len(words) < SHINGLE:
        shingles = [b" ".join(words)] if words else []
    else:
        shingles = list(map(b" ".join, zip(*(words[i:] for i in range(SHINGLE)))))
    votes = np.zeros(BITS, dtype=np.int64)
    for start in range(0, len(shingles), 1 << 15):
        part = shingles[start: start + (1 << 15)]
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, part, repeat(42)), dtype="<u8", count=len(part))
        votes += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > len(shingles), bitorder="little").view("<u8")[0])


def with_fingerprint(docs: DataFrame, name: str = "fp", keep_text: bool = True) -> DataFrame:
    """``docs`` plus the fingerprint of ``text`` as a signed long; null text has none of the words."""
    kept = [c for c in docs.columns if c != name and (keep_text or c != "text")]
    schema = docs.select([F.col(f"`{c}`") for c in kept]).withColumn(name, F.lit(0).cast("long")).schema

    def run(batches):
        for whole in batches:
            for start in range(0, whole.num_rows, 500):
                batch = whole.slice(start, 500)
                texts = batch.column(batch.schema.get_field_index("text"))
                values = np.array([fingerprint(t.as_py()) for t in texts], dtype=np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(batch.schema.get_field_index(c)) for c in kept), pa.array(values)], names=[*kept, name]
                )

    return docs.mapInArrow(run, schema)


def _half(values: np.ndarray, half: int) -> np.ndarray:
    return ((values >> np.uint64(HALF * half)) & np.uint64((1 << HALF) - 1)).astype(np.uint32)


def _best_split(points: np.ndarray, radius: int, rng) -> tuple[int, int] | None:
    """(vantage point, mu) whose border band holds the fewest of the points, among a few near-even ones."""
    best = None
    for vantage in points[rng.integers(0, len(points), 12)]:
        counts = np.bincount(np.bitwise_count(points ^ vantage), minlength=HALF + 2)
        inner = np.cumsum(counts)
        for mu in range(HALF):
            even = min(inner[mu], len(points) - inner[mu])
            if even < len(points) // 4:
                continue
            band = counts[max(0, mu - radius + 1): mu + radius + 1].sum()
            score = band / len(points) + 0.5 - even / len(points)
            if best is None or score < best[0]:
                best = (score, int(vantage), mu)
    return best and best[1:]


@dataclass
class Tree:
    """Inner nodes are (vantage, mu, inside, outside); a leaf is its shard number."""

    root: object
    radius: int
    leaves: int

    def route(self, points: np.ndarray):
        """(shard, row numbers, whether the shard is their home) for each shard that has any."""
        every = np.arange(len(points))
        todo = [(self.root, every, np.ones(len(points), dtype=bool))]
        while todo:
            node, rows, home = todo.pop()
            if not len(rows):
                continue
            if isinstance(node, int):
                yield node, rows, home
                continue
            vantage, mu, inside, outside = node
            distance = np.bitwise_count(points[rows] ^ np.uint32(vantage)).astype(np.int16)
            for child, near, own in (
                (inside, distance <= mu + self.radius, distance <= mu), (outside, distance > mu - self.radius, distance > mu),
            ):
                todo.append((child, rows[near], (home & own)[near]))


def build_tree(sample: np.ndarray, leaves: int, radius: int, seed: int = 7) -> Tree:
    rng, count = np.random.default_rng(seed), 0
    most = max(8, len(sample) // max(1, leaves))

    def grow(points: np.ndarray):
        nonlocal count
        split = _best_split(points, radius, rng) if len(points) > most and leaves > 1 else None
        if split is None:
            count += 1
            return count - 1
        vantage, mu = split
        inner = np.bitwise_count(points ^ np.uint32(vantage)) <= mu
        return vantage, mu, grow(points[inner]), grow(points[~inner])

    return Tree(grow(sample), radius, count)


def _compare(home: np.ndarray, visitors: np.ndarray, limit: int, found: list) -> None:
    for i in range(0, len(home), _LEAF):
        for j in range(0, len(visitors), _BLOCK):
            h, v = home[i: i + _LEAF], visitors[j: j + _BLOCK]
            close = (np.bitwise_count(h[:, None] ^ v[None, :]) <= limit) & (h[:, None] < v[None, :])
            if close.any():
                x, y = np.nonzero(close)
                found.append(spanning_stars(h[x], v[y]))


def near_stars(home: np.ndarray, visitors: np.ndarray, half: int, limit: int, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning stars of the pairs (home, visitor) at most ``limit`` bits apart and at most ``radius`` in this half."""
    rng, found = np.random.default_rng(11), []
    todo = [(home, visitors, _half(home, half), _half(visitors, half))]
    while todo:
        home, visitors, hh, vh = todo.pop()
        if not len(home) or not len(visitors):
            continue
        split = _best_split(hh, radius, rng) if len(home) > _LEAF and len(visitors) > _LEAF else None
        if split is None:
            _compare(home, visitors, limit, found)
            continue
        vantage, mu = np.uint32(split[0]), split[1]
        dh = np.bitwise_count(hh ^ vantage).astype(np.int16)
        dv = np.bitwise_count(vh ^ vantage).astype(np.int16)
        for own, near in ((dh <= mu, dv <= mu + radius), (dh > mu, dv > mu - radius)):
            todo.append((home[own], visitors[near], hh[own], vh[near]))
    if not found:
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    return spanning_stars(np.concatenate([a for a, _ in found]), np.concatenate([b for _, b in found]))


def near_edges(prints: DataFrame, limit: int = 3, task_rows: int = TASK_ROWS, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Distinct fingerprints (``fp``, stored) -> edges (a, b) that connect exactly what lies within ``limit`` bits."""
    n, radius = prints.count(), limit // 2
    fraction = min(1.0, 2 * SAMPLE / max(1, n))
    picked = prints.sample(fraction=fraction, seed=5) if fraction < 1 else prints
    sample = np.array([r[0] for r in picked.limit(SAMPLE).collect()], dtype=np.int64).view(np.uint64)
    trees = [build_tree(_half(sample, half), -(-n // shard_rows), radius) for half in (0, 1)]

    def route(batches):
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False)
            for half, tree in enumerate(trees):
                for shard, rows, home in tree.route(_half(values.view(np.uint64), half)):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(rows), 2 * shard + half, np.int32)), pa.array(values[rows]), pa.array(home)],
                        names=["shard", "fp", "home"],
                    )

    routed = stored(prints.select("fp").mapInArrow(route, "shard int, fp long, home boolean"))
    counts = routed.groupBy("shard").agg(
        F.ceil(F.sum(F.col("home").cast("long")) / task_rows).alias("nh"), F.ceil(F.count("*") / task_rows).alias("nv")
    )
    part = lambda n: F.pmod(F.xxhash64("fp"), F.greatest(F.col(n), F.lit(1)))
    one = (F.col("nh") <= 1) & (F.col("nv") <= 1)
    task = lambda h, v, role: F.struct((h * F.col("nv") + v).cast("long").alias("task"), F.lit(role).alias("role"))
    as_visitor = F.transform(F.sequence(F.lit(0).cast("long"), F.col("nh") - 1), lambda i: task(i, part("nv"), 2))
    as_home = F.transform(F.sequence(F.lit(0).cast("long"), F.col("nv") - 1), lambda j: task(part("nh"), j, 1))
    nothing = F.array().cast("array<struct<task:bigint,role:int>>")
    tasks = F.when(one, F.array(F.struct(F.lit(0).cast("long").alias("task"), F.when(F.col("home"), 3).otherwise(2).alias("role"))))
    tasks = tasks.otherwise(F.concat(as_visitor, F.when(F.col("home"), as_home).otherwise(nothing)))
    dealt = routed.join(stored(counts.where("nh > 0")), "shard").select("shard", "fp", F.inline(tasks))

    def pairs(table: pa.Table) -> pa.Table:
        values = table.column("fp").to_numpy().view(np.uint64)
        role = table.column("role").to_numpy()
        half = table.column("shard")[0].as_py() % 2
        a, b = near_stars(values[role & 1 > 0], values[role & 2 > 0], half, limit, radius)
        return pa.table({"a": a.view(np.int64), "b": b.view(np.int64)})

    return dealt.groupBy("shard", "task").applyInArrow(pairs, "a long, b long")


def near_duplicate_groups(prints: DataFrame, limit: int = 3) -> DataFrame:
    """Rows with ``doc_id`` and ``fp`` (stored: they are read three times) -> the same rows plus ``root`` and ``component_id``.

    Fingerprints at most ``limit`` bits apart are linked; equal ones are too, that of empty texts included.
    ``component_id`` is the smallest doc_id of the component (null if all are null), ``root`` names it by a fingerprint.
    Repeated rows and repeated ids are rows like any other.  Rows of a hot fingerprint stay where they are: the at most
    1,000 such classes are sent to them.
    """
    classes = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")))
    linked = stored(components(near_edges(classes, limit)).withColumnRenamed("node", "fp"))
    grouped = classes.join(linked, "fp")
    firsts = grouped.groupBy("root").agg(F.min("first").alias("lowest"))
    moved = grouped.join(firsts, "root").select("fp", "root", "lowest")
    named = stored(classes.join(moved, "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root"),
        F.when(F.col("root").isNull(), F.col("first")).otherwise(F.col("lowest")).alias("component_id"), "n",
    ))
    hot = F.col("n") >= HOT_SHARE * (named.agg(F.sum("n")).first()[0] or 0)
    near = prints.join(F.broadcast(named.where(hot).drop("n")), "fp", "left")
    return near.where("root IS NOT NULL").unionByName(
        near.where("root IS NULL").drop("root", "component_id").join(named.where(~hot).drop("n"), "fp")
    )


def fingerprint_text(fp: str = "fp"):
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def keep_one_per_group(docs: DataFrame, limit: int = 3) -> DataFrame:
    """One row of each near-duplicate group: the one with the smallest doc_id (of equal ids, the smallest text)."""
    docs, restored = set_aside(docs, ["root", "__fp", "__kept", "__id", "__n"])
    prints = stored(with_fingerprint(docs, "__fp"))
    groups = near_duplicate_groups(prints.select("doc_id", F.col("__fp").alias("fp")), limit)
    kept = groups.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy("root").agg(
        F.first("component_id").alias("__id"), F.min("fp").alias("__fp")
    ).drop("root")
    # Both keys, so that the texts of a hot fingerprint spread.
    same = (F.col("__fp") == F.col("__kept")) & F.col("doc_id").eqNullSafe(F.col("__id"))
    rows = prints.join(kept.withColumnRenamed("__fp", "__kept"), same).drop("__kept")
    first = Window.partitionBy("__fp", "__id").orderBy(*[F.col(f"`{c}`") for c in ["text", *[c for c in docs.columns if c != "text"]]])
    return restored(rows.withColumn("__n", F.row_number().over(first)).where("__n = 1"))
