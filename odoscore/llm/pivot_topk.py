"""Exact top-k inner products by pivot-table elimination.

Every vector keeps its distances to a table of pivots.  By the triangle inequality |d(q, p) - d(x, p)| bounds
d(q, x) from below for each pivot p, and so the inner product (|q|^2 + |x|^2 - d(q, x)^2) / 2 from above.  Vectors
are packed into blocks of one pivot cell with the range of their distances.  A query first meets a block of
its own cell; what it finds there rules out whole blocks by their ranges.  In the blocks that remain,
candidates are taken in the order of their bounds until the next bound is below the k-th score.

Pivots are fitted on a bounded sample; every vector is in the table, and the bounds are exact for all of them.
Queries meet rows in blocks: a pair of blocks is a row only if its ranges allow a better score.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

SAMPLE, PIVOTS = 4096, 32
BLOCK_ROWS, QUERY_ROWS, CHUNK, PIVOT_STEP = 4096, 2048, 64, 8
#: Vectors at least this long take no part: the product of two might not fit a long.
LONGEST = float(1 << 31) - 4096
#: Distances are rounded to double; bounds are loosened by this share so that rounding cannot cut a candidate.
_SLACK = 1e-9


def usable(vector: Column) -> Column:
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(True))


def choose_pivots(sample: np.ndarray, n: int) -> np.ndarray:
    """Farthest-first traversal: each pivot is the sample vector farthest from the ones before."""
    chosen = [int(np.argmax(((sample - sample.mean(axis=0)) ** 2).sum(axis=1)))]
    nearest = ((sample - sample[chosen[0]]) ** 2).sum(axis=1)
    while len(chosen) < min(n, len(sample)) and nearest.max() > 0:
        chosen.append(int(np.argmax(nearest)))
        nearest = np.minimum(nearest, ((sample - sample[chosen[-1]]) ** 2).sum(axis=1))
    return sample[chosen]


def _distances(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.stack([np.sqrt(((vectors - p).astype(np.float64) ** 2).sum(axis=1)) for p in pivots], axis=1)


def _matrix(column: pa.ChunkedArray | pa.Array, rows: int) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(rows, -1)


def _indexed(rows: DataFrame, pivots: dict[int, np.ndarray]) -> DataFrame:
    """uid, vec_id, dim, v -> the same plus the pivot cell and the distances to all pivots."""

    def run(batches):
        for batch in batches:
            table = pa.Table.from_batches([batch])
            for dim in set(table.column("dim").to_pylist()):
                part = table.filter(pa.compute.equal(table.column("dim"), dim)) if dim is not None else table
                vectors = _matrix(part.column("v"), part.num_rows)
                own = pivots.get(dim)
                if own is None:
                    own = np.zeros((1, dim), dtype=np.int64)
                distances = _distances(vectors, own)
                cells = distances.argmin(axis=1).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(cells) + 1, dtype=np.int32) * len(own)), pa.array(distances.ravel()))
                out = part.append_column("cell", pa.array(cells)).append_column("d", lists)
                yield from out.combine_chunks().to_batches()

    import pyarrow.compute  # noqa: F401

    return rows.mapInArrow(run, "uid long, vec_id long, dim int, v array<long>, cell int, d array<double>")


_BLOCK = (
    "dim int, cell int, block long, ids binary, uids binary, vectors binary, distances binary, floors binary, "
    "low array<double>, high array<double>, norm double, needed double"
)


def _blocks(dealt: DataFrame) -> DataFrame:
    """Rows with ``dim``, ``cell``, ``block`` and ``floor`` -> one row per block with its vectors and its ranges."""

    def pack(table: pa.Table) -> pa.Table:
        n = table.num_rows
        vectors, distances = _matrix(table.column("v"), n), _matrix(table.column("d"), n)
        ids, uids, floors = (table.column(c).to_numpy() for c in ("vec_id", "uid", "floor"))
        first = [table.column(c)[0].as_py() for c in ("dim", "cell", "block")]
        norm = float((vectors.astype(np.float64) ** 2).sum(axis=1).max())
        stored_arrays = [a.tobytes() for a in (ids, uids, vectors, distances, floors)]
        row = [*first, *stored_arrays, distances.min(axis=0).tolist(), distances.max(axis=0).tolist(), norm, float(floors.min())]
        names = [f.split()[0] for f in _BLOCK.split(", ")]
        kinds = [pa.int32(), pa.int32(), pa.int64(), *[pa.binary()] * 5, pa.list_(pa.float64()), pa.list_(pa.float64()), pa.float64(), pa.float64()]
        return pa.table({name: pa.array([value], kind) for name, value, kind in zip(names, row, kinds)})

    return dealt.groupBy("dim", "cell", "block").applyInArrow(pack, _BLOCK)


def _by_cell(indexed: DataFrame, rows: int) -> DataFrame:
    """Blocks of about ``rows`` vectors of one cell; a cell of any size, equal vectors too, is divided by hash."""
    counts = stored(indexed.groupBy("dim", "cell").agg(F.ceil(F.count("*") / rows).alias("blocks")))
    dealt = indexed.join(counts, ["dim", "cell"]).withColumn("block", F.pmod(F.xxhash64("uid"), F.col("blocks"))).drop("blocks")
    return _blocks(dealt.withColumn("floor", F.lit(float("-inf"))))


def _by_group(asked: DataFrame, rows: int) -> DataFrame:
    """Blocks of about ``rows`` queries; cells follow each other, so a block spans few of them (its ``cell`` is 0)."""
    before = Window.partitionBy("dim").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    counts = asked.groupBy("dim", "cell").agg(F.count("*").alias("n")).withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0)))
    place = F.floor((F.col("start") + F.pmod(F.xxhash64("uid"), F.col("n"))) / rows)
    dealt = asked.join(stored(counts), ["dim", "cell"]).withColumn("block", place).drop("n", "start")
    return _blocks(dealt.withColumn("cell", F.lit(0)))


class Block:
    def __init__(self, dim: int, ids: bytes, uids: bytes, vectors: bytes, distances: bytes):
        self.ids, self.uids = np.frombuffer(ids, np.int64), np.frombuffer(uids, np.int64)
        self.vectors = np.frombuffer(vectors, np.int64).reshape(len(self.ids), dim)
        self.distances = np.frombuffer(distances, np.float64).reshape(len(self.ids), -1).T.copy()
        self.norms = (self.vectors.astype(np.float64) ** 2).sum(axis=1)


def best_of(queries: Block, at: int, rows: Block, k: int, floor: float) -> list[tuple[int, int]]:
    """The (score, vec_id) of a query that may be among its k best: those in this block not below ``floor``."""
    open_rows = np.nonzero(rows.uids != queries.uids[at])[0]
    gap, bound = np.zeros(len(open_rows)), np.empty(0)
    # A few pivots at a time: rows that these rule out need no others.
    for first in range(0, len(rows.distances), PIVOT_STEP):
        for own, others in zip(queries.distances[first: first + PIVOT_STEP, at], rows.distances[first: first + PIVOT_STEP]):
            np.maximum(gap, np.abs(others[open_rows] - own), out=gap)
        bound = (queries.norms[at] + rows.norms[open_rows] - (gap * (1 - _SLACK)) ** 2) / 2
        bound += np.abs(bound) * _SLACK + 1e-6
        kept = bound >= floor
        if not kept.all():
            open_rows, gap, bound = open_rows[kept], gap[kept], bound[kept]
    order = np.argsort(-bound, kind="stable")
    open_rows, bound = open_rows[order], bound[order]
    found: list[tuple[int, int]] = []
    start, size = 0, CHUNK
    while start < len(open_rows):
        if len(found) >= k and bound[start] < found[k - 1][0]:
            break
        part = open_rows[start: start + size]
        start, size = start + size, 2 * size
        scores = rows.vectors[part] @ queries.vectors[at]
        good = scores >= (max(floor, found[k - 1][0]) if len(found) >= k else floor)
        if len(scores) > 4 * k and good.sum() > 4 * k:
            # Ties with the k-th score of this part stay.
            good &= scores >= np.partition(scores, len(scores) - k)[len(scores) - k]
        found = sorted([*found, *zip(scores[good].tolist(), rows.ids[part[good]].tolist())], key=lambda f: (-f[0], f[1]))[:k]
    return found


def exact_top_k(vectors: DataFrame, is_query: Column, k: int = 5, scale: int = 256, vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score) over integer vectors floor(scale * x): the k best of each query, ties to smaller ids.

    Vectors that are null or hold null or non-finite components, rows without an id, and vectors of a length of 2^31 and more after
    scaling (whose scores may leave the range of a long) take no part.  A query is a row;
    its own row is no candidate, a repeated row with the same id is one.  Vectors of different lengths do not
    meet.  Fewer candidates than k give fewer ranks; an empty table gives an empty result.
    """
    doubles = F.col(vector_col).cast("array<double>")
    square = F.aggregate(doubles, F.lit(0.0), lambda total, x: total + (x * scale) * (x * scale))
    valid = vectors.where(usable(doubles) & (F.size(vector_col) > 0) & F.col("vec_id").isNotNull()).where(square < LONGEST * LONGEST)
    rows = valid.select(
        F.monotonically_increasing_id().alias("uid"), F.col("vec_id").cast("long").alias("vec_id"),
        F.size(vector_col).cast("int").alias("dim"), F.transform(doubles, lambda x: F.floor(x * scale)).alias("v"),
    )
    n = valid.count()
    share = min(1.0, 2 * SAMPLE / max(1, n))
    picked = rows.sample(fraction=share, seed=3) if share < 1 else rows
    by_dim: dict[int, list] = {}
    for dim, v in picked.select("dim", "v").limit(SAMPLE).collect():
        by_dim.setdefault(dim, []).append(v)
    pivots = {dim: choose_pivots(np.array(sample, dtype=np.int64), PIVOTS) for dim, sample in by_dim.items()}
    indexed = stored(_indexed(rows, pivots))
    data, asked = stored(_by_cell(indexed, BLOCK_ROWS)), indexed.where(is_query)
    arrays = ["ids", "uids", "vectors", "distances"]

    def sides(batch: pa.RecordBatch):
        for row in batch.to_pylist():
            queries = Block(row["dim"], *(row[f"q_{c}"] for c in arrays))
            yield queries, np.frombuffer(row["q_floors"], np.float64), Block(row["dim"], *(row[c] for c in arrays))

    def renamed(blocks: DataFrame) -> DataFrame:
        return blocks.select("dim", *[F.col(c).alias(f"q_{c}") for c in blocks.columns if c != "dim"])

    def floors(batches):
        for batch in batches:
            for queries, _, block in sides(batch):
                best = [best_of(queries, i, block, k, -np.inf) for i in range(len(queries.ids))]
                tops = [float(b[k - 1][0]) if len(b) >= k else -np.inf for b in best]
                yield pa.RecordBatch.from_arrays([pa.array(queries.uids), pa.array(tops, pa.float64())], names=["uid", "floor"])

    # One block of a query's own cell tells the k-th score that others must reach.
    own = renamed(_by_cell(asked, QUERY_ROWS)).withColumnRenamed("q_cell", "cell")
    home = own.join(data.where("block = 0").select("dim", "cell", *arrays), ["dim", "cell"])
    known = stored(home.mapInArrow(floors, "uid long, floor double"))
    queries = renamed(stored(_by_group(asked.join(known, "uid", "left").withColumn("floor", F.coalesce("floor", F.lit(float("-inf")))), QUERY_ROWS)))

    # Ranges against ranges: a pair of blocks is dropped if no vector in it can reach the lowest score needed.
    gaps = F.zip_with(
        F.zip_with("q_low", "high", lambda a, b: a - b), F.zip_with("low", "q_high", lambda a, b: a - b), lambda a, b: F.greatest(a, b, F.lit(0.0))
    )
    gap = F.array_max(gaps) * (1 - _SLACK)
    bound = (F.col("q_norm") + F.col("norm") - gap * gap) / 2
    # Block ranges are dealt over enough keys that no task holds more than some hundreds of them.
    spread = F.lit(n // (256 * BLOCK_ROWS) + 1)
    ranges = data.select("dim", "cell", "block", "low", "high", "norm", F.pmod(F.xxhash64("cell", "block"), spread.cast("long")).alias("part"))
    asked_ranges = queries.select("dim", "q_block", "q_low", "q_high", "q_norm", "q_needed")
    asked_ranges = asked_ranges.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), spread.cast("long") - 1)))
    pairs = ranges.join(asked_ranges, ["dim", "part"])
    pairs = pairs.where(bound + F.abs(bound) * _SLACK + 1e-6 >= F.col("q_needed")).select("dim", "cell", "block", "q_block")
    # Blocks of rows come last: there are many of them, while all queries may be in one block.
    asked_pairs = pairs.join(queries.select("dim", "q_block", "q_floors", *[f"q_{c}" for c in arrays]), ["dim", "q_block"])
    met = asked_pairs.join(data.select("dim", "cell", "block", *arrays), ["dim", "cell", "block"])

    def search(batches):
        for batch in batches:
            for queries, least, block in sides(batch):
                out = []
                for i in range(len(queries.ids)):
                    best = best_of(queries, i, block, k, least[i])
                    out += [(int(queries.uids[i]), int(queries.ids[i]), vec_id, score) for score, vec_id in best]
                columns = list(zip(*out)) if out else [[]] * 4
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["uid", "query_id", "vec_id", "score"])

    partial = met.mapInArrow(search, "uid long, query_id long, vec_id long, score long")
    order = Window.partitionBy("uid").orderBy(F.desc("score"), "vec_id")
    ranked = partial.withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
