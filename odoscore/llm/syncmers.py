"""Document fingerprints from closed syncmers.

A k-mer of code points is an anchor if the smallest of its inner s-mers, by hash, is its first or its last one.  That is
decided by the k-mer alone, so an edit elsewhere moves no anchor.  A fingerprint holds every distinct anchor of the whole
text in the order of first positions; two fingerprints are matched on equal anchors that appear in the same order.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections import Counter
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import step_up, stored

K, S = 16, 6
_BASE, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
#: Code points that are hashed at once, documents and code points that are compared at once, and ranges of ids per
#: shuffle partition.  A document over the limit of code points is compared by itself.
_CHUNK, _ROWS, _POINTS, _RANGES = 1 << 18, 300, 1 << 21, 4


class Sketch(NamedTuple):
    """Distinct anchor hashes in ascending order, and the first position of each."""

    hashes: np.ndarray
    at: np.ndarray


def _powers(n: int) -> np.uint64:
    with np.errstate(over="ignore"):
        return np.uint64(pow(int(_BASE), n, 1 << 64))


def _window_hashes(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the S-mers and of the K-mers at every start, by doubling the width."""
    by_width, width = {1: points.astype(np.uint64) + np.uint64(1)}, 1
    while width < K:
        short = by_width[width]
        by_width[2 * width] = short[:-width] * _powers(width) + short[width:]
        width *= 2
    small = by_width[4][: len(points) - S + 1] * _powers(S - 4) + by_width[S - 4][4: 4 + len(points) - S + 1]
    return small * _MIX, by_width[K] * _MIX


def _window_least(values: np.ndarray, width: int) -> np.ndarray:
    reach, least = 1, values
    while 2 * reach <= width:
        least = np.minimum(least[:-reach], least[reach:])
        reach *= 2
    rest = width - reach
    return np.minimum(least[: len(values) - width + 1], least[rest: rest + len(values) - width + 1]) if rest else least


def anchors(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, hash) of every closed syncmer of a run of code points."""
    if len(points) < K:
        return np.empty(0, np.int64), np.empty(0, np.uint32)
    small, large = _window_hashes(points)
    least = _window_least(small, K - S + 1)
    at = np.nonzero((small[: len(least)] == least) | (small[K - S: K - S + len(least)] == least))[0]
    return at, (large[at] >> np.uint64(32)).astype(np.uint32)


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def _sketch_of(at: np.ndarray, hashes: np.ndarray, text: str) -> Sketch:
    if not len(at) and text:
        # Too short for an anchor, or without one: the whole text is its only anchor; an empty text has none.
        whole = hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=4).digest()
        at, hashes = np.zeros(1, np.int64), np.frombuffer(whole, dtype=">u4").astype(np.uint32)
    found, first = np.unique(hashes, return_index=True)
    return Sketch(found, at[first])


def sketches(texts: list[str]) -> list[Sketch]:
    """The fingerprints of many texts; short ones are hashed together."""
    out: list[Sketch] = []
    start = 0
    while start < len(texts):
        end, size = start, 0
        while end < len(texts) and (end == start or size + len(texts[end]) <= _CHUNK):
            size += len(texts[end])
            end += 1
        if size > _CHUNK:
            out.append(_long_sketch(texts[start]))
        else:
            at, hashes = anchors(_points("".join(texts[start:end])))
            begin = 0
            for text in texts[start:end]:
                low, high = np.searchsorted(at, [begin, begin + len(text) - K + 1]) if len(text) >= K else (0, 0)
                out.append(_sketch_of(at[low:high] - begin, hashes[low:high], text))
                begin += len(text)
        start = end
    return out


def _long_sketch(text: str) -> Sketch:
    """A very long text piece by piece; pieces overlap by K - 1, so every K-mer is seen once."""
    places, found = [np.empty(0, np.int64)], [np.empty(0, np.uint32)]
    for begin in range(0, len(text) - K + 1, _CHUNK):
        at, hashes = anchors(_points(text[begin: begin + _CHUNK + K - 1]))
        places.append(at + begin)
        found.append(hashes)
    return _sketch_of(np.concatenate(places), np.concatenate(found), text)


def written(sketch: Sketch) -> str:
    """Eight hexadecimal digits for each anchor, in the order of first positions."""
    return sketch.hashes[np.argsort(sketch.at)].astype(">u4").tobytes().hex()


def _longest_rise(values: np.ndarray) -> int:
    if (np.diff(values) > 0).all():
        return len(values)
    tails: list[int] = []
    for value in values.tolist():
        i = bisect_left(tails, value)
        tails[i: i + 1] = [value]
    return len(tails)


def likeness(a: Sketch, b: Sketch) -> float:
    """Share of common anchors: twice the common over all of both.

    Only common anchors in one order count: the longest run that rises in both.  Two empty texts are alike.
    """
    if not len(a.at) or not len(b.at):
        return float(len(a.at) == len(b.at))
    _, mine, other = np.intersect1d(a.hashes, b.hashes, assume_unique=True, return_indices=True)
    common = b.at[other[np.argsort(a.at[mine])]]
    return 2 * _longest_rise(common) / (len(a.at) + len(b.at))


_RESULT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
_NAMES = [f.split()[0] for f in _RESULT.split(", ")]


def _compared(ids: list, texts: list[str], following: list[str]) -> pa.RecordBatch:
    """Result rows for documents and the documents that follow them."""
    edited = [t[: len(t) - len(t) // 2] + n[: len(t) // 2] for t, n in zip(texts, following)]
    # A text mostly is its predecessor's successor: its fingerprint is made once.
    unique = list(dict.fromkeys([*texts, *following]))
    known = dict(zip(unique, sketches(unique)))
    own, changed, after = [known[t] for t in texts], sketches(edited), [known[t] for t in following]
    return pa.RecordBatch.from_arrays([
        pa.array(ids, pa.int64()), pa.array([len(t) for t in texts], pa.int64()),
        pa.array([hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in edited]),
        pa.array([written(s) for s in own]), pa.array([written(s) for s in changed]),
        pa.array([likeness(a, b) for a, b in zip(own, changed)]), pa.array([likeness(a, b) for a, b in zip(own, after)]),
    ], names=_NAMES)


def _walk(batches):
    """range, last, doc_id, text in order -> results; ``last`` rows only end a range and are no documents of it."""
    held: tuple | None = None
    for whole in batches:
        for start in range(0, whole.num_rows, _ROWS):
            part = whole.slice(start, _ROWS)
            ids, texts, following, size = [], [], [], 0
            for last, doc_id, text in zip(*(part.column(i) for i in (1, 2, 3))):
                last, doc_id, text = last.as_py(), doc_id.as_py(), text.as_py()
                if held is not None:
                    ids.append(held[0])
                    texts.append(held[1])
                    following.append(text)
                    size += len(held[1]) + len(text)
                held = None if last else (doc_id, text)
                if size > _POINTS:
                    yield _compared(ids, texts, following)
                    ids, texts, following, size = [], [], [], 0
            if ids:
                yield _compared(ids, texts, following)


def _ordered_ranges(rows: DataFrame) -> DataFrame:
    """``rows`` plus ``range``: long numbers of near-equal row counts that rise in the order of (doc_id, hash).

    Cuts at quantiles of the ids; an id at several cuts, or null, has more rows than a range should and is cut again
    into as many parts by its hashes.
    """
    ranges = _RANGES * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shares = F.array(*[F.lit(i / ranges) for i in range(1, ranges)])
    found, total, nulls = rows.agg(
        F.percentile_approx("doc_id", shares, F.lit(20 * ranges)), F.count("*"), F.count_if(F.col("doc_id").isNull())
    ).first()
    times = Counter(found or [])
    cuts = sorted(times)
    # Place of the hash in equal parts of the whole hash range; other ids of the same range come behind these parts.
    place = lambda parts: F.floor((F.col("hash") / F.lit(2.0**64) + 0.5) * parts)
    part = F.when(F.col("doc_id").isNull(), place(F.lit(max(1, -(-nulls * ranges // max(1, total))))))
    hot = [F.lit(x) for cut in cuts if times[cut] > 1 for x in (cut, times[cut])]
    if hot:
        parts = F.element_at(F.create_map(*hot), F.col("doc_id"))
        part = part.when(parts.isNotNull(), place(parts))
    at = F.when(F.col("doc_id").isNull(), F.lit(len(cuts) + 1)).otherwise(F.expr(step_up("doc_id", cuts)))
    width = 2 * ranges + 2      # more than there are parts
    return rows.withColumn("range", at.cast("long") * width + part.otherwise(F.lit(width - 1)))


def compare_with_next(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text`` -> fingerprints of each text and of its edited form, and their likeness.

    Null text is empty.  The order is by doc_id, null last, rows of one id by hash of the text and text; after the last comes
    the first, and a single row follows itself.  An empty table gives an empty result.

    Rows are cut into ranges of near-equal counts; only equal texts under one id are never parted.  The first text of a range is also
    sent to the range before it, where it ends the walk, so one exchange brings every document together with
    its follower and every range can be walked, and walked again, by itself.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    ranged = _ordered_ranges(rows.withColumn("hash", F.xxhash64("text")))
    firsts = stored(ranged.groupBy("range").agg(F.min(F.struct("doc_id", "hash")).alias("first")))
    before = F.coalesce(F.lag("range").over(Window.orderBy("range")), F.max("range").over(Window.partitionBy()))
    # One row per range: its number is set by the shuffle partitions, not by the data.
    ends = F.broadcast(firsts.select("range", "first", before.alias("before")))
    starts = ranged.join(ends, "range").where(F.struct("doc_id", "hash").eqNullSafe(F.col("first")))
    ending = starts.groupBy("before").agg(F.min("text").alias("text"))
    both = ranged.select("range", F.lit(False).alias("last"), "doc_id", "text", "hash").union(
        ending.select(F.col("before").alias("range"), F.lit(True), F.lit(None).cast("long"), "text", F.lit(None).cast("long"))
    )
    order = ["range", "last", F.col("doc_id").asc_nulls_last(), "hash", "text"]
    return both.repartition("range").sortWithinPartitions(*order).mapInArrow(_walk, _RESULT)
