"""Best-fit packing of documents into training sequences under conflicts.

A document longer than a sequence is cut; its full pieces are sequences of their own, and the rest is packed.  Rows
are dealt to shards of bounded size by hash, and each shard is packed best-fit decreasing.  Open bins are
ordered by residual; every bin carries a bitmap of the sources it is closed to and one of the duplicate
clusters it holds.  The search starts at the tightest bin that is large enough and goes on to the next until
one is compatible, so copies of a text never share a sequence and no source takes more than its places in one.
"""

from __future__ import annotations

import re
from bisect import bisect_left, insort
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, stored, word_count

CAPACITY, PER_SOURCE = 2048, 4
#: Rows and words that a shard is meant to hold at most, on the average of the hash.
SHARD_ROWS, SHARD_WORDS = 8192, 8_000_000
_WORD = re.compile(WORD)

PIECES = (
    "doc_id long, source string, cluster long, piece int, start_word long, n_words long, "
    "bin_id string, bin_offset long, bin_residual long"
)


def pack(sizes: list[int], sources: list, clusters: list, capacity: int, per_source: int) -> tuple[list[int], list[int], list[int]]:
    """Bin and offset of every item (0 < size <= capacity, in the order given), and the residual of every bin."""
    source_bit = {s: 1 << i for i, s in enumerate(dict.fromkeys(sources))}
    repeated = [c for c, n in Counter(clusters).items() if n > 1]
    cluster_bit = {c: 1 << i for i, c in enumerate(repeated)}
    residual, closed, held, places = [], [], [], []
    open_bins: list[tuple[int, int]] = []
    bins, offsets = [], []
    for size, source, cluster in zip(sizes, sources, clusters):
        source_mask, cluster_mask = source_bit[source], cluster_bit.get(cluster, 0)
        at, target = bisect_left(open_bins, (size, -1)), None
        while at < len(open_bins):
            number = open_bins[at][1]
            if not closed[number] & source_mask and not held[number] & cluster_mask:
                target = number
                del open_bins[at]
                break
            at += 1
        if target is None:
            target = len(residual)
            residual.append(capacity)
            closed.append(0)
            held.append(0)
            places.append(Counter())
        bins.append(target)
        offsets.append(capacity - residual[target])
        residual[target] -= size
        held[target] |= cluster_mask
        places[target][source] += 1
        if places[target][source] >= per_source:
            closed[target] |= source_mask
        if residual[target]:
            insort(open_bins, (residual[target], target))
    return bins, offsets, residual


def text_cluster(text: Column | str) -> Column:
    """Documents whose lower-case words agree form a cluster; null counts as empty."""
    words = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[\x20\x09-\x0D]+", " ")
    return F.xxhash64(F.trim(words))


def _piece_text(text: str, starts: list[int] | None, first: int, n: int) -> str:
    if starts is None:
        return text
    end = starts[first + n] if first + n < len(starts) else len(text)
    return text[starts[first]: end].rstrip("\x20\t\n\v\f\r")


def pack_documents(
    docs: DataFrame, capacity: int = CAPACITY, per_source: int = PER_SOURCE, with_text: bool = False,
    shard_rows: int = SHARD_ROWS, shard_words: int = SHARD_WORDS,
) -> DataFrame:
    """One row per piece: document, words ``start_word`` to ``start_word + n_words``, its bin and place there.

    A document without words is one piece of no words with a null bin.  Null sources are one source.  Repeated
    rows are copies of each other, so they go to different bins.  The pieces of a long document may share
    a bin with nothing else (full ones) or with others (the last).  An empty table gives an empty result.
    ``with_text`` adds the text of each piece.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
        word_count("text").alias("words"), text_cluster("text").alias("cluster"),
        *([F.coalesce("text", F.lit("")).alias("text")] if with_text else []),
    )
    rows = stored(rows.withColumn("row", F.monotonically_increasing_id()))
    total = rows.agg(F.count("*").alias("n"), F.coalesce(F.sum("words"), F.lit(0)).alias("words")).first()
    shards = max(1, -(-total["n"] // shard_rows), -(-total["words"] // shard_words))
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("doc_id", "row"), F.lit(shards)))

    def run(table: pa.Table) -> pa.Table:
        columns = {c: table.column(c).to_pylist() for c in ("doc_id", "source", "words", "cluster", "row", "shard")}
        texts = table.column("text") if with_text else None
        ids, words, shard = columns["doc_id"], columns["words"], columns["shard"][0]
        rest = [w % capacity for w in words]
        order = sorted((i for i, r in enumerate(rest) if r), key=lambda i: (-rest[i], ids[i] is None, ids[i] or 0, columns["row"][i]))
        bins, offsets, residual = pack(
            [rest[i] for i in order], [columns["source"][i] for i in order], [columns["cluster"][i] for i in order], capacity, per_source
        )
        placed = dict(zip(order, zip(bins, offsets)))
        out: list[tuple] = []
        for i, w in enumerate(words):
            common = (ids[i], columns["source"][i], columns["cluster"][i])
            text = texts[i].as_py() if with_text else None
            starts = [m.start() for m in _WORD.finditer(text)] if with_text and w > capacity else None
            content = lambda first, n: (_piece_text(text, starts, first, n),) if with_text else ()  # noqa: E731, B023
            full = w // capacity
            for k in range(full):
                name = f"{shard}-{columns['row'][i]}-{k}"
                out.append((*common, k, k * capacity, capacity, name, 0, 0, *content(k * capacity, capacity)))
            if rest[i]:
                number, offset = placed[i]
                at = (full, full * capacity, rest[i], f"{shard}-{number}", offset, residual[number])
                out.append((*common, *at, *content(full * capacity, rest[i])))
            elif not full:
                out.append((*common, 0, 0, 0, None, None, None, *content(0, 0)))
        schema = pa.schema([
            ("doc_id", pa.int64()), ("source", pa.string()), ("cluster", pa.int64()), ("piece", pa.int32()), ("start_word", pa.int64()),
            ("n_words", pa.int64()), ("bin_id", pa.string()), ("bin_offset", pa.int64()), ("bin_residual", pa.int64()),
            *([("text", pa.string())] if with_text else []),
        ])
        return pa.table([pa.array([r[i] for r in out], f.type) for i, f in enumerate(schema)], schema=schema)

    return dealt.groupBy("shard").applyInArrow(run, PIECES + (", text string" if with_text else ""))
