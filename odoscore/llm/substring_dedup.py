"""Substring deduplication over sliding spans of sentences.

From each sentence on and up to each sentence, the shortest run of at least LEAST_SENTENCES sentences and LEAST_WORDS
words is hashed.  Both kinds together cover every sentence of any repeated run of that length: a sentence whose shortest
run leaves the repeated run lies in the shortest run that ends with it.  The hashes are joined globally; a span that a document
with a smaller id has too, or that comes again within its document, is a repeat, and the sentences it covers are removed.
"""

from __future__ import annotations

import re
import zlib

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored, without

LEAST_SENTENCES, LEAST_WORDS = 2, 12
#: A sentence of more words is divided after words picked by their hash, about one in LONG_BREAK.
LONG_SENTENCE, LONG_BREAK = 40, 8
_END = re.compile(r"[.!?]+\s+|\n\s*")
_TOKEN = re.compile(r"\S+\s*")


def sentences(text: str) -> list[tuple[int, int, str, int]]:
    """(start, end, normalized words, number of words); the pieces cover the text without gaps."""
    out, at = [], 0
    for end in [*(m.end() for m in _END.finditer(text)), len(text)]:
        if end == at:
            continue
        words = text[at:end].lower().split()
        if len(words) <= LONG_SENTENCE:
            out.append((at, end, " ".join(words), len(words)))
        else:
            first, start = 0, at
            for i, m in enumerate(_TOKEN.finditer(text, at, end)):
                if i + 1 < len(words) and zlib.crc32(words[i].encode("utf-8", "surrogatepass")) % LONG_BREAK == 0:
                    out.append((start, m.end(), " ".join(words[first: i + 1]), i + 1 - first))
                    first, start = i + 1, m.end()
            out.append((start, end, " ".join(words[first:]), len(words) - first))
        at = end
    return out


def spans(pieces: list[tuple[int, int, str, int]]) -> list[tuple[int, int, bytes]]:
    """(first sentence, number of sentences, 128-bit hash) from every sentence that starts a long enough run."""
    kept = [i for i, p in enumerate(pieces) if p[3]]
    encoded = [pieces[i][2].encode("utf-8", "surrogatepass") for i in kept]
    counts = [pieces[i][3] for i in kept]
    out, end, words = [], 0, 0
    for begin in range(len(kept)):
        if end < begin:
            end, words = begin, 0
        while end < len(kept) and (end - begin < LEAST_SENTENCES or words < LEAST_WORDS):
            words += counts[end]
            end += 1
        if end - begin < LEAST_SENTENCES or words < LEAST_WORDS:
            break
        out.append((kept[begin], kept[end - 1] + 1 - kept[begin], xxhash.xxh3_128_digest(b"\x1f".join(encoded[begin:end]))))
        words -= counts[begin]
    return out


def runs(pieces: list[tuple[int, int, str, int]]) -> list[tuple[int, int, bytes]]:
    """Those of ``spans`` and the shortest long enough run up to every sentence, in order, each once."""
    found = spans(pieces)
    known = {(first, n) for first, n, _ in found}
    kept = [i for i, p in enumerate(pieces) if p[3]]
    begin, words, more = 0, 0, []
    for end, last in enumerate(kept):
        words += pieces[last][3]
        while end - begin >= LEAST_SENTENCES and words - pieces[kept[begin]][3] >= LEAST_WORDS:
            words -= pieces[kept[begin]][3]
            begin += 1
        first, n = kept[begin], last + 1 - kept[begin]
        if end + 1 - begin >= LEAST_SENTENCES and words >= LEAST_WORDS and (first, n) not in known:
            encoded = (pieces[i][2].encode("utf-8", "surrogatepass") for i in kept[begin: end + 1])
            more.append((first, n, xxhash.xxh3_128_digest(b"\x1f".join(encoded))))
    return sorted([*found, *more]) if more else found


def _texts(batches):
    for batch in batches:
        for start in range(0, batch.num_rows, 300):
            part = batch.slice(start, 300)
            yield part, part.column(part.schema.get_field_index("text")).to_pylist()


def span_table(docs: DataFrame) -> DataFrame:
    """doc_id, doc_hash, first, n, h1, h2, again: the spans of every document; ``again`` marks repeats within it."""

    def run(batches):
        for part, texts in _texts(batches):
            ids = part.column(part.schema.get_field_index("doc_id")).to_pylist()
            columns: list[list] = [[] for _ in range(5)]
            hashes = bytearray()
            for doc_id, text in zip(ids, texts):
                text, seen = text or "", set()
                found = runs(sentences(text))
                mark = xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass"), 42)
                mark -= (mark >> 63) << 64
                for first, n, digest in found:
                    for column, value in zip(columns, (doc_id, mark, first, n, digest in seen)):
                        column.append(value)
                    hashes += digest
                    seen.add(digest)
            pairs = pa.py_buffer(bytes(hashes))
            both = pa.Array.from_buffers(pa.int64(), len(hashes) // 8, [None, pairs])
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.bool_())
            ours = [pa.array(c, k) for c, k in zip(columns, kinds)]
            even = pa.array(range(0, len(both), 2), pa.int64())
            odd = pa.array(range(1, len(both), 2), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*ours[:4], both.take(even), both.take(odd), ours[4]], names=["doc_id", "doc_hash", "first", "n", "h1", "h2", "again"]
            )

    schema = "doc_id long, doc_hash long, first int, n int, h1 long, h2 long, again boolean"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)


def repeated_spans(table: DataFrame) -> DataFrame:
    """(doc_id, doc_hash, first, n, lowest) of the spans to remove; ``lowest`` is the first document that has it, null for
    repeats within the document.  ``table`` is read three times, so it should be stored.

    Counting hashes combines before the shuffle.  A hash that a third of all documents share is one row on one
    side of the join and many on the other, which the adaptive skew join divides.
    """
    once = table.where("NOT again")
    shared = once.groupBy("h1", "h2").agg(F.min("doc_id").alias("lowest"), F.max("doc_id").alias("highest"), F.count("*").alias("rows"))
    # A null id comes after all others.
    shared = shared.where("lowest IS NOT NULL AND rows > 1").select("h1", "h2", "lowest")
    columns = ["doc_id", "doc_hash", "first", "n"]
    later = once.join(shared, ["h1", "h2"]).where("doc_id > lowest OR doc_id IS NULL").select(*columns, "lowest")
    return table.where("again").select(*columns, F.lit(None).cast("long").alias("lowest")).union(later)


ADDED = ["n_sentences", "n_removed", "removed_spans", "first_doc_ids", "deduped"]


def substring_dedup(docs: DataFrame, keep_text: bool = False) -> DataFrame:
    """``docs`` plus ``n_sentences``, ``n_removed``, ``removed_spans`` (code points, end exclusive),
    ``first_doc_ids`` (where spans removed from this document come first; null if nothing was removed) and ``deduped`` text.

    ``deduped`` is null where nothing was removed, unless ``keep_text``: then ``text`` itself is replaced.  Rows with one doc_id
    count as one document: a span they share is no repeat, and repeated rows get equal results.  A null id comes after all
    others, and rows with null ids do not dedup each other.  Null and empty texts have no sentences.
    """
    docs = without(docs, ADDED)
    table = stored(span_table(docs))
    lists = repeated_spans(table).groupBy("doc_id", "doc_hash").agg(
        F.collect_set(F.struct("first", "n")).alias("__spans"), F.sort_array(F.collect_set("lowest")).alias("__firsts"),
    )
    lists = lists.select(F.col("doc_id").alias("__id"), F.col("doc_hash").alias("__hash"), "__spans", "__firsts")
    mark = F.xxhash64(F.coalesce("text", F.lit("")))
    marked = docs.join(lists, F.col("doc_id").cast("long").eqNullSafe(F.col("__id")) & (mark == F.col("__hash")), "left")
    columns = [c for c in docs.columns]
    kept = [c for c in columns if keep_text or c != "text"]

    def run(batches):
        for part, texts in _texts(batches):
            rows, out_texts = [], []
            for text, found in zip(texts, part.column(part.schema.get_field_index("__spans")).to_pylist()):
                pieces = sentences(text or "")
                gone = {i for s in found or () for i in range(s["first"], s["first"] + s["n"])}
                cut: list[list[int]] = []
                for i in sorted(gone):
                    start, end = pieces[i][:2]
                    if cut and cut[-1][1] == start:
                        cut[-1][1] = end
                    else:
                        cut.append([start, end])
                rest = "".join(text[s:e] for i, (s, e, _, _) in enumerate(pieces) if i not in gone) if gone else None
                rows.append((len(pieces), len(gone), cut, rest))
                out_texts.append(text if rest is None else rest)
            ours = {c: part.column(part.schema.get_field_index(c)) for c in kept}
            if keep_text:
                ours["text"] = pa.array(out_texts, pa.string())
            kinds = (pa.int32(), pa.int32(), pa.list_(pa.list_(pa.int32())), pa.string())
            added = [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)]
            added.insert(3, part.column(part.schema.get_field_index("__firsts")))
            yield pa.RecordBatch.from_arrays([*ours.values(), *added], names=[*ours, *ADDED])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields if f.name in kept]
    schema = ", ".join([*fields, "n_sentences int, n_removed int, removed_spans array<array<int>>, first_doc_ids array<long>, deduped string"])
    return marked.drop("__id", "__hash").mapInArrow(run, schema)
