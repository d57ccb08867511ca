"""Byte-level BPE encoding by tree concatenation, and decoding.

A long text is halved until its leaves are short, wherever the halves fall, and the leaves are encoded in parallel.  Two
neighbours are joined by encoding a window around their seam anew: it takes a few tokens of either side and grows on
a side until that side agrees, so what lies outside stays as it is.  A side agrees at an edge

* that is a certain boundary between two pieces of the splitting pattern, whatever stands on either side of the window, or
* within a run of one class of characters, if the window's outermost token is the one that was there before.

The second holds because merges come in one order and make each token in one way: a sequence of tokens is the
encoding of its text if and only if every two neighbours are.  A run without any certain boundary, however long, is
joined by it.  Leaves and windows are encoded by the tokenizers library; its vocabulary is a parameter, never trained here.
"""

from __future__ import annotations

import json
import os
import re
import sys
import unicodedata
from array import array
from collections.abc import Iterable
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Characters of a leaf; shorter texts are encoded as they are.
LEAF = 16_384
#: Words whose encoding a worker remembers, and bytes of text that it takes at once.
WORDS, SLICE = 1 << 18, 1 << 19
#: Leaves joined by one task; a second round joins what these tasks leave of a text.
FAN = 64
#: Tokens of either side in the first window of a seam.
WINDOW = 4

# For a few numbers an array of the machine's own is quicker than numpy's.
_NATIVE = sys.byteorder == "little" and array("I").itemsize == 4

_LIBRARY_SPLITS = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}


def _letters_of_bytes() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(others)}


def check_tokenizer(path: str) -> None:
    """Raises ValueError unless joins are exact for this tokenizer.

    That needs plain byte-level splitting, added tokens that are matched as they stand, and merges whose parts are made
    before and whose results are made once.
    """
    with open(path, encoding="utf-8") as file:
        described = json.load(file)
    model, splits = described["model"], described["pre_tokenizer"] or {}
    if described["normalizer"] is not None or any(splits.get(k) != v for k, v in _LIBRARY_SPLITS.items()):
        raise ValueError("the tokenizer must split bytes by the standard pattern, without normalizing")
    odd = [model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "fuse_unk", "byte_fallback", "ignore_merges")]
    if model["type"] != "BPE" or any(odd):
        raise ValueError("the model must be plain BPE")
    for token in described["added_tokens"]:
        if token["single_word"] or token["lstrip"] or token["rstrip"] or token["normalized"]:
            raise ValueError(f"added token {token['content']!r} depends on what stands beside it")
    known = set(_letters_of_bytes())
    for merge in model["merges"]:
        left, right = merge.split(" ") if isinstance(merge, str) else merge
        if left not in known or right not in known or left + right in known:
            raise ValueError(f"merge {merge!r} is out of order or makes a token twice")
        known.add(left + right)


# Letters, numbers, white space and others of the splitting pattern; "?" where libraries might not agree on a character.
@lru_cache(maxsize=1 << 16)
def kind(character: str) -> str:
    if character in " \t\n\v\f\r":
        return "S"
    old, new = unicodedata.ucd_3_2_0.category(character), unicodedata.category(character)
    if old != new or old in ("Cn", "Cc") or old[0] == "Z" or character.isspace():
        return "?"
    return old[0] if old[0] in "LN" else "O"


def certain(before: str, after: str) -> bool:
    """Whether the pattern ends a piece between these two characters in every text."""
    left, right = kind(before), kind(after)
    if "?" in (left, right) or left in (right, "S"):
        return False
    return not (before == "'" and right == "L")


#: White space, then anything else: wherever a match ends, so does a piece, if there is no other white space in the text.
_WORD = re.compile(r"[ \t\n\r]*[^ \t\n\r]+|[ \t\n\r]+")
_OTHER_SPACE = re.compile(r"[^\S \t\n\r]")


class Vocabulary:
    """The bytes of every token; all that decoding needs."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        letters = _letters_of_bytes()
        self.bytes_of: dict[int, bytes] = {i: bytes([letters[c] for c in token]) for token, i in described["model"]["vocab"].items()}
        added = {t["id"]: t["content"] for t in described["added_tokens"]}
        self.bytes_of.update((i, content.encode()) for i, content in added.items())
        contents = sorted(added.values(), key=len, reverse=True)
        self.added = re.compile("|".join(map(re.escape, contents))) if contents else None

    def decode(self, ids: Iterable[int]) -> str:
        """Text of the tokens; bytes that are no text become U+FFFD, unknown numbers nothing."""
        found = self.bytes_of
        return b"".join([found.get(i, b"") for i in ids]).decode("utf-8", "replace")


class Codec(Vocabulary):
    def __init__(self, path: str):
        super().__init__(path)
        # Spark runs one task a core.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        # Settings for batches of equal length have no place here.
        self.library.no_truncation()
        self.library.no_padding()
        self.words: dict[str, bytes] = {}
        # Numbers take two bytes on their way between tasks where they can.
        self.node = "<u2" if max(self.bytes_of) < 1 << 16 else "<u4"

    def encode(self, text: str) -> list[int]:
        return self.library.encode(text, add_special_tokens=False).ids

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Packed numbers of each text; equal words are encoded once."""
        whole = [_OTHER_SPACE.search(t) or (self.added is not None and self.added.search(t)) for t in texts]
        split = [[t] if odd else _WORD.findall(t) for t, odd in zip(texts, whole)]
        # A text that is taken whole is no word, and is not remembered as one.
        every: set[str] = set()
        every.update(*[words for words, odd in zip(split, whole) if not odd])
        new = list(every.difference(self.words))
        alone = [t for t, odd in zip(texts, whole) if odd]
        if len(self.words) + len(new) > WORDS:
            self.words, new = {}, list(every)
        found = [_packed(e.ids) for e in self.library.encode_batch_fast([*new, *alone], add_special_tokens=False)]
        self.words.update(zip(new, found))
        others = iter(found[len(new):])
        return [next(others) if odd else b"".join([self.words[w] for w in words]) for words, odd in zip(split, whole)]

    def leaves(self, text: str, size: int) -> list[str]:
        """Halves of halves of at most ``size`` characters; no added token is cut."""
        count = 1
        while count * size < len(text):
            count *= 2
        cuts = [len(text) * i // count for i in range(1, count)]
        if self.added is not None:
            held = [m.span() for m in self.added.finditer(text)] if count > 1 else []
            for start, end in held:
                cuts = [start if start < cut < end else cut for cut in cuts]
        return [text[a:b] for a, b in zip([0, *cuts], [*cuts, len(text)])]

    def _inside(self, token: int) -> bool:
        """Whether a token begins within a character."""
        return 0x80 <= self.bytes_of[token][0] < 0xC0

    def _tail(self, ids: list[int], end: int) -> str:
        """At least the last four characters before token ``end``."""
        found = b""
        while end and len(found) < 16:
            end -= 1
            found = self.bytes_of[ids[end]] + found
        return found.decode("utf-8", "ignore")

    def _head(self, ids: list[int], start: int) -> str:
        found = b""
        while start < len(ids) and len(found) < 4:
            found += self.bytes_of[ids[start]]
            start += 1
        return found.decode("utf-8", "ignore")[:1]

    @staticmethod
    def _agrees(before: str, after: str, same_token: bool) -> bool:
        """``before`` ends at an edge, ``after`` begins there."""
        if certain(before[-1], after[0]):
            return True
        of = kind(before[-1])
        if not same_token or of == "?" or of != kind(after[0]):
            return False
        # An apostrophe with the letters behind it may be a piece of its own.
        return not (after[0] == "'" or (of == "L" and "'" in before[-4:]))

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of two neighbouring texts from theirs."""
        if not left or not right:
            return left + right
        of_left, of_right = WINDOW, WINDOW
        while True:
            i, j = max(0, len(left) - of_left), min(len(right), of_right)
            while i and self._inside(left[i]):
                i -= 1
            while j < len(right) and self._inside(right[j]):
                j += 1
            window = b"".join([self.bytes_of[t] for t in (*left[i:], *right[:j])]).decode()
            anew = self.encode(window)
            left_agrees = i == 0 or self._agrees(self._tail(left, i), window, anew[0] == left[i])
            right_agrees = j == len(right) or self._agrees(window, self._head(right, j), anew[-1] == right[j - 1])
            if left_agrees and right_agrees:
                return left[:i] + anew + right[j:]
            of_left *= 1 if left_agrees else 2
            of_right *= 1 if right_agrees else 2

    def concatenate(self, nodes: list[list[int]]) -> list[int]:
        """Neighbours are joined in pairs until one is left."""
        while len(nodes) > 1:
            nodes = [self.join(*pair) if len(pair) == 2 else pair[0] for pair in (nodes[i: i + 2] for i in range(0, len(nodes), 2))]
        return nodes[0]


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    return Codec(path)


def _packed(ids: list[int]) -> bytes:
    if _NATIVE:
        return array("I", ids).tobytes()
    return np.array(ids, dtype="<u4").tobytes()


def _unpacked(packed: bytes) -> list[int]:
    return np.frombuffer(packed, dtype="<u4").tolist()


def _slices(batch: pa.RecordBatch, column: str) -> Iterable[pa.RecordBatch]:
    """Consecutive rows of a batch with about ``SLICE`` bytes in a column."""
    start, held = 0, 0
    for i, size in enumerate(pc.binary_length(batch.column(column)).to_pylist()):
        held += size
        if held >= SLICE:
            yield batch.slice(start, i + 1 - start)
            start, held = i + 1, 0
    if start < batch.num_rows:
        yield batch.slice(start)


def _map(df: DataFrame, column: str, columns: dict[str, T.DataType], make) -> DataFrame:
    """``make(values of column)`` gives the columns beside ``row``, which passes through."""
    schema = T.StructType([df.schema["row"], *[T.StructField(name, of) for name, of in columns.items()]])

    def run(batches):
        for part in (part for batch in batches for part in _slices(batch, column)):
            arrays = make(part.column(column).to_pylist())
            yield pa.RecordBatch.from_arrays([part.column("row"), *arrays.values()], names=["row", *arrays])

    return df.mapInArrow(run, schema)


def bpe_encode(docs: DataFrame, path: str, text_col: str = "text", keep_text: bool = False) -> DataFrame:
    """``docs`` with ``n_tokens`` and ``ids``, the token numbers of the whole text as little-endian unsigned 32-bit integers.

    ``path`` is a tokenizer file of the tokenizers library, at the same place on every machine.  The numbers are those that the library
    gives for the whole text without special tokens around it; the string of an added token is that token.  A null or
    empty text has no tokens.  Texts longer than ``LEAF`` characters are halved; equal ones are encoded once.  Columns
    of the names added are replaced, all others stay (the text only with ``keep_text``); an empty table gives an empty result.
    """
    check_tokenizer(path)
    own = {"n_tokens", "ids"} | (set() if keep_text else {text_col.lower()})
    names = [c for c in docs.columns if c.lower() not in own]
    # The row passes as one column, so no name clashes with the ones used here.
    row = F.struct(*[F.col(f"`{c}`") for c in names]) if names else F.struct(F.lit(0).alias("_none"))
    held = docs.select(row.alias("row"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    short, long = held.where(F.length("text") <= LEAF), held.where(F.length("text") > LEAF)
    leaf, fan = LEAF, FAN

    def whole(texts: list[str]) -> dict[str, pa.Array]:
        return {"ids": pa.array(codec(path).encode_all(texts), pa.binary())}

    def cut(batches):
        for batch in batches:
            for mark, text in zip(batch.column("mark").to_pylist(), batch.column("text").to_pylist()):
                pieces = codec(path).leaves(text, leaf)
                columns = [pa.array([mark] * len(pieces), pa.binary()), pa.array(range(len(pieces)), pa.int64()), pa.array(pieces, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=["mark", "place", "piece"])

    def encode(batches):
        for part in (part for batch in batches for part in _slices(batch, "piece")):
            found = [np.frombuffer(b, "<u4").astype(codec(path).node).tobytes() for b in codec(path).encode_all(part.column("piece").to_pylist())]
            columns = [part.column("mark"), part.column("place"), pa.array(found, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["mark", "place", "ids"])

    def joined(table: pa.Table) -> pa.Table:
        table, own = table.sort_by("place"), codec(path)
        ids = own.concatenate([np.frombuffer(b, own.node).tolist() for b in table.column("ids").to_pylist()])
        place = pa.array([table.column("place")[0].as_py() // fan], pa.int64())
        return pa.table({"mark": table.column("mark")[:1], "place": place, "ids": pa.array([np.array(ids, own.node).tobytes()], pa.binary())})

    def widened(found: list[bytes]) -> dict[str, pa.Array]:
        return {"ids": pa.array([np.frombuffer(b, codec(path).node).astype("<u4").tobytes() for b in found], pa.binary())}

    node = "mark binary, place long, ids binary"
    marked = long.withColumn("mark", F.unhex(F.sha2("text", 256)))
    pieces = marked.select("mark", "text").mapInArrow(cut, "mark binary, place long, piece string")
    # Leaves are dealt over all tasks; those of equal texts meet before they are encoded.
    nodes = pieces.groupBy("mark", "place").agg(F.first("piece").alias("piece")).mapInArrow(encode, node)
    nodes = nodes.groupBy("mark", F.expr(f"place div {fan}").alias("of")).applyInArrow(joined, node)
    nodes = nodes.groupBy("mark").applyInArrow(joined, node).select("mark", F.col("ids").alias("nodes"))
    # The numbers of all long texts are no side to broadcast, however few they are in a small table.
    met = marked.select("row", "mark").join(nodes.hint("merge"), "mark").drop("mark")
    encoded = _map(short, "text", {"ids": T.BinaryType()}, whole).unionByName(_map(met, "nodes", {"ids": T.BinaryType()}, widened))
    out = [F.col(f"row.`{c}`").alias(c) for c in names]
    return encoded.select(*out, F.expr("octet_length(ids) div 4").cast("long").alias("n_tokens"), "ids")


def bpe_decode(encoded: DataFrame, path: str, ids_col: str = "ids") -> DataFrame:
    """``encoded`` with ``decoded``, the text of its token numbers, special tokens included.

    Bytes that are no text become U+FFFD, numbers that the vocabulary lacks nothing; null numbers give an empty text.
    A column of that name is replaced.
    """
    names = [c for c in encoded.columns if c.lower() != "decoded"]
    packed = F.coalesce(F.col(f"`{ids_col}`"), F.lit(b"")).alias("ids")
    held = encoded.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), packed)

    def decode(packed: list[bytes]) -> dict[str, pa.Array]:
        return {"decoded": pa.array([vocabulary(path).decode(_unpacked(ids)) for ids in packed], pa.string())}

    return _map(held, "ids", {"decoded": T.StringType()}, decode).select(*[F.col(f"row.`{c}`").alias(c) for c in names], "decoded")
