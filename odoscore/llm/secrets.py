"""Secret scan with a recursive decoding worklist.

Every layer of a text is scanned by the base patterns.  A layer is decoded into further layers until nothing new
appears: the whole layer with its percent escapes, its Unicode escapes or its base64 pieces decoded in their places, each
base64 piece by itself at every alignment, and what compressed bytes in any of these hold.  Bytes that are no text become
replacement characters.  A layer seen before at the same place is not entered again, so cycles end.  Each decoded character keeps the span of the original text
that it came from, and a finding in a layer is reported at its place in the document.
"""

from __future__ import annotations

import base64
import bz2
import hashlib
import lzma
import re
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Sequence
from dataclasses import dataclass, field
from html import unescape
from itertools import accumulate, chain, repeat

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import set_aside, without

#: The base patterns; a match shorter than the given length (of the named group) does not count.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
# A run of at least 32 is found whole; shorter runs would be dropped.
HEX = re.compile(r"[0-9a-f]{32,}")
ASSIGN_LEAST, ACCESS_LEAST = 8, 16

PERCENT = re.compile(r"%[0-9A-Fa-f]{2}")
#: Code points in hexadecimal, in decimal, and references by name.
ESCAPE = re.compile(
    r"(?:\\u\{(?P<braced>[0-9A-Fa-f]{1,6})\}|\\u(?P<four>[0-9A-Fa-f]{4})|\\x(?P<two>[0-9A-Fa-f]{2})|&#[xX](?P<reference>[0-9A-Fa-f]{1,6});"
    r"|%u(?P<percent>[0-9A-Fa-f]{4})|\\U(?P<eight>[0-9A-Fa-f]{8}))|&#(?P<decimal>[0-9]{1,7});|&(?P<name>[A-Za-z][A-Za-z0-9]{1,31});"
)
#: A run, or several lines of one; only the first line has to be long.
BASE64 = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
WRAPPED = re.compile(r"[A-Za-z0-9+/_-]{16,}(?:[ \t]*\r?\n[ \t]*[A-Za-z0-9+/_-]+)+={0,2}")
#: Fewer printable bytes in a row hold neither a finding nor an encoded one.
_READABLE = re.compile(rb"[\x20-\x7e]{14}")
_PIECE = re.compile(r"\S+")
_PACKED = re.compile(rb"\x1f\x8b|BZh|\xfd7zXZ\x00|\x28\xb5\x2f\xfd|\x78[\x01\x5e\x9c\xda]")
#: First bytes of the compressed forms that are unpacked.
MAGIC = {b"\x1f\x8b": "gzip", b"BZh": "bz2", b"\xfd7zXZ\x00": "xz", b"\x28\xb5\x2f\xfd": "zstd"}
#: Characters that the layers of one document may hold together; a document that asks for more is flagged.
MAX_DECODED = 1 << 27

Span = tuple[int, int]


class Same(Sequence):
    """One span for every character of what compressed bytes hold, however much that is."""

    def __init__(self, span: Span, size: int):
        self.span, self.size = span, size

    def __len__(self) -> int:
        return self.size

    def __getitem__(self, at):
        if isinstance(at, slice):
            return Same(self.span, len(range(*at.indices(self.size))))
        if not -self.size <= at < self.size:
            raise IndexError(at)
        return self.span

    def __iter__(self):
        return repeat(self.span, self.size)


class Chained(Sequence):
    """Spans of parts one after another; a slice within one part is a slice of that part."""

    def __init__(self, parts: list[Sequence[Span]]):
        self.parts = [p for p in parts if len(p)]
        self.starts = [0, *accumulate(map(len, self.parts))]

    def __len__(self) -> int:
        return self.starts[-1]

    def __getitem__(self, at):
        if isinstance(at, slice):
            low, high, _ = at.indices(len(self))
            first, last = bisect_right(self.starts, low) - 1, bisect_left(self.starts, high) - 1
            cut = [p[max(0, low - s): high - s] for p, s in zip(self.parts[first: last + 1], self.starts[first: last + 1])] if low < high else []
            return cut[0] if len(cut) == 1 else Chained(cut)
        at += len(self) if at < 0 else 0
        i = bisect_right(self.starts, at) - 1
        return self.parts[i][at - self.starts[i]]

    def __iter__(self):
        return chain.from_iterable(self.parts)


Layer = tuple[str, Sequence[Span]]
_NO_SIGN = str.maketrans("", "", "= \t\r\n")
_REPLACED = re.compile("[\udc80-\udcff]")


def base_spans(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) of the base findings, by start and then by kind as listed."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_LEAST]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return [(s, KINDS[k], e) for s, k, e in sorted(found)]


def _text_of(data: bytes, spans: list[Span]) -> Layer:
    """UTF-8 bytes with one source span each -> characters with one source span each; other bytes are replaced."""
    if data.isascii():
        return data.decode("ascii"), spans
    text = data.decode("utf-8", "surrogateescape")
    if len(text) == len(data):
        return _REPLACED.sub("\ufffd", text), spans
    if isinstance(spans, Same):
        return _REPLACED.sub("\ufffd", text), Same(spans.span, len(text))
    out, at = [], 0
    for c in text:
        n = 1 if "\udc80" <= c <= "\udcff" else len(c.encode("utf-8"))
        out.append((spans[at][0], spans[at + n - 1][1]))
        at += n
    return _REPLACED.sub("\ufffd", text), out


def _clean(text: str) -> bool:
    return "\ufffd" not in text and "".join(text.split()).isprintable()


def _percent(piece: str, spans: list[Span]) -> tuple[bytes, list[Span]]:
    data, sources, at = bytearray(), [], 0
    while at < len(piece):
        if PERCENT.match(piece, at):
            data.append(int(piece[at + 1: at + 3], 16))
            sources.append((spans[at][0], spans[at + 2][1]))
            at += 3
        else:
            raw = piece[at].encode("utf-8", "surrogatepass")
            data += raw
            sources += [spans[at]] * len(raw)
            at += 1
    return bytes(data), sources


def _escapes(piece: str, spans: list[Span]) -> Layer:
    out, sources, at = [], [], 0
    for m in ESCAPE.finditer(piece):
        out.append(piece[at: m.start()])
        sources += spans[at: m.start()]
        if m["name"]:
            out.append(unescape(m[0]))
        else:
            code = int(m["decimal"]) if m["decimal"] else int(m[m.lastindex], 16)
            out.append(chr(code) if code < 0x110000 else m[0])
        sources += [(spans[m.start()][0], spans[m.end() - 1][1])] * len(out[-1])
        at = m.end()
    out.append(piece[at:])
    sources += spans[at:]
    text = "".join(out)
    # Pairs of escaped surrogates make one character.
    if any(0xD800 <= ord(c) < 0xE000 for c in text):
        joined, kept, i = [], [], 0
        while i < len(text):
            pair = text[i: i + 2]
            if len(pair) == 2 and 0xD800 <= ord(pair[0]) < 0xDC00 <= ord(pair[1]) < 0xE000:
                joined.append(pair.encode("utf-16-le", "surrogatepass").decode("utf-16-le"))
                kept.append((sources[i][0], sources[i + 1][1]))
                i += 2
            else:
                joined.append(pair[0])
                kept.append(sources[i])
                i += 1
        text, sources = "".join(joined), kept
    return text, sources


def _unpack(data: bytes, most: int) -> bytes | None:
    """What compressed bytes hold, or None if they are no such thing; one byte over ``most`` tells that there is more."""
    form = next((name for magic, name in MAGIC.items() if data.startswith(magic)), None)
    if form is None and len(data) > 6 and data[0] == 0x78 and (data[0] * 256 + data[1]) % 31 == 0:
        form = "zlib"
    try:
        if form == "gzip":
            return zlib.decompressobj(31).decompress(data, most + 1)
        if form == "zlib":
            return zlib.decompressobj().decompress(data, most + 1)
        if form == "bz2":
            return bz2.BZ2Decompressor().decompress(data, most + 1)
        if form == "xz":
            return lzma.LZMADecompressor().decompress(data, most + 1)
        if form == "zstd":
            with zstandard.ZstdDecompressor().stream_reader(data) as reader:
                return reader.read(most + 1)
    except (zlib.error, OSError, EOFError, lzma.LZMAError, zstandard.ZstdError):
        return None
    return None


def _held(data: bytes, spans: list[Span], most: int) -> tuple[list[Layer], bool]:
    """The texts in compressed bytes that begin anywhere in ``data``, and whether one was too large.

    Compressed bytes may hold compressed bytes; all of them are the source of every character.
    """
    out, over = [], False
    for m in _PACKED.finditer(data):
        inner, seen = data[m.start():], set()
        while (more := _unpack(inner, most)) is not None:
            if len(more) > most:
                return out, True
            mark = hashlib.sha256(more).digest()
            if mark in seen:
                break
            seen.add(mark)
            inner = more
        if seen and inner:
            out.append(_text_of(inner, Same((spans[m.start()][0], spans[-1][1]), len(inner))))
    return out, over


def _beside(layer: Layer, packed: list[Layer]) -> Layer:
    """A layer without the findings that its compressed parts, which may store text as it is, have unpacked already."""
    text, spans = layer
    for s, _, e in base_spans(text) if packed else ():
        if any(text[s:e] in inner for inner, _ in packed):
            text = text[:s] + "\ufffd" * (e - s) + text[e:]
    return text, spans


def _base64(piece: str, spans: list[Span], most: int) -> tuple[list[Layer], Layer | None, bool]:
    """What a piece holds when read from each of its first four characters on, so from any separator in it, too; what
    may stand in its place, if that is plain text; and whether something was too large."""
    same = isinstance(spans, Same)
    kept = [] if same else [i for i, c in enumerate(piece) if c not in "= \t\r\n"]
    whole = piece.translate(_NO_SIGN)
    out, place, over = [], None, False
    # Signs of both alphabets have one meaning each; the piece may mix them before and behind a separator.
    standard = whole.replace("-", "+").replace("_", "/")
    for shift in range(4):
        body = standard[shift:]
        body = body[:len(body) - (len(body) % 4 == 1)]
        data = base64.b64decode(body + "=" * (-len(body) % 4))
        if not data:
            continue
        at = [spans[i] for i in kept[shift:]]
        sources: Sequence[Span] = Same(spans.span, len(data)) if same else [(at[4 * (i // 3) + i % 3][0], at[4 * (i // 3) + i % 3 + 1][1]) for i in range(len(data))]
        packed, large = _held(data, sources, most)
        over |= large
        out += packed
        layer = _text_of(data, sources)
        clean = _clean(layer[0])
        if not shift and (packed or clean):
            place = packed[0] if packed else layer
        if (clean and not shift) or _READABLE.search(data):
            out.append(_beside(layer, packed))
        if b"\0" in data:
            # Two bytes a character.
            some = [] if same else [i for i, b in enumerate(data) if b]
            bare = data.replace(b"\0", b"")
            if _READABLE.search(bare):
                out.append(_beside(_text_of(bare, Same(spans.span, len(bare)) if same else [sources[i] for i in some]), packed))
    return out, place, over


@dataclass
class Scan:
    base: list[tuple[int, str, int]]
    spans: list[tuple[int, str, int]]
    layers: int = 0
    exhausted: bool = False
    _seen: set = field(default_factory=set, repr=False)


def _pieces(text: str):
    """(start, end) of the base64 pieces of a layer, also over line ends."""
    for m in BASE64.finditer(text):
        # Lower-case words and numbers are not worth a trial.
        if not (m[0].islower() and m[0].isalpha()) and not m[0].isdigit():
            yield m.start(), m.end(), True
    if "\n" in text:
        yield from ((m.start(), m.end(), False) for m in WRAPPED.finditer(text))


def _decoded(layer: str, spans: list[Span] | None, most: int) -> tuple[list[Layer], bool]:
    """The layers that one layer decodes to, and whether one was too large."""
    out, over = [], False
    percent = PERCENT.search(layer)
    escaped = any(sign in layer for sign in ("\\u", "\\x", "\\U", "%u", "&")) and ESCAPE.search(layer)
    pieces = [*_pieces(layer)]
    if not (percent or escaped or pieces):
        return out, over
    spans = spans or [(i, i + 1) for i in range(len(layer))]
    if percent:
        data, sources = _percent(layer, spans)
        # Compressed bytes reach up to a blank; else all that follows would be their source.
        packed = []
        for m in _PIECE.finditer(layer) if _PACKED.search(data) else ():
            if PERCENT.search(m[0]):
                found, large = _held(*_percent(m[0], spans[m.start(): m.end()]), most)
                packed += found
                over |= large
        out += [*packed, _beside(_text_of(data, sources), packed)]
    if escaped:
        text, sources = _escapes(layer, spans)
        packed = []
        for m in _PIECE.finditer(layer) if _PACKED.search(text.encode("latin-1", "replace")) else ():
            if ESCAPE.search(m[0]):
                part, places = _escapes(m[0], spans[m.start(): m.end()])
                found, large = _held(part.encode("latin-1", "replace"), places, most)
                packed += found
                over |= large
        out += [*packed, _beside((text, sources), packed)]
    for wrapped in (False, True):
        parts, places, at = [], [], 0
        for s, e, single in pieces:
            if single == wrapped:
                continue
            found, place, large = _base64(layer[s:e], spans[s:e], most)
            out += found
            over |= large
            if place and s >= at:
                parts += [layer[at:s], place[0]]
                places += [spans[at:s], place[1]]
                at = e
        if at:
            out.append(("".join([*parts, layer[at:]]), Chained([*places, spans[at:]])))
    return out, over


def scan(text: str | None, most: int = MAX_DECODED) -> Scan:
    """All findings of a text, as code point spans; null is empty."""
    text = text or ""
    base = base_spans(text)
    found, result, left = set(base), Scan(base, base), most
    work: list[tuple[str, list[Span] | None]] = [(text, None)]
    while work:
        layer, spans = work.pop()
        if spans is not None:
            for s, kind, e in base_spans(layer):
                found.add((spans[s][0], kind, max(spans[i][1] for i in (s, e - 1))))
        decoded, over = _decoded(layer, spans, left)
        result.exhausted |= over
        for inner, sources in decoded:
            if not inner or inner == layer:
                continue
            mark = (sources[0][0], sources[-1][1], hashlib.sha256(inner.encode("utf-8", "surrogatepass")).digest())
            if mark in result._seen:
                continue
            if len(inner) > left:
                result.exhausted = True
                continue
            left -= len(inner)
            result._seen.add(mark)
            result.layers += 1
            work.append((inner, sources))
    result.spans = sorted(found, key=lambda f: (f[0], KINDS.index(f[1]), f[2]))
    return result


def listed(spans: list[tuple[int, str, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, kind, end in spans)


def redact(text: str, spans: list[tuple[int, str, int]]) -> str:
    """The text with each finding (overlapping ones together) replaced by the kind of its first."""
    out, at = [], 0
    for start, kind, end in sorted(spans, key=lambda f: (f[0], -f[2])):
        if start >= at:
            out += [text[at:start], f"[{kind}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


ADDED = {
    "n_assign": pa.int64(), "n_access": pa.int64(), "n_hex": pa.int64(), "base_sha256": pa.string(), "spans": pa.string(),
    "n_layers": pa.int64(), "exhausted": pa.bool_(), "redacted": pa.string(),
}
_SCHEMA = "n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_layers long, exhausted boolean, redacted string"


def scan_secrets(docs: DataFrame, keep_text: bool = True) -> DataFrame:
    """``docs`` plus counts of the base findings, their digest, all spans, layers decoded, and the redacted text.

    ``redacted`` is null where nothing was found.  ``exhausted`` marks a text whose layers exceed MAX_DECODED
    characters; findings up to there are reported.  Null text is scanned as empty, repeated rows each for themselves, an
    empty table gives an empty one.  Input columns with the names of added ones are replaced.
    """
    docs = without(docs, ADDED)
    kept = [c for c in docs.columns if keep_text or c != "text"]

    def run(batches):
        for whole in batches:
            for start in range(0, whole.num_rows, 500):
                batch = whole.slice(start, 500)
                rows = []
                for text in batch.column(batch.schema.get_field_index("text")).to_pylist():
                    result = scan(text)
                    counts = [sum(kind == k for _, kind, _ in result.base) for k in KINDS]
                    digest = hashlib.sha256(listed(result.base).encode()).hexdigest()
                    redacted = redact(text, result.spans) if result.spans else None
                    rows.append([*counts, digest, listed(result.spans), result.layers, result.exhausted, redacted])
                added = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(ADDED.values())]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(batch.schema.get_field_index(c)) for c in kept), *added], names=[*kept, *ADDED]
                )

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields if f.name in kept]
    return docs.mapInArrow(run, ", ".join([*fields, _SCHEMA]))


def redacted_documents(docs: DataFrame) -> DataFrame:
    """Every document, its secrets replaced; documents without any stay as they are, and none is dropped."""
    held, restore = set_aside(docs, ADDED)
    scanned = scan_secrets(held).withColumn("text", F.coalesce("redacted", "text"))
    if "n_chars" in docs.columns:
        size = F.when(F.col("redacted").isNull(), F.col("n_chars")).otherwise(F.length("text"))
        scanned = scanned.withColumn("n_chars", size.cast(docs.schema["n_chars"].dataType))
    return restore(scanned)
