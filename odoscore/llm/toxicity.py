"""Toxicity by noisy-channel deobfuscation.

A character language model is counted over the whole corpus.  A disguised token - look-alike digits and signs,
letters set apart, letters repeated - becomes a lattice of characters, and the Viterbi path under the model
restores it.  Words, restored or plain, are then scored by weights learned from labelled documents.

Two tables of bounded size reach the driver: the trigram counts (``len(ALPHABET) ** 3`` at most) and the
``MODEL_FEATURES`` strongest features.  The labelled sample is at most ``TRAIN_DOCS`` documents.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import set_aside, stored, without

#: Symbols of the language model ('#' is a word's edge) and the look-alikes of the channel.
ALPHABET = "#abcdefghijklmnopqrstuvwxyzßàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿ"
LOOKALIKES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "li", "+": "t", "€": "e", "£": "l", "¢": "c", "(": "c", "<": "c",
}
WILD = "aeiou"
#: Log costs of the channel: a look-alike, dropping one, a wild card, dropping a separator, a break kept as such.
LOOKALIKE, DROP_LOOKALIKE, WILDCARD, DROP, BREAK = -0.7, -9.0, -2.0, -0.1, -1.0
#: A token of more characters that is one held-down letter and one sign stands for no word.
LONGEST_HELD = 24

TRAIN_DOCS = 20_000
MODEL_FEATURES = 5_000
HELD_OUT, FOLDS = 2, 4
THRESHOLD = 0.3
_GRAM, _SIZE = 4, len(ALPHABET)
_CODE = {c: i for i, c in enumerate(ALPHABET)}
_EDGE_SIGNS = "".join(set(LOOKALIKES) - set("!(<0123456789"))
_SPACED = re.compile(r"(?<!\S)\S(?:[ \t]\S){2,}(?!\S)")
_REPEATED = re.compile(r"(.)\1\1")
_DOUBLED = re.compile(r"(.)\1")
#: Signs between words of one token: neither letters nor digits nor look-alikes nor wild cards.
_BETWEEN = re.compile(rf"(?:(?![{re.escape(''.join(LOOKALIKES))}*])[\W_])+")


# --- language model -------------------------------------------------------------------------------------

def _symbols(text: str, table: np.ndarray) -> np.ndarray:
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    codes = table[np.minimum(points, len(table) - 1)]
    keep = codes > 0
    keep[1:] |= codes[:-1] > 0
    return codes[keep]


def trigram_counts(docs: DataFrame) -> np.ndarray:
    """Counts [a, b, c] of neighbouring symbols over all of ``text``; every run of other characters is one edge."""
    table = np.zeros(512, dtype=np.int64)
    for c, i in _CODE.items():
        table[ord(c)] = i
    table[ord("#")] = 0

    def run(batches):
        total = np.zeros(_SIZE**3, dtype=np.int64)
        for batch in batches:
            for start in range(0, batch.num_rows, 200):
                texts = [t or "" for t in batch.column(0).slice(start, 200).to_pylist()]
                # What comes before an edge does not matter to the model, so texts may follow each other.
                codes = np.concatenate([[0, 0], _symbols("#" + "#".join(texts) + "#", table)])
                if len(codes) > 2:
                    total += np.bincount((codes[:-2] * _SIZE + codes[1:-1]) * _SIZE + codes[2:], minlength=_SIZE**3)
        seen = np.nonzero(total)[0]
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["id", "n"])

    counts = np.zeros(_SIZE**3)
    for i, n in docs.select("text").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n")).collect():
        counts[i] = n
    return counts.reshape(_SIZE, _SIZE, _SIZE)


def log_model(counts: np.ndarray) -> np.ndarray:
    """log P(c | a, b), smoothed by P(c | b); after an edge the letter before it does not count."""
    pairs = counts.sum(axis=0)
    single = (pairs + 0.1) / (pairs.sum(axis=1, keepdims=True) + 0.1 * _SIZE)
    model = (counts + 5.0 * single[None]) / (counts.sum(axis=2, keepdims=True) + 5.0)
    model[:, 0, :] = single[0]
    return np.log(model).astype(np.float32)


# --- decoding -------------------------------------------------------------------------------------------

def lattice(token: str) -> list[list[tuple[str, float]]]:
    """Readings of each run of equal characters with their log costs; a blank is a break between words."""
    wild = token.count("*") == 1
    columns = []
    for c, run in groupby(token):
        n = len(list(run))
        if c in " \t":
            columns.append([("", DROP), ("#", BREAK)])
        elif c in _CODE and c != "#":
            columns.append([(c * k, 0.0) for k in range(1, min(n, 2) + 1)])
        elif c in LOOKALIKES:
            options = [(x * k, LOOKALIKE) for x in LOOKALIKES[c] for k in range(1, min(n, 2) + 1)]
            columns.append([*options, ("", DROP_LOOKALIKE)])
        elif c == "*" and wild:
            columns.append([*((x, WILDCARD) for x in WILD), ("", DROP_LOOKALIKE)])
        else:
            columns.append([("", DROP)])
    return columns


def decode(token: str, model: np.ndarray) -> str:
    """The likeliest reading of a token under the model; breaks come back as blanks."""
    # A path is a chain (path before, piece), so that long tokens are not copied at every step.
    states: dict = {(0, 0): (0.0, None)}
    for options in lattice(token):
        reached: dict = {}
        for (a, b), (score, path) in states.items():
            for piece, cost in options:
                x, y, s = a, b, score + cost
                for c in piece:
                    z = _CODE[c]
                    s += model.item(x, y, z)
                    x, y = y, z
                if (x, y) not in reached or s > reached[x, y][0]:
                    reached[x, y] = (s, (path, piece) if piece else path)
        states = reached
    def text_of(path) -> str:
        pieces = []
        while path:
            path, piece = path
            pieces.append(piece)
        return "".join(reversed(pieces))

    ends = [(s + model.item(a, b, 0), path) for (a, b), (s, path) in states.items()]
    highest = max(s for s, _ in ends)
    return max(text_of(path) for s, path in ends if s == highest).replace("#", " ")


def _edges(token: str) -> str:
    """A lower-case token without the signs around it, but with one look-alike at either end."""
    core = token.strip("".join(c for c in set(token) if not c.isalnum()))
    if not core or core == token:
        return core
    at = token.index(core)
    end = at + len(core)
    if at and token[at - 1] in _EDGE_SIGNS and (at < 2 or token[at - 2] != token[at - 1]):
        core = token[at - 1] + core
    if end < len(token) and token[end] in _EDGE_SIGNS and (end + 1 == len(token) or token[end + 1] != token[end]):
        core += token[end]
    return core


def restore(token: str, model: np.ndarray) -> str:
    """The word that a lower-case token stands for; '' if it holds no letter."""
    core = _edges(token)
    if core.isalpha() and not _REPEATED.search(core):
        return core
    if not any(c.isalpha() for c in core):
        return ""
    if core.isalpha():
        return decode(core, model) or core
    if len(core) > LONGEST_HELD and len([*groupby(core)]) <= 2:
        return ""
    return decode(core, model)


def readings(token: str, model: np.ndarray) -> tuple[str, ...]:
    """All words that a lower-case token may stand for: as a whole, of several letters between signs, and with letters doubled."""
    if token.isalpha() and not _DOUBLED.search(token):
        return (token,)
    found = {restore(token, model)}
    core = _edges(token)
    parts = [p for p in _BETWEEN.split(core) if sum(c.isalpha() for c in p) > 1]
    if len(parts) > 1 or parts and parts[0] != core:
        found.update(restore(p, model) for p in parts)
    for word in [*found, *parts]:
        if word.isalpha() and not _REPEATED.search(word) and len(_DOUBLED.findall(word)) > 1:
            found.add(decode(word, model))
    return tuple(found)


def restored_words(text: str | None, model: np.ndarray, cache: dict) -> set[str]:
    """The distinct words of a text, disguises undone."""
    low = (text or "").lower()
    words = set()
    for token in set(low.split()):
        found = cache.get(token)
        if found is None:
            if len(cache) > 300_000:
                cache.clear()
            found = cache[token] = readings(token, model)
        words.update(found)
    for run in _SPACED.findall(low):
        if len(set(run)) > 3:
            words.update(decode(run, model).split())
    words.discard("")
    return words


# --- scoring --------------------------------------------------------------------------------------------

def features_of(word: str) -> list[str]:
    return [f"={word}", *(word[i: i + _GRAM] for i in range(len(word) - _GRAM + 1))]


def evidence(weights: list[float]) -> tuple[float, float, float]:
    """What the logistic score sees of a document: its strongest word, all of them, and how many."""
    return (max(weights, default=0.0), math.log1p(sum(weights)), math.log1p(len(weights)))


def held_out(doc_id: Column | str) -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))


def _texts(batches, *others):
    for batch in batches:
        for start in range(0, batch.num_rows, 500):
            part = batch.slice(start, 500)
            yield part, part.column(part.schema.get_field_index("text")).to_pylist()


def training_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """text, toxic, fold (0: weights, 1: calibration) of at most about TRAIN_DOCS labelled documents, picked by hash."""
    known = labels.where(~held_out("doc_id") & F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
    known = known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    n = known.count()
    spot = F.pmod(F.xxhash64(F.lit("train"), "doc_id"), F.lit(1 << 20))
    # Slightly under the bound, so that chance does not carry the sample over it.
    picked = stored(known.where(spot < int((1 << 20) * min(1.0, 0.97 * TRAIN_DOCS / max(1, n)))) if n > TRAIN_DOCS else known)
    picked = F.broadcast(picked.select("doc_id", "toxic", (F.pmod(F.xxhash64(F.lit("fold"), "doc_id"), F.lit(4)) == 0).cast("int").alias("fold")))
    return docs.select("doc_id", "text").join(picked, "doc_id").select("text", "toxic", "fold")


def learn_weights(rows: DataFrame, model: np.ndarray) -> dict[str, float]:
    """Log odds of the features (words and four-letter pieces) that speak for label 1."""

    def count(batches):
        seen, cache = Counter(), {}
        totals = [0, 0]
        for part, texts in _texts(batches):
            for text, toxic in zip(texts, part.column(part.schema.get_field_index("toxic")).to_pylist()):
                found = {f for word in restored_words(text, model, cache) for f in features_of(word)}
                seen.update((f, toxic) for f in found)
                totals[toxic] += 1
        keys = list(seen)
        yield pa.RecordBatch.from_arrays(
            [pa.array(["", "", *(f for f, _ in keys)]), pa.array([0, 1, *(t for _, t in keys)], pa.int32()),
             pa.array([*totals, *(seen[k] for k in keys)], pa.int64())], names=["feature", "toxic", "n"],
        )

    one, none = (F.sum(F.when(F.col("toxic") == t, F.col("n")).otherwise(0)).alias(f"n{t}") for t in (1, 0))
    counts = stored(rows.mapInArrow(count, "feature string, toxic int, n long").groupBy("feature").agg(one, none))
    totals = counts.where("feature = ''").first()
    n1, n0 = (totals["n1"], totals["n0"]) if totals else (0, 0)
    if not n1 or not n0:
        return {}
    weight = F.log((F.col("n1") - F.sqrt("n1") + 0.5) / (n1 + 1)) - F.log((F.col("n0") + 0.5) / (n0 + 1))
    strong = counts.where("feature != '' AND n1 >= 4").withColumn("weight", weight).where("weight >= 1.5")
    return {r["feature"]: r["weight"] for r in strong.orderBy(F.desc("weight"), "feature").limit(MODEL_FEATURES).collect()}


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Newton's method with a small ridge; the intercept comes first."""
    x = np.column_stack([np.ones(len(x)), x])
    beta = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve((x.T * (p * (1 - p))) @ x + ridge * np.eye(len(beta)), x.T @ (y - p) - ridge * beta)
        beta += step
        if np.abs(step).max() < 1e-8:
            break
    return beta


ADDED = ["held_out", "score", "predicted"]


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` plus ``held_out``, ``score`` (0 to 1) and ``predicted`` (1 if score >= THRESHOLD).

    Null and empty texts get the score of a text without evidence.  Repeated rows score alike; a document with several
    labels counts as toxic if one says so.  Without labels of both kinds every score is the smoothed share of
    toxic ones.  A null doc_id is not held out and never trains.
    """
    docs = without(docs, ADDED)
    model = log_model(trigram_counts(docs))
    rows = stored(training_rows(docs, labels))
    weights = learn_weights(rows.where("fold = 0"), model)

    def weights_of(text: str | None, cache: dict, known: dict) -> list[float]:
        found = []
        for word in restored_words(text, model, cache):
            w = known.get(word)
            if w is None:
                if len(known) > 300_000:
                    known.clear()
                w = known[word] = max((weights.get(f, 0.0) for f in features_of(word)), default=0.0)
            if w:
                found.append(w)
        return sorted(found)

    def measure(batches):
        cache, known = {}, {}
        for part, texts in _texts(batches):
            x = [evidence(weights_of(t, cache, known)) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [*(pa.array([v[i] for v in x], pa.float64()) for i in range(3)), part.column(part.schema.get_field_index("toxic"))],
                names=["a", "b", "c", "toxic"],
            )

    measured = rows.where("fold = 1").mapInArrow(measure, "a double, b double, c double, toxic int").toPandas()
    y = measured["toxic"].to_numpy(dtype=float)
    if len(set(y)) == 2:
        beta = fit_logistic(measured[["a", "b", "c"]].to_numpy(), y)
    else:
        base = (y.sum() + 0.5) / (len(y) + 5)
        beta = np.array([math.log(base / (1 - base)), 0, 0, 0])
    columns = docs.columns

    def score(batches):
        cache, known = {}, {}
        for part, texts in _texts(batches):
            x = np.array([evidence(weights_of(t, cache, known)) for t in texts]).reshape(-1, 3)
            p = 1 / (1 + np.exp(-np.clip(beta[0] + x @ beta[1:], -30, 30)))
            yield pa.RecordBatch.from_arrays(
                [*(part.column(part.schema.get_field_index(c)) for c in columns), pa.array(p)], names=[*columns, "score"]
            )

    scored = docs.mapInArrow(score, docs.withColumn("score", F.lit(0.0)).schema)
    return scored.withColumns({
        "held_out": held_out("doc_id"), "predicted": (F.col("score") >= THRESHOLD).cast("int"),
    }).select(*[F.col(f"`{c}`") for c in columns], "held_out", "score", "predicted")


def accepted_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents whose score does not reach THRESHOLD, as they are."""
    held, restore = set_aside(docs, ADDED)
    return restore(toxicity(held, labels).where("predicted = 0"))
