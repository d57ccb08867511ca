"""Conversation repair against an enumeration of all edits and a row-by-row program."""

import hashlib
import itertools
import random
import re
import zlib
from functools import lru_cache

import pytest
from pyspark.sql import functions as F

from odoscore.llm import conversation_repair as R

GRAMMAR = re.compile(r"(s?(ua)+)?")
WHITE = " \t\n\x0b\x0c\r"
ROWS = "conv_id long, turn long, role string, text string, chunk string, key string"


def enumerated(symbols):
    """The cheapest (cost, audit) over all edits with up to two insertions in each gap."""
    inserts = [list(c) for n in range(3) for c in itertools.product("ua", repeat=n)]
    options = []
    for initial, fault in symbols:
        own = [("D", "", 3)]
        if fault != "d":
            more = fault == "t"
            own += [("K", initial, 0 + more), ("R", "u", 2 + more), ("R", "a", 2 + more)]
        options += [inserts, own]
    best = None
    for choice in itertools.product(*options, inserts):
        cost, audit, roles = 0, "", ""
        for step in choice:
            if isinstance(step, list):
                cost, audit, roles = cost + 2 * len(step), audit + "I" * len(step), roles + "".join(step)
            else:
                cost, audit, roles = cost + step[2], audit + step[0], roles + step[1]
        if (best is None or (cost, audit) < best) and GRAMMAR.fullmatch(roles):
            best = cost, audit
    return best


def row_by_row(symbols):
    """The same without collapsing: least (cost, audit) from every row and state."""
    step = {"0s": "1", "0u": "2", "1u": "2", "2a": "3", "3u": "2"}

    @lru_cache(maxsize=None)
    def rest(i, state, inserted):
        found = [(0, "")] if i == len(symbols) and state in "03" else []

        def go(letter, role, cost, i, inserted=0):
            to = state if role is None else step.get(state + role)
            if to:
                more, audit = rest(i, to, inserted)
                found.append((cost + more, letter + audit))

        if inserted < 3:
            go("I", "u", 2, i, inserted + 1)
            go("I", "a", 2, i, inserted + 1)
        if i < len(symbols):
            initial, fault = symbols[i]
            go("D", None, 3, i + 1)
            if fault != "d":
                go("K", initial, int(fault == "t"), i + 1)
                go("R", "u", 2 + (fault == "t"), i + 1)
                go("R", "a", 2 + (fault == "t"), i + 1)
        return min(found, default=(10**9, ""))

    # From the back, so that no call goes deep.
    for i in range(len(symbols), 0, -20):
        for state in "0123":
            rest(i, state, 0)
    return rest(0, "0", 0)


def solved(symbols):
    costs = R.LAST
    for symbol, length in reversed(R.collapse(symbols)):
        costs = R.before_run(symbol, length, costs)
    letters, end = R.unroll(R.collapse(symbols), 0, R.LAST)
    assert len(letters) == len(symbols)
    return costs[0], "".join(letters) + R.closing(end)


def some_symbols(n):
    return [random.choice("ssuuuaaax") + random.choice("----ttd") for _ in range(n)]


def test_enumeration_of_all_edits():
    random.seed(1)
    for n, cases in ((0, 1), (1, 12), (2, 25), (3, 12)):
        for _ in range(cases):
            symbols = some_symbols(n)
            assert solved(symbols) == enumerated(symbols) == row_by_row(tuple(symbols)), symbols


def test_runs_of_any_length():
    random.seed(2)
    for _ in range(150):
        symbols = [s for s in some_symbols(random.randint(1, 6)) for _ in range(random.choice([1, 1, 2, 3, 7, 13]))]
        assert solved(symbols) == row_by_row(tuple(symbols)), symbols


def test_matrix_of_a_run():
    for symbol in ("u-", "at", "xd", "s-"):
        slow = R.IDENTITY
        for n in range(20):
            assert R.run_matrix(symbol, n) == slow
            assert R.before_run(symbol, n, R.LAST) == R.apply(slow, R.LAST)
            slow = R.times(slow, R.power(symbol, 0))


def brute(rows):
    held = {}
    for conv, turn, role, text, *_ in rows:
        found = held.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        found += [(turn, role, text)] * (2 if kind == 3 else 1)
    out = []
    for conv, found in held.items():
        mark = lambda r: hashlib.sha256(f"{len(r[1])}:{r[1]}{r[2]}".encode()).digest()
        found.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1][:64].encode(), r[2][:64].encode(), mark(r)))
        symbols, seen, counts = [], set(), {"b": 0, "r": 0, "t": 0, "-": 0}
        for _, role, text in found:
            fault = "b" if not text.strip(WHITE) else "r" if (role, text) in seen else "-" if text.strip(WHITE)[-1] in ".!?" else "t"
            seen.add((role, text))
            counts[fault] += 1
            symbols.append((role[:1] if role[:1] in tuple("sua") else "x") + ("d" if fault in "br" else fault))
        cost, audit = row_by_row(tuple(symbols))
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(found, found[1:]))
        turns = {t for t, *_ in found if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        state, queue, lines = "", list(found), []
        for letter in audit:
            expected = "user" if state in ("", "s", "a") else "assistant"
            row = None if letter == "I" else queue.pop(0)
            if letter != "D":
                role, text = (row[1], row[2]) if letter == "K" else (expected, "" if letter == "I" else row[2])
                lines.append(f"{role}:{text}")
                state = role[0]
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out.append((conv, gaps, counts["b"], counts["r"], counts["t"], illegal, cost, audit, digest))
    return sorted(out, key=str)


def given():
    random.seed(4)
    rows = []
    for conv in range(40):
        for turn in range(random.randint(1, 9)):
            role = "user" if turn % 2 == 0 else "assistant"
            rows.append((conv, turn, random.choice([role] * 5 + ["system", "User", "", "moderator"]), random.choice(["Yes.", "No", "Why?\n", " \t", "ok! "]) + random.choice(["", f" {turn}."]), "c", "k"))
    # A third of all rows in one conversation, with equal turns, long runs, nulls and repeated rows.
    rows += [(77, random.choice([None, i // 3, i // 3 + 100]), random.choice(["user", "user", "assistant", None]), random.choice(["Same.", f"T{i}", f"T{i}!", None, ""]), "c", "k") for i in range(130)]
    rows += [(78, None, "user", "a.", "c", "k"), (78, None, "user", "a.", "c", "k"), (None, 1, "user", "x.", "c", "k"), (None, None, None, None, "c", "k"), (None, 3, "assistant", "y" * 5000, "c", "k")]
    rows += [(80, t, "user", "x", "c", "k") for t in range(400) if zlib.crc32(f"80:{t}".encode()) % 20 == 0][:3]
    rows += [(81, t, "assistant", f"word {t} " * 30, "c", "k") for t in range(70)]
    random.shuffle(rows)
    return rows


@pytest.mark.parametrize("chunk", [65_536, 16, 4])
def test_conversations(spark, monkeypatch, chunk):
    monkeypatch.setattr(R, "CHUNK", chunk)
    rows = given()
    got = R.conversation_digests(R.damaged(spark.createDataFrame(rows, ROWS).repartition(5)), F.col("absent"))
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows)


def test_parts_hold_the_repaired_rows(spark, monkeypatch):
    rows = [(1, t, "user" if t % 2 else "assistant", f"t{t}.", "c", "k") for t in range(1, 31)]
    df = spark.createDataFrame(rows, ROWS)
    whole = R.repair_conversations(df).collect()
    assert [(r["part"], r["n_parts"], r["audit"]) for r in whole] == [(0, 1, "K" * 30)]
    monkeypatch.setattr(R, "CHUNK", 8)
    parts = sorted(R.repair_conversations(df).collect(), key=lambda r: r["part"])
    assert len(parts) > 1 and {r["n_parts"] for r in parts} == {len(parts)}
    assert [line for r in parts for line in r["repaired"]] == whole[0]["repaired"]


def test_empty_table(spark):
    empty = spark.createDataFrame([], ROWS)
    assert R.conversation_digests(R.damaged(empty), F.col("absent")).count() == 0
    assert R.repair_conversations(empty).count() == 0
