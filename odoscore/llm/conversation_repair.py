"""Conversation repair by a run-length min-plus dynamic program.

Every row of a conversation is a symbol: its role's initial and its fault.  A finite automaton accepts the
role sequences ``(s?(ua)+)?``; keeping, reroling, deleting or inserting a row is a priced move in it.  The cheapest way
through one row is a 4 x 4 matrix of costs between states (``a (x) b`` adds along a path and takes the least), and equal
consecutive symbols are collapsed to a run, whose matrix is a power made of cached binary powers.  Costs to the end
go backward over runs; the choices are unrolled forward, a run halved along the same powers until one row is left.
In every state a letter leads to one state only, so the least letter that stays on a cheapest way gives the least audit.

A conversation of at most ``CHUNK`` rows is sorted and repaired by one task.  A longer one is cut into chunks in its
order: the matrices of its chunks, combined over the chunks, give every chunk the costs after it and the state before it,
and then all chunks are unrolled in parallel.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain, groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

#: Rows of a conversation that one task takes as a whole; a power of two.
CHUNK = 65_536

#: Costs of the edits: a kept or reroled truncated row costs TRUNCATED more.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
_NEVER = 1 << 60

# States: nothing yet, after the system row, after a user row, after an assistant row (as good an end as nothing).
_STATES = range(4)
_STEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
#: The only role that may be inserted or reroled to in a state.
_WANTED = ("u", "u", "a", "u")
_END = (0, _NEVER, _NEVER, 0)
_ROLE = {"u": "user", "a": "assistant"}

# A symbol is the initial (or "x" for any other), then "-" sound, "t" truncated, "d" to be deleted.
Symbol = str
Matrix = tuple[tuple[int, ...], ...]


def moves(symbol: Symbol, state: int) -> Iterator[tuple[str, int, int, int]]:
    """(letter, rows consumed, next state, cost) of every edit at a row."""
    initial, fault = symbol[0], symbol[1]
    yield "D", 1, state, DELETE
    yield "I", 0, _STEP[state, _WANTED[state]], INSERT
    if fault != "d":
        more = TRUNCATED if fault == "t" else 0
        if (state, initial) in _STEP:
            yield "K", 1, _STEP[state, initial], more
        yield "R", 1, _STEP[state, _WANTED[state]], REROLE + more


def times(a: Matrix, b: Matrix) -> Matrix:
    return tuple(tuple(min(_NEVER, *(a[i][k] + b[k][j] for k in _STATES)) for j in _STATES) for i in _STATES)


def apply(a: Matrix, costs: tuple[int, ...]) -> tuple[int, ...]:
    return tuple(min(_NEVER, *(a[i][k] + costs[k] for k in _STATES)) for i in _STATES)


IDENTITY: Matrix = tuple(tuple(0 if i == j else _NEVER for j in _STATES) for i in _STATES)


def _inserts() -> Matrix:
    """Cheapest insertions only, from state to state."""
    one = [[0 if i == j else _NEVER for j in _STATES] for i in _STATES]
    for state in _STATES:
        one[state][_STEP[state, _WANTED[state]]] = INSERT
    once = tuple(map(tuple, one))
    return times(times(once, once), times(once, once))


INSERTS = _inserts()


@lru_cache(maxsize=None)
def power(symbol: Symbol, exponent: int) -> Matrix:
    """Costs of passing 2^exponent rows of a symbol, insertions before each row included."""
    if exponent:
        half = power(symbol, exponent - 1)
        return times(half, half)
    one = [[_NEVER] * 4 for _ in _STATES]
    for state in _STATES:
        for _, rows, after, cost in moves(symbol, state):
            if rows:
                one[state][after] = min(one[state][after], cost)
    return times(INSERTS, tuple(map(tuple, one)))


def run_matrix(symbol: Symbol, length: int) -> Matrix:
    result, exponent = IDENTITY, 0
    while length >> exponent:
        if length >> exponent & 1:
            result = times(power(symbol, exponent), result)
        exponent += 1
    return result


def before_run(symbol: Symbol, length: int, costs: tuple[int, ...]) -> tuple[int, ...]:
    """Costs to the end before a run, from those after it."""
    exponent = 0
    while length >> exponent:
        if length >> exponent & 1:
            costs = apply(power(symbol, exponent), costs)
        exponent += 1
    return costs


def _choose(symbol: Symbol, state: int, here: int, after: tuple[int, ...]) -> tuple[str, int]:
    """The least letters that take one row at cost ``here`` in all, and the state they lead to."""
    letters = ""
    while True:
        # Costs before the row in a state that an insertion leads to; one row's matrix has its insertions.
        reach = apply(power(symbol, 0), after)
        for letter, rows, to, cost in sorted(moves(symbol, state)):
            if cost + (after[to] if rows else reach[to]) == here:
                letters, here, state = letters + letter, here - cost, to
                if rows:
                    return letters, state
                break
        else:
            raise AssertionError("no edit keeps the cheapest cost")


def _unroll(symbol: Symbol, exponent: int, state: int, after: tuple[int, ...], out: list[str]) -> int:
    """Letters of 2^exponent rows from ``state``, one text per row; returns the state behind them."""
    if not exponent:
        letters, state = _choose(symbol, state, apply(power(symbol, 0), after)[state], after)
        out.append(letters)
        return state
    middle = apply(power(symbol, exponent - 1), after)
    return _unroll(symbol, exponent - 1, _unroll(symbol, exponent - 1, state, middle, out), after, out)


def collapse(symbols: Iterable[Symbol]) -> list[tuple[Symbol, int]]:
    return [(symbol, sum(1 for _ in same)) for symbol, same in groupby(symbols)]


def unroll(runs: list[tuple[Symbol, int]], state: int, after: tuple[int, ...]) -> tuple[list[str], int]:
    """Letters of each row of consecutive runs, and the state behind them."""
    ends = [after]
    for symbol, length in reversed(runs):
        ends.append(before_run(symbol, length, ends[-1]))
    out: list[str] = []
    for (symbol, length), end in zip(runs, reversed(ends[:-1])):
        # The lowest bit of the length lies last, so that what follows a part is a power of what follows the run.
        parts = [e for e in range(length.bit_length()) if length >> e & 1]
        behind = [end]
        for exponent in parts[:-1]:
            behind.append(apply(power(symbol, exponent), behind[-1]))
        for exponent, costs in zip(reversed(parts), reversed(behind)):
            state = _unroll(symbol, exponent, state, costs, out)
    return out, state


def closing(state: int) -> str:
    """Insertions behind the last row: the cheapest way from a state to an end."""
    letters = ""
    while _END[state] == _NEVER:
        letters, state = letters + "I", _STEP[state, _WANTED[state]]
    return letters


#: Costs behind the last row, insertions there included.
LAST = apply(INSERTS, _END)


def replay(letters: str, state: int, row: tuple[str, str] | None) -> tuple[list[tuple[str, str]], int]:
    """Rows (role, text) that some letters leave of one row, and the state behind them."""
    out = []
    for letter in letters:
        if letter == "D":
            continue
        if letter == "K":
            out.append(row)
            state = _STEP[state, row[0][0]]
        else:
            role = _WANTED[state]
            out.append((_ROLE[role], "" if letter == "I" else row[1]))
            state = _STEP[state, role]
    return out, state


def symbol_of(role: str, fault: str) -> Symbol:
    return (role[:1] if role[:1] in ("s", "u", "a") else "x") + fault


_LEGAL = {"su", "ua", "au"}


class Tally:
    """Counts over consecutive rows of a conversation; ``join`` appends those of the rows that follow."""

    def __init__(self):
        self.rows = self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.low = self.high = self.first = self.last = None

    def add(self, turn: int | None, initial: str, fault: str) -> None:
        """One row; ``fault`` is ``b`` blank, ``r`` seen earlier, ``t`` truncated or ``-``."""
        self.blank += fault == "b"
        self.duplicate += fault == "r"
        self.truncated += fault == "t"
        if self.rows:
            self.illegal += self.last + initial not in _LEGAL
        else:
            self.first = initial
        self.last = initial
        self.rows += 1
        if turn is not None:
            self.turns += turn != self.high
            self.low, self.high = turn if self.low is None else self.low, turn

    def join(self, other: Tally) -> None:
        if not other.rows:
            return
        for name in ("blank", "duplicate", "truncated", "illegal", "turns"):
            setattr(self, name, getattr(self, name) + getattr(other, name))
        if self.rows:
            self.illegal += self.last + other.first not in _LEGAL
        else:
            self.first = other.first
        self.last = other.last
        self.rows += other.rows
        if other.low is not None:
            self.turns -= other.low == self.high
            self.low, self.high = other.low if self.low is None else self.low, other.high

    def totals(self) -> list[int]:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return [gaps, self.blank, self.duplicate, self.truncated, self.illegal]


_TOTALS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
_PARTS = (
    "part long, n_parts long, " + ", ".join(f"{c} long" for c in _TOTALS) + ", audit string, repaired array<struct<role:string,text:string>>"
)
_PAIRS = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
_ARROW = [(c, pa.int64()) for c in ("part", "n_parts", *_TOTALS)] + [("audit", pa.string()), ("repaired", _PAIRS)]
_BLANKS = r"\x20\x09-\x0D"
_HEAD = 64


def with_faults(rows: DataFrame) -> DataFrame:
    """``role`` and ``text`` without nulls (one space); ``fault`` ``b``, ``t`` or ``-``; ``mark``, equal for equal role and text."""
    held = rows.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text")})
    blank, ended = ~F.col("text").rlike(f"[^{_BLANKS}]"), F.col("text").rlike(rf"[.!?][{_BLANKS}]*\z")
    both = F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")
    return held.withColumn("fault", F.when(blank, "b").when(ended, "-").otherwise("t")).withColumn("mark", F.unhex(F.sha2(both, 256)))


def _order() -> list[Column]:
    """Order within a conversation; the heads keep sort keys short, whatever a text's length."""
    return [F.asc_nulls_first("turn"), F.substring("role", 1, _HEAD), F.substring("text", 1, _HEAD), F.col("mark")]


def _repair(symbols: list[Symbol], rows: list[tuple[str, str]], state: int, after: tuple[int, ...], last: bool) -> tuple[str, list]:
    """Audit and rows (role, text) of consecutive rows from ``state``; ``last`` adds the insertions at the end."""
    letters, end = unroll(collapse(symbols), state, after)
    if last:
        letters.append(closing(end))
        rows = [*rows, None]
    out = []
    for of_row, row in zip(letters, rows):
        kept, state = replay(of_row, state, row)
        out += kept
    return "".join(letters), [{"role": role, "text": text} for role, text in out]


def _small(rows: DataFrame, id_type: str) -> DataFrame:
    """Conversations that one task takes as a whole: one exchange sorts them, then they pass one by one."""
    names = ["conv_id", "turn", "role", "text", "fault", "mark", "absent"]

    def whole(found) -> tuple[list, int]:
        tally, seen, symbols, held = Tally(), set(), [], []
        for _, turn, role, text, fault, mark, absent in found:
            if absent:
                continue
            if fault != "b" and mark in seen:
                fault = "r"
            seen.add(mark)
            tally.add(turn, role[:1], fault)
            symbols.append(symbol_of(role, "d" if fault in "br" else fault))
            held.append((role, text))
        costs = LAST
        for symbol, length in reversed(collapse(symbols)):
            costs = before_run(symbol, length, costs)
        audit, out = _repair(symbols, held, 0, LAST, True)
        return [0, 1, *tally.totals(), costs[0], audit, out], sum(len(r["text"]) for r in out)

    def run(batches):
        batches = iter(batches)
        first = next(batches, None)
        if first is None:
            return
        schema = pa.schema([("conv_id", first.schema.field("conv_id").type), *_ARROW])
        found = (row for batch in chain([first], batches) for row in zip(*[batch.column(c).to_pylist() for c in names]))
        held, size = [], 0
        for conv_id, of_one in groupby(found, key=lambda row: row[0]):
            row, letters = whole(of_one)
            held.append([conv_id, *row])
            size += letters
            if size > 1 << 22 or len(held) >= 4096:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
                held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)

    placed = rows.select(*names).repartition("conv_id").sortWithinPartitions("conv_id", *_order())
    return placed.mapInArrow(run, f"conv_id {id_type}, {_PARTS}")


def _symbols(table: pa.Table) -> list[Symbol]:
    faults = table.column("fault").to_pylist()
    return [symbol_of(i, "d" if f in "br" else f) for i, f in zip(table.column("initial").to_pylist(), faults)]


def _long(rows: DataFrame, id_type: str) -> DataFrame:
    """Conversations of more rows: sorted over all tasks, cut into chunks, combined over the chunks, unrolled in parallel."""
    spread = rows.repartitionByRange("key", *_order()).sortWithinPartitions("key", *_order())
    # Numbers follow the order; 2^33 of them belong to a task, so no chunk spans two.
    kept = stored(spread.withColumn("pos", F.monotonically_increasing_id()).withColumn("chunk", F.expr(f"pos div {CHUNK}")))
    first = kept.groupBy("key", "mark").agg(F.min("pos").alias("first"))
    narrow = kept.select("key", "chunk", "pos", "turn", F.substring("role", 1, 1).alias("initial"), "fault", "mark").join(first, ["key", "mark"])
    again = (F.col("fault") != "b") & (F.col("pos") > F.col("first"))
    narrow = stored(narrow.withColumn("fault", F.when(again, "r").otherwise(F.col("fault"))).drop("mark", "first"))

    def sums(table: pa.Table) -> pa.Table:
        table = table.sort_by("pos")
        tally, matrix = Tally(), IDENTITY
        for row in zip(*[table.column(c).to_pylist() for c in ("turn", "initial", "fault")]):
            tally.add(*row)
        for symbol, length in collapse(_symbols(table)):
            matrix = times(matrix, run_matrix(symbol, length))
        state = {name: [value] for name, value in vars(tally).items()}
        place = {"key": table.column("key")[:1], "chunk": table.column("chunk")[:1]}
        return pa.table({**place, "matrix": pa.array([sum(matrix, ())], pa.list_(pa.int64())), **{n: pa.array(v, k) for (n, v), k in zip(state.items(), kinds)}})

    kinds = [pa.int64()] * 8 + [pa.string()] * 2
    fields = ", ".join(f"`{n}` {'string' if n in ('first', 'last') else 'long'}" for n in vars(Tally()))
    chunks = stored(narrow.groupBy("key", "chunk").applyInArrow(sums, f"key string, chunk long, matrix array<long>, {fields}"))

    def costs(table: pa.Table) -> pa.Table:
        """Every chunk's costs behind it, and the totals of its conversation: a few numbers per CHUNK rows."""
        table = table.sort_by("chunk")
        total, after, behind = Tally(), LAST, []
        parts = table.select(list(vars(total))).to_pylist()
        for part in parts:
            other = Tally()
            vars(other).update(part)
            total.join(other)
        for flat in reversed(table.column("matrix").to_pylist()):
            behind.append(after)
            after = apply(tuple(tuple(flat[i * 4: i * 4 + 4]) for i in _STATES), after)
        n = len(parts)
        out = {"key": table.column("key"), "chunk": table.column("chunk"), "part": pa.array(range(n), pa.int64()), "n_parts": pa.array([n] * n, pa.int64())}
        out |= {c: pa.array([v] * n, pa.int64()) for c, v in zip(_TOTALS, [*total.totals(), after[0]])}
        return pa.table(out | {"after": pa.array(reversed(behind), pa.list_(pa.int64()))})

    totals = ", ".join(f"{c} long" for c in ("part", "n_parts", *_TOTALS))
    known = stored(chunks.groupBy("key").applyInArrow(costs, f"key string, chunk long, {totals}, after array<long>"))

    def ways(table: pa.Table) -> pa.Table:
        table = table.sort_by("pos")
        after, runs = tuple(table.column("after")[0].as_py()), collapse(_symbols(table))
        ends = [unroll(runs, state, after)[1] for state in _STATES]
        return pa.table({"key": table.column("key")[:1], "chunk": table.column("chunk")[:1], "ends": pa.array([ends], pa.list_(pa.int64()))})

    led = narrow.join(known.select("key", "chunk", "after"), ["key", "chunk"]).groupBy("key", "chunk")

    def starts(table: pa.Table) -> pa.Table:
        table, state, found = table.sort_by("chunk"), 0, []
        for ends in table.column("ends").to_pylist():
            found.append(state)
            state = ends[state]
        return pa.table({"key": table.column("key"), "chunk": table.column("chunk"), "state": pa.array(found, pa.int64())})

    entered = led.applyInArrow(ways, "key string, chunk long, ends array<long>").groupBy("key").applyInArrow(starts, "key string, chunk long, state long")
    plan = stored(known.join(entered, ["key", "chunk"]))
    totals_of = ["part", "n_parts", *_TOTALS]

    def repaired(table: pa.Table) -> pa.Table:
        table = table.sort_by("pos")
        head = {c: table.column(c)[0].as_py() for c in (*totals_of, "after", "state")}
        texts = list(zip(table.column("role").to_pylist(), table.column("text").to_pylist()))
        last = head["part"] == head["n_parts"] - 1
        audit, out = _repair(_symbols(table), texts, head["state"], tuple(head["after"]), last)
        columns = {"conv_id": table.column("conv_id")[:1]} | {c: pa.array([head[c]], pa.int64()) for c in totals_of}
        return pa.table(columns | {"audit": pa.array([audit]), "repaired": pa.array([out], _PAIRS)})

    texts = kept.select("conv_id", "pos", "role", "text").join(narrow.select("key", "chunk", "pos", "initial", "fault"), "pos")
    return texts.join(plan, ["key", "chunk"]).groupBy("key", "chunk").applyInArrow(repaired, f"conv_id {id_type}, {_PARTS}")


def repair_conversations(rows: DataFrame, absent: Column | None = None) -> DataFrame:
    """Cheapest repair of every conversation: its parts (conv_id, part, n_parts, counts, cost, audit, repaired).

    ``rows`` have conv_id, turn, role and text.  Rows are taken by turn, nulls first, and those of one turn by role and
    text (their first 64 characters, then a hash), so equal rows are adjacent.  Where ``absent`` holds, a row
    only names its conversation.  ``gaps`` are turns missing between the least and the greatest; ``blank``, ``duplicate`` and
    ``truncated`` count each row's first fault; ``illegal`` counts adjacent initials other than su, ua and au.
    ``audit`` has the letters Keep, Rerole, Delete and Insert of the cheapest repair, the least of them in ASCII; ``repaired``
    its rows.  A conversation of more than ``CHUNK`` rows gives several parts: audit and repaired are in the order
    of ``part``, the counts are the whole conversation's in each.

    A null role or text is one space, a null conv_id is a conversation of its own; one without rows has zeros, an empty
    audit and no repaired rows.  Further columns are not looked at; an empty table gives an empty result.
    """
    small, long = _repaired(rows, absent)
    return small if long is None else small.unionByName(long)


def _repaired(rows: DataFrame, absent: Column | None) -> tuple[DataFrame, DataFrame | None]:
    """Parts of the conversations that fit a task, and of the others if there are any."""
    id_type = rows.schema["conv_id"].dataType.simpleString()
    gone = F.lit(False) if absent is None else F.coalesce(absent, F.lit(False))
    base = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text", gone.alias("absent"))
    # A key without nulls, so that a missing conv_id joins, too.
    key = F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit(""))
    sizes = base.where(~F.col("absent")).groupBy(key.alias("key")).agg(F.count("*").alias("n"))
    hot = stored(sizes.where(F.col("n") > CHUNK).select("key"))
    found = with_faults(base)
    if hot.isEmpty():
        return _small(found, id_type), None
    keyed = found.withColumn("key", key)
    long = keyed.join(hot, "key", "left_semi").where(~F.col("absent"))
    return _small(keyed.join(hot, "key", "left_anti"), id_type), _long(long, id_type)


def conversation_digests(rows: DataFrame, absent: Column | None = None) -> DataFrame:
    """One row per conversation of :func:`repair_conversations`, with its whole audit and its repaired rows as one hash.

    The hash is SHA-256 of ``role:text`` of all rows, joined by line feeds.  The parts of a long conversation stream through
    one task, a part at a time: a hash has to see its bytes in order.
    """
    counts = ["conv_id", *_TOTALS]
    lines = F.array_join(F.transform("repaired", lambda r: F.concat(r["role"], F.lit(":"), r["text"])), "\n")
    small, long = _repaired(rows, absent)
    digests = small.select(*counts, "audit", F.sha2(lines, 256).alias("repaired_sha256"))
    if long is None:
        return digests

    def run(batches):
        found = ((row["conv_id"], row, batch.schema) for batch in batches for row in batch.to_pylist())
        for _, parts in groupby(found, key=lambda part: part[0]):
            digest, audit, begun = hashlib.sha256(), [], False
            for _, row, schema in parts:
                for line in row["repaired"]:
                    digest.update(f"{chr(10) * begun}{line['role']}:{line['text']}".encode())
                    begun = True
                audit.append(row["audit"])
            done = {**{c: row[c] for c in counts}, "audit": "".join(audit), "repaired_sha256": digest.hexdigest()}
            fields = [schema.field(c) for c in counts] + [pa.field("audit", pa.string()), pa.field("repaired_sha256", pa.string())]
            yield pa.RecordBatch.from_pylist([done], schema=pa.schema(fields))

    ordered = long.repartition("conv_id").sortWithinPartitions("conv_id", "part")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in digests.schema)
    return digests.unionByName(ordered.mapInArrow(run, schema))


def damaged(rows: DataFrame) -> DataFrame:
    """Conversations with planted faults: one in twenty rows each is dropped, emptied, unended, repeated or given to the user.

    What happens to a row is told by CRC-32 of ``conv_id:turn``.  A null in conv_id, turn, role or text counts as one space.  Dropped rows stay,
    marked ``absent``, so that no conversation is lost.
    """
    def space(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")) % 20
    told = rows.select("conv_id", "turn", space("role").alias("role"), space("text").alias("text"), kind.alias("kind"))
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return told.select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
        (F.col("kind") == 0).alias("absent"), F.explode(copies).alias("copy"),
    ).drop("copy")
