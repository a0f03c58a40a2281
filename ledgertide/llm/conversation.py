"""Repair of the structure of conversations by a run-length min-plus DP (operator 11).

A row is a symbol: the initial of its role and whether it is sound, truncated,
or to be deleted (blank, or a duplicate). Reading a symbol takes a conversation
from one of four states (nothing yet, after system, after user, after
assistant) to another at the least cost of edits, a 4 x 4 matrix in which sums
are minima and products are sums. Equal consecutive symbols are one run, and a
run of ``n`` is advanced by the binary powers of its matrix, which are kept.
Costs to the end are carried backwards over the runs; the audit is then unrolled
forwards, at each place the first edit in ASCII order that is still cheapest.

Rows are sorted by range, so that one conversation may lie over many tasks, and
read as a stream in segments of bounded size. A conversation in one segment is
finished where it is read. Of the others each segment leaves its matrix; these
are multiplied per conversation (one short row per segment), which gives every
segment the costs behind it, then the state in which it begins.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_batches, positional, stored

DELETE, REROLE, INSERT, TRUNCATED = 4, 3, 3, 3
START, SYSTEM, USER, ASSISTANT = range(4)
INF = 1 << 60
#: State after a role's initial, by the state before it.
FOLLOWS = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
FORCED = (USER, USER, ASSISTANT, USER)  # the role that an inserted or reroled row takes
ROLE = {USER: "user", ASSISTANT: "assistant"}
LEGAL = ("su", "ua", "au")
GONE = 8  # the symbol of a blank or a duplicate; the others are 2 * initial + truncated

SEGMENT_ROWS = 4096
SEGMENT_BYTES = 4_000_000
PIECE = 64

Vector = tuple[int, ...]
Runs = tuple[tuple[int, int], ...]


def symbol(initial: str, truncated: bool) -> int:
    return 2 * ("sua".find(initial) if initial and initial in "sua" else 3) + truncated


def edits(x: int, state: int) -> list[tuple[str, int, int]]:
    """``(initial, next state, cost)`` of the edits that use up a row, in ASCII order."""
    found = [("D", state, DELETE)]
    if x != GONE:
        extra = TRUNCATED if x % 2 else 0
        after = FOLLOWS.get("sua?"[x // 2], {}).get(state)
        if after is not None:
            found.append(("K", after, extra))
        found.append(("R", FORCED[state], REROLE + extra))
    return found


def times(a: list[Vector], b: list[Vector]) -> list[Vector]:
    return [tuple(min(row[k] + b[k][j] for k in range(4)) for j in range(4)) for row in a]


def applied(a: list[Vector], v: Vector) -> Vector:
    return tuple(min(row[k] + v[k] for k in range(4)) for row in a)


UNIT = [tuple(0 if i == j else INF for j in range(4)) for i in range(4)]


def _inserts() -> list[Vector]:
    step = [tuple(INSERT if FORCED[i] == j else INF for j in range(4)) for i in range(4)]
    once = [tuple(map(min, a, b)) for a, b in zip(UNIT, step, strict=True)]
    return times(once, once)  # a third insert only comes back to where the first led


INSERTS = _inserts()
END: Vector = tuple(min(INSERTS[q][START], INSERTS[q][ASSISTANT]) for q in range(4))


@functools.cache
def power(x: int, k: int) -> list[Vector]:
    """The matrix of ``2 ** k`` rows with symbol ``x``, inserts before each among them."""
    if k:
        return times(power(x, k - 1), power(x, k - 1))
    row = [[INF] * 4 for _ in range(4)]
    for q in range(4):
        for _, after, cost in edits(x, q):
            row[q][after] = min(row[q][after], cost)
    return times(INSERTS, [tuple(r) for r in row])


def back(x: int, n: int, v: Vector) -> Vector:
    """Costs to the end before a run of ``n``, from those behind it."""
    for k in range(n.bit_length()):
        if n >> k & 1:
            v = applied(power(x, k), v)
    return v


def matrix(runs: Runs) -> list[Vector]:
    out = UNIT
    for x, n in runs:
        for k in range(n.bit_length()):
            if n >> k & 1:
                out = times(out, power(x, k))
    return out


def _level(v: Vector) -> Vector:
    low = min(v)
    return tuple(c - low for c in v)


def _step(x: int, state: int, v: Vector) -> tuple[str, int]:
    """Edits of one row from ``state``, with costs ``v`` behind it."""
    before, out = back(x, 1, v), ""
    while True:
        left = before[state]
        for name, after, cost in edits(x, state):
            if name > "I" and INSERT + before[FORCED[state]] == left:
                break  # an insert comes first
            if cost + v[after] == left:
                return out + name, after
        out, state = out + "I", FORCED[state]


@functools.lru_cache(maxsize=1 << 14)
def _piece(x: int, n: int, state: int, v: Vector) -> tuple[str, int]:
    out = []
    for left in range(n - 1, -1, -1):
        text, state = _step(x, state, back(x, left, v))
        out.append(text)
    return "".join(out), state


def unrolled(x: int, n: int, state: int, v: Vector) -> tuple[str, int]:
    """The audit of a run from ``state``, and the state behind it."""
    v = _level(v)
    if n <= PIECE:
        return _piece(x, n, state, v)
    half = 1 << (n - 1).bit_length() - 1
    middle = _level(back(x, n - half, v))
    first, there = unrolled(x, half, state, middle)
    if half == n - half and middle == v and there == state:
        return first * 2, there
    second, last = unrolled(x, n - half, there, v)
    return first + second, last


def unroll(runs: Runs, state: int, behind: Vector) -> tuple[str, int]:
    """The audit of some runs from ``state``, and the state behind them; ``behind`` are the costs there."""
    vectors = [behind]
    for x, n in reversed(runs):
        vectors.append(back(x, n, vectors[-1]))
    out = []
    for (x, n), v in zip(runs, vectors[-2::-1], strict=True):
        text, state = unrolled(x, n, state, v)
        out.append(text)
    return "".join(out), state


def closing(state: int) -> str:
    """Inserts that bring a conversation to its end."""
    return "I" * (END[state] // INSERT)


@functools.lru_cache(maxsize=1 << 14)
def solved(runs: Runs) -> tuple[int, str]:
    """Least cost and audit of a whole conversation."""
    v = END
    for x, n in reversed(runs):
        v = back(x, n, v)
    audit, state = unroll(runs, START, END)
    return v[START], audit + closing(state)


def rewritten(audit: str, runs: Runs, state: int, roles: list[str], texts: list[str]) -> tuple[list[str], list[str]]:
    """Roles and texts after the edits; ``roles`` and ``texts`` are those of the rows that need not go."""
    out_roles, out_texts, rows = [], [], iter(zip(roles, texts, strict=True))
    symbols = (x for x, n in runs for _ in range(n))
    for edit in audit:
        if edit == "I":
            role, text, state = ROLE[FORCED[state]], "", FORCED[state]
        else:
            if next(symbols) == GONE:
                continue
            role, text = next(rows)
            if edit == "D":
                continue
            if edit == "R":
                role, state = ROLE[FORCED[state]], FORCED[state]
            else:
                state = FOLLOWS[role[0]][state]
        out_roles.append(role)
        out_texts.append(text)
    return out_roles, out_texts


class Segment:
    """Successive rows of one conversation, read in order."""

    def __init__(self, conv):
        self.conv, self.runs, self.roles, self.texts, self.size = conv, [], [], [], 0
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first = self.last = self.low = self.high = None

    def push(self, x: int, n: int) -> None:
        if self.runs and self.runs[-1][0] == x:
            n += self.runs.pop()[1]
        self.runs.append((x, n))

    def add(self, turn: int | None, role: str, text: str, fault: int, n: int) -> None:
        """``n`` equal rows; fault: 0 sound, 1 truncated, 2 duplicate, 3 blank (what the first of them has)."""
        if not n:
            return
        if turn is not None and turn != self.high:
            self.turns, self.high = self.turns + 1, turn
            self.low = turn if self.low is None else self.low
        initial = role[:1]
        if self.last is None:
            self.first = initial
        else:
            self.illegal += self.last + initial not in LEGAL
        self.illegal, self.last = self.illegal + n - 1, initial
        if fault == 3:
            self.blank += n
        else:
            self.duplicate += n if fault == 2 else n - 1
            self.truncated += fault == 1
        if fault < 2:
            self.push(symbol(initial, fault == 1), 1)
            self.roles.append(role)
            self.texts.append(text)
            self.size += len(text) + len(role)
            n -= 1
        if n:
            self.push(GONE, n)

    def full(self, rows: int) -> bool:
        return len(self.runs) >= rows or len(self.roles) >= rows or self.size >= SEGMENT_BYTES


def span(low: int | None, high: int | None, turns: int) -> int | None:
    """Turns missing between the least and the greatest; null where that is no long."""
    gaps = 0 if low is None else high - low + 1 - turns
    return gaps if gaps < 1 << 63 else None


_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
_LISTS = ("runs", "roles", "texts", "matrix")
_EDGES = ("first", "last", "low", "high", "turns")
_KINDS = {**dict.fromkeys(_COUNTS, "bigint"), "runs": "array<bigint>", "roles": "array<string>", "texts": "array<string>",
          "matrix": "array<bigint>", "first": "string", "last": "string", "low": "bigint", "high": "bigint", "turns": "bigint",
          "part": "int", "seg": "bigint", "whole": "boolean", "audit": "string", "behind": "array<bigint>", "ends": "array<int>",
          "state": "int", "repaired_sha256": "string"}
_ARROW = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_(), "array<bigint>": pa.list_(pa.int64()),
          "array<int>": pa.list_(pa.int32()), "array<string>": pa.list_(pa.string())}
_PART = ("part", "seg", "whole", *_COUNTS, "audit", *_LISTS, *_EDGES)


def _streamed(df: DataFrame, fields: tuple[str, ...], make) -> DataFrame:
    """Rows ``make`` yields for the rows of each partition in turn, ``(conv, *fields)``, in batches of bounded size."""
    conv = df.schema["conv"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = [None]

        def rows() -> Iterator[tuple]:
            for batch in batches:
                kind[0] = batch.schema.field("conv").type
                for at in range(0, batch.num_rows, 1024):
                    part = batch.slice(at, 1024)
                    yield from zip(*(c.to_pylist() for c in part.columns), strict=True)

        def batch_of(held: list[tuple]) -> pa.RecordBatch:
            types = [kind[0], *(_ARROW[_KINDS[f]] for f in fields)]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), types, strict=True)],
                                              names=["conv", *fields])

        held, weight = [], 0
        for row in make(rows()):
            held.append(row)
            weight += 200 + sum(sum(map(len, x)) if x and isinstance(x, list) and isinstance(x[0], str) else 0 for x in row)
            if weight >= SEGMENT_BYTES:
                yield batch_of(held)
                held, weight = [], 0
        if held:
            yield batch_of(held)

    return map_batches(df, run, ", ".join([f"conv {conv}", *(f"{f} {_KINDS[f]}" for f in fields)]))


def _segments(segment_rows: int, rows: Iterator[tuple]) -> Iterator[tuple]:
    part, seg = TaskContext.get().partitionId(), 0

    def left_open(s: Segment) -> tuple:
        nonlocal seg
        seg += 1
        flat = [c for run in s.runs for c in run]
        cells = [c for row in matrix(tuple(s.runs)) for c in row]
        return (s.conv, part, seg, False, None, s.blank, s.duplicate, s.truncated, s.illegal, None, None, flat, s.roles, s.texts,
                cells, s.first, s.last, s.low, s.high, s.turns)

    def finished(s: Segment) -> tuple:
        nonlocal seg
        seg += 1
        cost, audit = solved(tuple(s.runs))
        roles, texts = rewritten(audit, tuple(s.runs), START, s.roles, s.texts)
        return (s.conv, part, seg, True, span(s.low, s.high, s.turns), s.blank, s.duplicate, s.truncated, s.illegal, cost, audit, None,
                roles, texts, None, None, None, None, None, None)

    now, edge = None, True  # edge: the conversation may go on in another segment
    for conv, turn, role, text, fault, n in rows:
        if now is not None and (conv != now.conv):
            yield left_open(now) if edge else finished(now)
            now, edge = None, False
        if now is not None and now.full(segment_rows):
            yield left_open(now)
            now, edge = None, True
        if now is None:
            now = Segment(conv)
        now.add(turn, role, text, fault, n)
    if now is not None:
        yield left_open(now)


def _links(rows: Iterator[tuple]) -> Iterator[tuple]:
    """Per segment the costs behind it; the first one of a conversation also takes the conversation's counts."""

    def of_one(conv, segments: list[tuple]) -> Iterator[tuple]:
        v, behind = END, []
        for s in reversed(segments):
            behind.append(list(_level(v)))
            v = applied([tuple(s[2][i:i + 4]) for i in range(0, 16, 4)], v)
        last = low = high = None
        turns = illegal = 0
        for _, _, _, first, final, least, most, n, *_ in segments:
            if first is not None:
                illegal += last is not None and last + first not in LEGAL
                last = final
            if least is not None:
                turns += n - (least == high)
                low, high = least if low is None else low, most
        for i, s in enumerate(segments):
            yield (conv, s[0], s[1], behind[-1 - i], *((span(low, high, turns), illegal, v[START]) if not i else (None, 0, None)))

    held, conv = [], None
    for row in rows:
        if held and row[0] != conv:
            yield from of_one(conv, held)
            held = []
        conv = row[0]
        held.append(row[1:])
    if held:
        yield from of_one(conv, held)


def _pairs(flat: list[int]) -> Runs:
    return tuple(zip(flat[::2], flat[1::2], strict=True))


def _ends(rows: Iterator[tuple]) -> Iterator[tuple]:
    for conv, part, seg, runs, behind in rows:
        yield conv, part, seg, [unroll(_pairs(runs), q, tuple(behind))[1] for q in range(4)]


def _starts(rows: Iterator[tuple]) -> Iterator[tuple]:
    """Per segment the state it begins in, and whether it is a conversation's last."""
    before = None
    for conv, part, seg, ends in rows:
        if before is not None:
            yield (*before[:4], before[0] != conv)
        state = START if before is None or before[0] != conv else before[4][before[3]]
        before = (conv, part, seg, state, ends)
    if before is not None:
        yield (*before[:4], True)


def _finish(rows: Iterator[tuple]) -> Iterator[tuple]:
    for conv, part, seg, flat, roles, texts, behind, state, whole in rows:
        runs = _pairs(flat)
        audit, last = unroll(runs, state, tuple(behind))
        audit += closing(last) if whole else ""
        yield (conv, part, seg, audit, *rewritten(audit, runs, state, roles, texts))


def damaged(conversations: DataFrame) -> DataFrame:
    """The contract's damage, by a checksum of ``conv_id:turn``: ``conv_id, turn, role, text, copies`` (0: dropped)."""
    def text_of(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(text_of("conv_id"), F.lit(":"), text_of("turn"))) % 20
    text = text_of("text")
    return conversations.select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(text_of("role")).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"))


def _classified(df: DataFrame, conv: Column, turn: Column, role: Column, text: Column, copies: Column | None) -> DataFrame:
    """Distinct rows with their number of copies and the fault of the first of them."""
    gone = F.lit(False) if copies is None else copies == 0
    rows = df.select(conv.alias("conv"), F.when(~gone, turn.cast("long")).alias("turn"),
                     F.when(gone, "").otherwise(F.coalesce(role, F.lit(" "))).alias("role"),
                     F.when(gone, "").otherwise(F.coalesce(text, F.lit(" "))).alias("text"),
                     (F.lit(1) if copies is None else copies).cast("long").alias("n"))
    # a dropped row and an empty one may meet in a group; their sum is right, since the dropped one counts 0
    once = rows.groupBy("conv", "turn", "role", "text").agg(F.sum("n").alias("n"))
    name = F.coalesce(F.col("conv").cast("string"), F.lit(""))
    key = F.sha2(F.concat(F.col("conv").isNull().cast("string"), F.length(name).cast("string"), F.lit(":"), name,
                          F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    blank = ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    alone = F.xxhash64("conv", "turn", "role", "text").cast("string")  # blank rows meet no other: spread them
    kept = stored(once.select("*", blank.alias("blank"), F.when(blank, alone).otherwise(key).alias("key")), "turns")
    seen = kept.where("n > 0 AND NOT blank").groupBy("key").agg(
        F.count("*").alias("often"), F.max(F.col("turn").isNull()).alias("untimed"), F.min("turn").alias("earliest"))
    marked = kept.join(seen.where("often > 1").drop("often"), "key", "left")
    later = F.col("turn").isNotNull() & (F.col("untimed") | (F.col("earliest") < F.col("turn")))
    fault = (F.when(F.col("blank"), 3).when(F.coalesce(later, F.lit(False)), 2)
             .when(~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z"), 1).otherwise(0))
    return marked.select("conv", "turn", "role", "text", fault.alias("fault"), "n")


def repair(df: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
           copies: str | None = None, segment_rows: int = SEGMENT_ROWS) -> DataFrame:
    """Cheapest repair of each conversation to ``(system? (user assistant)+)?``, in parts of bounded size.

    One row per part: ``conv_id``, ``part`` and ``seg`` (their order), ``whole``
    (it is the only part), ``audit`` (initials of Delete, Insert, Keep, Rerole),
    ``roles`` and ``texts`` (what is left of the conversation), and the counts
    ``gaps blank duplicate truncated illegal cost``, to be added up over the parts.

    Rows are taken by turn (nulls first), then role, then text, so that ties
    have one order. A null role or text counts as one blank; rows without a
    conversation id are one conversation. ``copies`` names a column with the
    number of times that a row stands there; a conversation whose rows all have
    0 gives one part without rows. Repeated rows are duplicates. Other columns
    are not looked at. No rows give no parts. ``gaps`` is null where it is no long.
    """
    names, inner = positional(df)

    def column(name: str) -> Column:
        return F.col(f"c{names.index(name)}")

    rows = _classified(inner, *map(column, (conv_id, turn, role, text)), column(copies) if copies else None)
    order = [F.asc_nulls_first(c) for c in ("conv", "turn", "role")]
    dealt = rows.repartitionByRange(*order, F.substring("text", 1, 64)).sortWithinPartitions(*order, "text")
    parts = stored(_streamed(dealt, _PART, functools.partial(_segments, segment_rows)), "segments")

    def in_order(frame: DataFrame) -> DataFrame:
        return frame.repartition("conv").sortWithinPartitions(F.asc_nulls_first("conv"), "part", "seg")

    open_parts = parts.where("NOT whole")
    links = stored(_streamed(in_order(open_parts.select("conv", "part", "seg", "matrix", *_EDGES)), ("part", "seg", "behind", "gaps", "illegal", "cost"),
                             _links), "links")
    behind = links.select("part", "seg", "behind")
    ends = _streamed(open_parts.select("conv", "part", "seg", "runs").join(behind, ["part", "seg"]).select("conv", "part", "seg", "runs", "behind"),
                     ("part", "seg", "ends"), _ends)
    starts = _streamed(in_order(ends), ("part", "seg", "state", "whole"), _starts).select("part", "seg", "state", F.col("whole").alias("final"))
    ready = open_parts.select("conv", "part", "seg", "runs", "roles", "texts").join(behind, ["part", "seg"]).join(starts, ["part", "seg"])
    edited = _streamed(ready.select("conv", "part", "seg", "runs", "roles", "texts", "behind", "state", "final"),
                       ("part", "seg", "audit", "roles", "texts"), _finish)
    across = links.select("part", "seg", "gaps", F.col("illegal").alias("between"), "cost")
    told = open_parts.select("part", "seg", "blank", "duplicate", "truncated", "illegal").join(across, ["part", "seg"])
    mended = edited.join(told, ["part", "seg"]).withColumn("illegal", F.col("illegal") + F.col("between")).withColumn("whole", F.lit(False))
    columns = ["conv", "part", "seg", "whole", *_COUNTS, "audit", "roles", "texts"]
    return parts.where("whole").select(*columns).unionByName(mended.select(*columns)).withColumnRenamed("conv", conv_id)


def turns(parts: DataFrame, conv_id: str = "conv_id") -> DataFrame:
    """The repaired rows: ``conv_id, part, seg, place, role, text``."""
    rows = parts.select(conv_id, "part", "seg", F.posexplode(F.arrays_zip("roles", "texts")).alias("place", "row"))
    return rows.select(conv_id, "part", "seg", "place", F.col("row.roles").alias("role"), F.col("row.texts").alias("text"))


def _digests(rows: Iterator[tuple]) -> Iterator[tuple]:
    """One row per conversation: sums, the joined audit, and the digest, to which each part is fed in turn."""
    def closed() -> tuple:
        return (conv, *sums, "".join(audits), digest.hexdigest())

    conv, digest = None, None
    for row in rows:
        if digest is not None and row[0] != conv:
            yield closed()
            digest = None
        if digest is None:
            conv, digest, sums, audits, fed = row[0], hashlib.sha256(), [0] * len(_COUNTS), [], False
        sums = [a + (b or 0) for a, b in zip(sums, row[3:9], strict=True)]
        audits.append(row[9])
        for role, text in zip(row[10], row[11], strict=True):
            digest.update(f"{chr(10) if fed else ''}{role}:{text}".encode())
            fed = True
    if digest is not None:
        yield closed()


def op11_run_length_repair(conversations: DataFrame, segment_rows: int = SEGMENT_ROWS) -> DataFrame:
    """Faults, cheapest edits and a digest of the repaired text of every conversation, after the contract's damage.

    A digest of a conversation's whole text is computed from its first part to its last, by one task as a stream.
    """
    parts = repair(damaged(conversations.select("conv_id", "turn", "role", "text")), copies="copies", segment_rows=segment_rows)
    line = F.zip_with("roles", "texts", lambda role, text: F.concat(role, F.lit(":"), text))
    whole = parts.where("whole").select("conv_id", *_COUNTS, "audit", F.sha2(F.array_join(line, "\n"), 256).alias("repaired_sha256"))
    pieces = parts.where("NOT whole").withColumnRenamed("conv_id", "conv").select("conv", "part", "seg", *_COUNTS, "audit", "roles", "texts")
    pieces = pieces.repartition("conv").sortWithinPartitions(F.asc_nulls_first("conv"), "part", "seg")
    joined = _streamed(pieces, (*_COUNTS, "audit", "repaired_sha256"), _digests).withColumnRenamed("conv", "conv_id")
    return whole.unionByName(joined)
