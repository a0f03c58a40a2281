"""Conversation repair against a plain search over all edits."""

import hashlib
import random
import re
import zlib

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from ledgertide.llm import conversation as C

SCHEMA = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()),
                       T.StructField("role", T.StringType()), T.StructField("text", T.StringType())])
WORD = re.compile(r"[^\x20\x09-\x0D]")


def brute(symbols):
    """``(cost, audit)`` of the best edits: from the back, all edits at every place and state."""
    def closed(best, used):
        for _ in range(3):
            for q in range(4):
                cost, text = best[C.FORCED[q]]
                used[q] = min(used[q], (cost + C.INSERT, "I" + text))
            best = dict(used)
        return used

    never = (C.INF, "")
    best = closed({q: (0, "") if q in (C.START, C.ASSISTANT) else never for q in range(4)},
                  {q: (0, "") if q in (C.START, C.ASSISTANT) else never for q in range(4)})
    for x in reversed(symbols):
        used = {q: min((cost + best[after][0], name + best[after][1]) for name, after, cost in C.edits(x, q)) for q in range(4)}
        best = closed(dict(used), used)
    return best[C.START]


def expected(rows):
    """The contract's row for each conversation, from plain Python rows."""
    out = {}
    for conv in {r[0] for r in rows}:
        kept = []
        for _, turn, role, text in (r for r in rows if r[0] == conv):
            role, text = " " if role is None else role, " " if text is None else text
            name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
            kind = zlib.crc32(name.encode()) % 20
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            row = (turn is not None, turn or 0, "user" if kind == 4 else role, text)
            kept += [row] * (0 if kind == 0 else 2 if kind == 3 else 1)
        kept.sort()
        known = [t for timed, t, *_ in kept if timed]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        seen, symbols, counts = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0}
        for _, _, role, text in kept:
            words = WORD.findall(text)
            fault = "blank" if not words else "duplicate" if (role, text) in seen else "truncated" if words[-1] not in ".!?" else ""
            seen.add((role, text))
            if fault:
                counts[fault] += 1
            symbols.append(C.GONE if fault in ("blank", "duplicate") else C.symbol(role[:1], fault == "truncated"))
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(kept, kept[1:]))
        cost, audit = brute(symbols)
        state, lines, left = C.START, [], iter(kept)
        for edit in audit:
            role, text = ("", "") if edit == "I" else next(left)[2:]
            if edit == "D":
                continue
            state = C.FOLLOWS[role[0]][state] if edit == "K" else C.FORCED[state]
            lines.append(f"{role if edit == 'K' else C.ROLE[state]}:{text}")
        assert re.fullmatch("(s?(ua)+)?", "".join(x[0] for x in lines))
        out[conv] = (gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit,
                     hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def got(frame):
    return {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in frame.collect()}


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 8), st.integers(1, 4)), max_size=9), st.integers(1, 5))
def test_runs_cost_and_read_as_the_plain_search(runs, cut):
    merged = []
    for x, n in runs:
        if merged and merged[-1][0] == x:
            merged[-1] = (x, merged[-1][1] + n)
        else:
            merged.append((x, n))
    cost, audit = brute([x for x, n in merged for _ in range(n)])
    assert C.solved(tuple(merged)) == (cost, audit)
    # in two segments, as for a conversation over several tasks
    head, tail = tuple(merged[:cut]), tuple(merged[cut:])
    behind = C.applied(C.matrix(tail), C.END)
    assert C.applied(C.matrix(head), behind)[C.START] == cost
    first, state = C.unroll(head, C.START, behind)
    second, state = C.unroll(tail, state, C.END)
    assert first + second + C.closing(state) == audit


def test_long_runs_by_binary_powers():
    for x in range(9):
        for n in (63, 64, 65, 500):
            assert C.solved(((x, n),)) == brute([x] * n)
    assert C.solved(((C.GONE, 10**6),)) == (C.DELETE * 10**6, "D" * 10**6)


def random_rows(seed, conversations, rows):
    rng = random.Random(seed)
    texts = ["Yes.", "No!", "and then", "", "  ", None, "What?", "x" * 3000, "ends. \n", "¿é?"]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None, "up"]
    return [(rng.choice([*range(conversations), None]), rng.choice([*range(12), None]) if rng.random() < .3 else i,
             rng.choice(roles[:rng.choice((2, 4, 9))]), rng.choice(texts[:rng.choice((3, 10))]) and f"{rng.randrange(4)} {rng.choice(texts) or ''}")
            for i in range(rows)]


def test_conversations_equal_brute_force_whole_and_in_segments(spark):
    rows = random_rows(1, 60, 700) + [(70, 5, "user", None), (71, None, None, None), (72, -2**62, "user", "a."), (72, 2**62, "user", "b.")]
    want = expected(rows)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert got(C.op11_run_length_repair(docs)) == want
    assert got(C.op11_run_length_repair(docs, segment_rows=3)) == want


def test_one_conversation_with_most_rows_lies_over_many_parts(spark):
    rows = [(1, i, "user" if i % 3 else "assistant", f"line {i % 400}.") for i in range(3000)] + random_rows(2, 9, 60)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    want = expected(rows)
    assert got(C.op11_run_length_repair(docs, segment_rows=100)) == want
    parts = C.repair(docs, segment_rows=100)
    assert parts.where("conv_id = 1").count() > 5
    first = C.turns(parts).where("conv_id = 1").orderBy("part", "seg", "place").select("role").collect()
    assert re.fullmatch("(s?(ua)+)?", "".join(r.role[0] for r in first))


def test_dropped_conversations_stay_and_nothing_gives_nothing(spark):
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    row = got(C.op11_run_length_repair(spark.createDataFrame([(gone, 0, "user", "Hi.")], SCHEMA)))[gone]
    assert row == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert got(C.op11_run_length_repair(spark.createDataFrame([], SCHEMA))) == {}


def test_gaps_that_fit_no_long_are_null(spark):
    rows = [(1, -2**63, "user", "a."), (1, 2**63 - 1, "assistant", "b.")]
    assert [r.gaps for r in C.repair(spark.createDataFrame(rows, SCHEMA)).collect() if r.gaps] == []


def test_columns_of_any_name_are_left_aside(spark):
    docs = spark.createDataFrame([("k", 1, "user", "Hi.", 1, 2, 3)], "conv string, turn int, role string, text string, Text int, part int, n int")
    (row,) = C.repair(docs, conv_id="conv").collect()
    assert (row.conv, row.audit, row.roles) == ("k", "KI", ["user", "assistant"])
