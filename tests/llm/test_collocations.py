"""Collocations: summaries keep their guarantee, and results equal plain counting."""

import random
import re
from collections import Counter

import duckdb
import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from ledgertide.llm import collocations as C

SCHEMA = T.StructType([T.StructField("lang", T.StringType()), T.StructField("text", T.StringType())])


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.tuples(st.integers(0, 40), st.integers(1, 9)), max_size=30), max_size=12), st.integers(2, 40))
def test_merged_summaries_keep_every_frequent_key(parts, threshold):
    mass = sum(n for part in parts for _, n in part)
    true, whole = Counter(), C.MisraGries(mass // threshold + 1)
    for i, part in enumerate(parts):
        keys, counts = np.array([k for k, _ in part], np.uint32), np.array([n for _, n in part], np.int64)
        for k, n in part:
            true[k] += n
        if i % 2:  # merged as a summary of its own
            other = C.MisraGries(whole.capacity)
            other.merge(keys, counts)
            whole.merge(other.keys, other.counts, other.error)
        else:
            whole.merge(keys, counts)
        assert len(whole.keys) <= whole.capacity and whole.error <= mass / (whole.capacity + 1)
    assert {k for k, n in true.items() if n >= threshold} <= set(whole.reaching(threshold).tolist())
    assert all(n <= true[k] <= n + whole.error for k, n in zip(whole.keys.tolist(), whole.counts.tolist(), strict=True))


def test_a_partition_drops_rare_keys_and_keeps_frequent_ones():
    rng = np.random.default_rng(1)
    messages, true = [], Counter()
    for _ in range(60):
        keys, counts = np.unique(np.r_[rng.integers(0, 2**32, 4000), np.arange(20)].astype(np.uint32), return_counts=True)
        counts = counts + (keys < 5)
        true.update(dict(zip(keys.tolist(), counts.tolist(), strict=True)))
        many = np.flatnonzero(counts > 1).astype(np.uint32)
        messages.append((keys.tobytes(), many.tobytes(), counts[many].astype(np.uint32).tobytes()))
    kept = C.merge_shard(messages, 30)
    assert {k for k, n in true.items() if n >= 30} <= set(kept.tolist())
    assert len(kept) <= 0.05 * len(true)  # summaries held a thirtieth of the mass


def brute(rows, threshold, top):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0A-\x0D]", lowered):
            words = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, 5):
                f.update((lang, *words[i:i + k]) for i in range(len(words) - k + 1))
    f = {k: v for k, v in f.items() if v >= threshold}
    inside = {}
    for (lang, *w), v in f.items():
        for m in range(2, len(w)):
            for i in range(len(w) - m + 1):
                key = (lang, *w[i:i + m])
                inside[key] = max(inside.get(key, 0), v)
    found = {}
    for key, a in f.items():
        lang, *w = key
        if len(w) < 2 or 100 * inside.get(key, 0) >= 80 * a:
            continue
        score, _, left, right = min((2_000_000 * a // (x + y), k, x, y) for k in range(1, len(w))
                                    for x, y in [(f[lang, *w[:k]], f[lang, *w[k:]])])
        found.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), left, right))
    return sorted((lang, i + 1, p.decode(), -a, left, right, n[lang], -s) for lang, each in found.items()
                  for i, (s, a, p, left, right) in enumerate(sorted(each)[:top]))


def made(seed):
    rng = random.Random(seed)
    words = ["The", "of", "cat", "über", "a\xa0b", "x", "É", "sat", "on", "end\x1c", "中文"]
    rows = [(rng.choice(["en", "en", "en", "de", None]), " ".join(
        rng.choice(words) + rng.choice(["", "", "", ".", ", ", "\t", "\n", "  ", "!?"]) for _ in range(rng.randrange(60)))) for _ in range(500)]
    return rows + [("en", None), (None, ""), ("fr", "..."), ("en", "same line here now. " * 40)] + [("de", "eine kopie von vielen, immer gleich")] * 90


def test_mining_equals_plain_counting(spark):
    rows = made(3)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    for threshold, top in ((30, 2000), (12, 7)):
        got = sorted(tuple(r) for r in C.mine(docs, threshold=threshold, top=top).collect())
        assert got == brute(rows, threshold, top) and got


def test_small_blocks_and_long_pieces_lose_nothing(spark):
    body = b"a b c\nd e f\n" * 50 + b"g " * 400
    assert b"".join(C._cut(body, 100)) == body and max(map(len, C._cut(body, 100))) < 1000
    whole, parts = C.Block(body), [C.Block(p) for p in C._cut(body, 100)]
    for size in range(1, 5):
        assert len(whole.starts(size)) == sum(len(p.starts(size)) for p in parts)


def test_scores_past_64_bits_are_exact(spark):
    a, left, right = 10**14, 10**14 + 7, 3 * 10**14 + 1
    row = spark.range(1).selectExpr(f"CAST({a} AS BIGINT) AS a", f"CAST({left} AS BIGINT) AS l", f"CAST({right} AS BIGINT) AS r")
    assert row.select(C.score("a", "l", "r")).first()[0] == 2_000_000 * a // (left + right)


def test_nothing_and_clashing_names(spark):
    assert C.op13_misra_gries(spark.createDataFrame([], SCHEMA)).count() == 0
    odd = spark.createDataFrame([("en", "a b " * 40, 1, 2, 3)], "lang string, text string, Text int, block int, c0 int")
    assert {r.phrase for r in C.mine(odd).collect()} == {"a b a b", "b a b a"}


def test_query_equals_its_twin(spark):
    docs = "/root/testdata/sf0.001/documents.parquet"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{docs}'")
    result = con.execute(C.OP13_SQL)
    names = [d[0] for d in result.description]
    got = C.op13_misra_gries(spark.read.parquet(docs))
    assert sorted(tuple(r) for r in got.select(*names).collect()) == sorted(result.fetchall())
