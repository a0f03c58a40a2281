"""Phrase collocations by mergeable Misra-Gries summaries and a second, exact pass (operator 13).

Texts are cut into blocks of one language each and written to the shared
folder. Phrases of one to four words are known by 64-bit hashes, salted by the
language; a hash names a partition and a 32-bit fingerprint there. A hash is
only ever used to find candidates: equal ones add up, so no frequent phrase is
lost, and all counts that are returned are of words.

First pass: each block sends, to each hash partition, the fingerprints of its
distinct phrases with their counts (a Misra-Gries summary without error). A
partition merges these into one summary of at most ``capacity`` counters: counts
are added, and when there are too many, the ``capacity + 1``-th largest count is
taken from all. What has been taken in all, the error, is at most the
partition's mass by ``capacity + 1``, and the capacity exceeds the mass divided
by the threshold, so a phrase that reaches the threshold keeps a counter.
Fingerprints whose counter and error together reach it are sent back to the
blocks that asked. A partition's memory is bounded by the mass of texts that
the number of partitions is derived from.

Second pass: each block counts the occurrences of these phrases by their words,
and Spark adds the counts of all blocks. Cuts, containment and ranks are joins
and aggregates over the frequent phrases.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import block_count, library_on_workers, map_batches, positional, stored, total_bytes

LONGEST = 4
THRESHOLD = 30
ABSORBED_PERCENT = 80
SCORE_SCALE = 2_000_000
TOP = 2000
UNKNOWN = "und"
BLOCK_BYTES, SHARD_BYTES, READ_BYTES = 4_000_000, 8_000_000, 500_000

#: Bytes that end a piece become a line feed, the tab a blank, A-Z lower case.
_CLEAN = bytes.maketrans(b".,;:!?\x0b\x0c\x0d\x09" + bytes(range(65, 91)), b"\n" * 9 + b" " + bytes(range(97, 123)))
_BREAK, _GAP = 0, 1
_MIX = (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)  # fixed values: odd multipliers of a 64-bit mixer
_SIEVE = (1 << 22) - 1


class MisraGries:
    """A mergeable summary of weighted 32-bit keys: every key of more weight than ``mass / (capacity + 1)`` has a counter."""

    def __init__(self, capacity: int):
        self.capacity, self.error = capacity, 0
        self.keys, self.counts = np.zeros(0, np.uint32), np.zeros(0, np.int64)

    def merge(self, keys: np.ndarray, counts: np.ndarray, error: int = 0) -> None:
        """Add another summary; a key may occur in it several times."""
        keys, counts = np.concatenate([self.keys, keys]), np.concatenate([self.counts, counts])
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]][:len(keys)])
        keys, counts = keys[first], np.add.reduceat(counts, first) if len(first) else counts
        self.error += error
        if len(keys) > self.capacity:
            taken = int(np.partition(counts, -self.capacity - 1)[-self.capacity - 1])
            kept = counts > taken
            keys, counts = keys[kept], counts[kept] - taken
            self.error += taken
        self.keys, self.counts = keys, counts

    def reaching(self, threshold: int) -> np.ndarray:
        """Keys, sorted, whose weight may reach the threshold."""
        return self.keys[self.counts + self.error >= threshold]


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


class Block:
    """The words of one block as numbers, and where phrases of each length stand."""

    def __init__(self, body: bytes):
        numbers = _Words({b"\n": _BREAK, b"": _GAP})
        read = []
        for part in _cut(body, READ_BYTES):  # a part ends between pieces; its words as objects are gone before the next
            line = part.replace(b"\n", b" \n ").split(b" ")
            ids = np.fromiter(map(numbers.__getitem__, line), np.int32, len(line))
            read.append(ids[ids != _GAP])
        self.ids = np.concatenate(read)
        self.words = list(numbers)

    def starts(self, size: int) -> np.ndarray:
        """Places at which ``size`` words of one piece begin."""
        n = len(self.ids) - size + 1
        if n <= 0:
            return np.zeros(0, np.int64)
        whole = self.ids != _BREAK
        return np.flatnonzero(reduce(np.logical_and, (whole[j:j + n] for j in range(size))))

    def hashes(self, lang: str, shards: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each size: places, and at each ``partition << 32 | fingerprint`` of the phrase."""
        salt = xxhash.xxh3_64_intdigest((lang or "").encode())
        each = np.array([xxhash.xxh3_64_intdigest(w, salt) for w in self.words], np.uint64)[self.ids]
        run = each
        for size in range(1, LONGEST + 1):
            at = self.starts(size)
            if not len(at):
                return
            if size > 1:
                run = run[:-1] * np.uint64(_MIX[0]) + each[size - 1:]
            h = run[at]
            h ^= h >> np.uint64(30)
            h *= np.uint64(_MIX[1])
            h ^= h >> np.uint64(27)
            h *= np.uint64(_MIX[2])
            h ^= h >> np.uint64(31)
            shard = h >> np.uint64(32)
            shard %= np.uint64(shards)
            shard <<= np.uint64(32)
            h &= np.uint64(0xFFFFFFFF)
            h |= shard
            yield size, at, h

    def counted(self, size: int, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(a place of each, count)`` of the distinct phrases that stand at ``at``, told apart by their words."""
        v = len(self.words)
        code = self.ids[at].astype(np.int64)
        for j in range(1, size):
            if j > 1:  # a dense number per distinct beginning keeps the product within 64 bits
                code = np.unique(code, return_inverse=True)[1]
            code = code * v + self.ids[at + j]
        _, first, count = np.unique(code, return_index=True, return_counts=True)
        return at[first], count


def _cut(body: bytes, size: int) -> Iterator[bytes]:
    """A cleaned text in parts of about ``size`` bytes, cut between pieces; a longer piece stays whole."""
    at = 0
    while len(body) - at > size:
        end = body.rfind(b"\n", at + 1, at + size)
        if end < 0 and (end := body.find(b"\n", at + size)) < 0:
            break
        yield body[at:end]
        at = end
    yield body[at:]


def blocks(df: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """Cleaned texts in blocks of one language: ``block, lang, body``, written to the shared folder."""
    names, inner = positional(df)
    texts = inner.select(F.coalesce(F.col(f"c{names.index(lang)}"), F.lit(UNKNOWN)).alias("lang"),
                         F.coalesce(F.col(f"c{names.index(text)}"), F.lit("")).cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, size = TaskContext.get().partitionId() << 33, {}, 0

        def flushed() -> pa.RecordBatch:
            nonlocal number, held, size
            rows = [(number + i, name, b"\n".join(bodies)) for i, (name, bodies) in enumerate(held.items())]
            number, held, size = number + len(rows), {}, 0
            columns = list(zip(*rows, strict=True)) or [()] * 3
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.string(), pa.binary()), strict=True)],
                names=["block", "lang", "body"])

        for batch in batches:
            for name, raw in zip(batch.column(0), batch.column(1), strict=True):
                for part in _cut(raw.as_py().translate(_CLEAN), BLOCK_BYTES):
                    held.setdefault(name.as_py(), []).append(part)
                    size += len(part)
                    if size >= BLOCK_BYTES:
                        yield flushed()
        yield flushed()

    return stored(map_batches(texts, run, "block bigint, lang string, body binary"), "phrases")


def _packed(rows: list[tuple], fields: tuple[tuple[str, pa.DataType], ...]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, (_, k) in zip(columns, fields, strict=True)],
                                      names=[n for n, _ in fields])


_ASKED = (("shard", pa.int32()), ("block", pa.int64()), ("keys", pa.binary()), ("many", pa.binary()), ("counts", pa.binary()))
_TOLD = (("block", pa.int64()), ("shard", pa.int32()), ("keys", pa.binary()))
_COUNTED = (("lang", pa.string()), ("size", pa.int32()), ("phrase", pa.string()), ("f", pa.int64()))


def summaries(cut: DataFrame, shards: int) -> DataFrame:
    """Each block's counters by partition: fingerprints, and counts of those that occur more than once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, lang, body in zip(*batch.columns, strict=True):
                found = [key for *_, key in Block(body.as_py()).hashes(lang.as_py(), shards)]
                if not found:
                    continue
                keys, counts = np.unique(np.concatenate(found), return_counts=True)
                del found
                shard = (keys >> np.uint64(32)).astype(np.int64)
                used, first = np.unique(shard, return_index=True)
                rows = []
                for s, a, b in zip(used.tolist(), first.tolist(), [*first[1:].tolist(), len(keys)], strict=True):
                    many = np.flatnonzero(counts[a:b] > 1)
                    rows.append((s, block.as_py(), keys[a:b].astype(np.uint32).tobytes(), many.astype(np.uint32).tobytes(),
                                 counts[a:b][many].astype(np.uint32).tobytes()))
                yield _packed(rows, _ASKED)

    return map_batches(cut, run, "shard int, block bigint, keys binary, many binary, counts binary")


def merge_shard(messages: list[tuple[bytes, bytes, bytes]], threshold: int) -> np.ndarray:
    """Fingerprints of one partition that may reach the threshold."""
    decoded = []
    for keys, many, counts in messages:
        number = np.ones(len(keys) // 4, np.uint32)
        number[np.frombuffer(many, np.uint32)] = np.frombuffer(counts, np.uint32)
        decoded.append((np.frombuffer(keys, np.uint32), number))
    mass = sum(int(number.sum(dtype=np.int64)) for _, number in decoded)
    summary = MisraGries(mass // threshold + 1)
    waiting, size = [], 0
    for at, (keys, number) in enumerate(decoded):
        waiting.append((keys, number))
        size += len(keys)
        if size > summary.capacity or at + 1 == len(decoded):  # so that a merge costs no more than what it adds
            summary.merge(np.concatenate([k for k, _ in waiting]), np.concatenate([c for _, c in waiting]).astype(np.int64))
            waiting, size = [], 0
    return summary.reaching(threshold)


def survivors(asked: DataFrame, threshold: int) -> DataFrame:
    """What each block has to count: ``block, shard, keys``."""

    def run(table: pa.Table) -> pa.Table:
        columns = {n: table.column(n) for n in ("shard", "block", "keys", "many", "counts")}
        messages = [tuple(x.as_py() for x in row) for row in zip(*(columns[n] for n in ("keys", "many", "counts")), strict=True)]
        kept = merge_shard(messages, threshold)
        rows = []
        for shard, block, (keys, _, _) in zip(columns["shard"], columns["block"], messages, strict=True):
            mine = np.frombuffer(keys, np.uint32)
            place = np.searchsorted(kept, mine)
            mine = mine[kept[np.minimum(place, len(kept) - 1)] == mine] if len(kept) else mine[:0]
            if len(mine):
                rows.append((block.as_py(), shard.as_py(), mine.tobytes()))
        return pa.Table.from_batches([_packed(rows, _TOLD)])

    library_on_workers(asked.sparkSession)
    return asked.groupBy("shard").applyInArrow(run, "block bigint, shard int, keys binary")


def count_blocks(cut: DataFrame, told: DataFrame, shards: int) -> DataFrame:
    """Exact counts of the surviving phrases per block; size 0 has the number of words."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        rows = []
        wanted = [(s.as_py() << 32) + np.frombuffer(k.as_py(), np.uint32).astype(np.uint64)
                  for s, k in zip(right.column("shard"), right.column("keys"), strict=True)]
        known = np.sort(np.concatenate(wanted)) if wanted else np.zeros(0, np.uint64)
        sieve = np.zeros(_SIEVE + 1, bool)
        sieve[(known & np.uint64(_SIEVE)).astype(np.int64)] = True
        for lang, body in zip(left.column("lang").to_pylist(), left.column("body"), strict=True):
            block = Block(body.as_py())
            rows.append((lang, 0, "", int((block.ids != _BREAK).sum())))
            for size, at, keys in block.hashes(lang, shards) if len(known) else ():
                maybe = sieve[(keys & np.uint64(_SIEVE)).astype(np.int64)]
                at, keys = at[maybe], keys[maybe]
                at = at[known[np.minimum(np.searchsorted(known, keys), len(known) - 1)] == keys]
                for first, count in zip(*(x.tolist() for x in block.counted(size, at)), strict=True):
                    rows.append((lang, size, b" ".join([block.words[i] for i in block.ids[first:first + size].tolist()]).decode(), count))
        return pa.Table.from_batches([_packed(rows, _COUNTED)])

    both = cut.groupBy("block").cogroup(told.groupBy("block"))
    return both.applyInArrow(run, "lang string, size int, phrase string, f bigint")


def frequencies(df: DataFrame, text: str = "text", lang: str = "lang", threshold: int = THRESHOLD) -> DataFrame:
    """``lang, size, phrase, f``: every phrase of one to four words that occurs ``threshold`` times or more, and per
    language a row of size 0 with the number of its words. The result is in the shared folder."""
    cut = blocks(df, text, lang)
    shards = block_count(total_bytes(cut, "body"), SHARD_BYTES)
    told = survivors(summaries(cut, shards), threshold)
    counted = count_blocks(cut, told, shards).groupBy("lang", "size", "phrase").agg(F.sum("f").alias("f"))
    return stored(counted.where((F.col("size") == 0) | (F.col("f") >= threshold)), "frequent")


def _wide(column: str) -> Column:
    return F.col(column).cast("decimal(20,0)")


def score(a: str, left: str, right: str) -> Column:
    """``floor(SCORE_SCALE * a / (left + right))``, whose product may pass 64 bits."""
    return F.expr(f"{SCORE_SCALE}BD * CAST({a} AS DECIMAL(20,0)) DIV (CAST({left} AS DECIMAL(20,0)) + {right})")


def mine(df: DataFrame, text: str = "text", lang: str = "lang", threshold: int = THRESHOLD, top: int = TOP) -> DataFrame:
    """Each language's first ``top`` collocations: ``lang, rank, phrase, a, l, r, n, score``.

    Texts are lower-cased (A-Z only) and cut into pieces at punctuation and line
    ends; phrases never cross a piece. A null language is ``und``, a null or
    empty text has no words. Repeated rows count as often as they occur. Other
    columns are not looked at. No rows, or no phrase that is frequent enough,
    give no rows.
    """
    frequent = frequencies(df, text, lang, threshold)
    phrases = frequent.where("size > 0").select("lang", "size", "phrase", "f", F.split("phrase", " ").alias("w"))
    candidates = phrases.where("size > 1")

    def part(first: int | Column, length: int | Column) -> Column:
        return F.array_join(F.slice("w", first, length), " ")

    of = phrases.select("lang", F.col("phrase").alias("piece"), F.col("f").alias("piece_f"))
    cuts = candidates.select("lang", "phrase", F.col("f").alias("a"), "w", "size", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    halves = cuts.select("lang", "phrase", "a", "k", F.explode(F.array(
        F.struct(F.lit(True).alias("is_first"), part(F.lit(1), F.col("k")).alias("piece")),
        F.struct(F.lit(False).alias("is_first"), part(F.col("k") + 1, F.col("size") - F.col("k")).alias("piece")))).alias("half")
        ).select("lang", "phrase", "a", "k", "half.*")
    both = halves.join(of, ["lang", "piece"]).groupBy("lang", "phrase", "a", "k").agg(
        F.max(F.when(F.col("is_first"), F.col("piece_f"))).alias("l"), F.max(F.when(~F.col("is_first"), F.col("piece_f"))).alias("r"))
    rated = both.withColumn("score", score("a", "l", "r"))
    best = rated.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("best"))

    inside = candidates.where("size > 2").select("lang", "f", "w", "size", F.explode(F.sequence(F.lit(2), F.col("size") - 1)).alias("short"))
    inside = inside.select("lang", "f", "w", "short", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("short") + 1)).alias("from"))
    inside = inside.select("lang", "f", part(F.col("from"), F.col("short")).alias("phrase"))
    longest = inside.groupBy("lang", "phrase").agg(F.max("f").alias("longer"))

    kept = best.join(longest, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (100 * _wide("longer") < ABSORBED_PERCENT * _wide("a")))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.select("lang", "phrase", "a", "best.l", "best.r", "best.score").withColumn("rank", F.row_number().over(order))
    totals = frequent.where("size = 0").select("lang", F.col("f").alias("n"))
    return ranked.where(F.col("rank") <= top).join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op13_misra_gries(documents: DataFrame) -> DataFrame:
    """The collocations of all documents, by language."""
    return mine(documents.select("lang", "text"))


OP13_SQL = r"""
WITH pieces AS (
  SELECT COALESCE(lang, 'und') AS lang, doc_no, piece_no, piece
  FROM (SELECT lang, row_number() OVER () AS doc_no,
               regexp_split_to_array(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[.,;:!?\x0A-\x0D]') AS p FROM documents) d,
       LATERAL (SELECT unnest(p) AS piece, generate_subscripts(p, 1) AS piece_no) u),
listed AS (SELECT lang, doc_no, piece_no, list_filter(string_split(replace(piece, chr(9), ' '), ' '), lambda x: x <> '') AS w FROM pieces),
words AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM listed WHERE len(w) > 0),
totals AS (SELECT lang, COUNT(*) AS n FROM words GROUP BY lang),
grams AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
          FROM words, (VALUES (1), (2), (3), (4)) AS sizes(k) WHERE i + k - 1 <= len(w)),
f AS (SELECT lang, k, phrase, COUNT(*) AS f FROM grams GROUP BY lang, k, phrase HAVING COUNT(*) >= 30),
cuts AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w, unnest(range(1, k)) AS c FROM f WHERE k > 1),
rated AS (
  SELECT c.lang, c.phrase, c.a, c.c, x.f AS l, y.f AS r, (2000000::HUGEINT * c.a) // (x.f + y.f) AS score
  FROM cuts c
  JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:c.c], ' ')
  JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[c.c + 1:], ' ')),
best AS (SELECT * FROM rated QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1),
inside AS (
  SELECT DISTINCT c.lang, c.f AS f, array_to_string(string_split(c.phrase, ' ')[s.a:s.a + s.m - 1], ' ') AS phrase
  FROM f c, (VALUES (1, 2), (2, 2), (3, 2), (1, 3), (2, 3)) AS s(a, m) WHERE c.k > s.m AND s.a + s.m - 1 <= c.k),
kept AS (
  SELECT b.* FROM best b
  WHERE NOT EXISTS (SELECT 1 FROM inside i WHERE i.lang = b.lang AND i.phrase = b.phrase AND 100 * i.f::HUGEINT >= 80 * b.a::HUGEINT)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score
FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""
