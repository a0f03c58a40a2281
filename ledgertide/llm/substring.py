"""Removal of repeated passages, found by fixed-block anchors (operator 6).

A passage of 20 equal words contains, wherever it starts, one whole block of 10
words at a multiple of 10 of the text it repeats. So the non-overlapping
10-word blocks of every text are an index, and every rolling 10-word window
probes it. Hits are extended: each 20-word window around a hit is compared with
all such windows, and overlapping repeated windows chain to maximal repeats.

Texts are dealt to blocks of a few MB. A block asks shards of the index about
its distinct windows, packed as sorted hashes, and gets a bit for each; it then
asks about the distinct 20-word windows around hits (96 bits of hash and the
first document), and gets a bit: does the first occurrence lie here? Only
packed bits and hashes are shuffled, each text once, and a window that fills a
third of a corpus is one entry per block, not one per occurrence. Shards and
blocks grow in number with the input, not in size.
"""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import block_count, bounded_batches, carried_and, carried_once, frugal, library_on_workers, owned_by, released, total_bytes
from .wordhash import Words, ascending, from_ascending, from_planes, planes, words_of

WINDOW = 20
ANCHOR = WINDOW // 2
BLOCK_BYTES = 8 << 20
SHARD_BYTES = 24 << 20
GROUP_BATCH_BYTES = 4 << 20  # of a group's rows, on their way to the worker
NULL_ID = -(2**63)

ASKED = "block int, shard int, low binary, more binary, doc binary"
TOLD = "block int, shard int, kind int, bits binary"


def _sorted_texts(docs: pa.Table) -> tuple[np.ndarray, list[bytes]]:
    """Rows of a block in document order: id (nulls first), equal ids by text."""
    texts, keys = docs["__text"].to_pylist(), docs["__key"].to_numpy()
    order = sorted(range(len(texts)), key=lambda i: (keys[i], texts[i]))
    return np.array(order, np.int64), [texts[i] for i in order]


def _by_shard(sorted_hashes: np.ndarray, shards: int) -> list[tuple[int, slice]]:
    """Shards are equal ranges of hashes, a power of two in number."""
    if not len(sorted_hashes):
        return []
    bits = shards.bit_length() - 1
    of = (sorted_hashes >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(sorted_hashes), np.int64)
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(of)) + 1, [len(of)]])
    return [(int(of[a]), slice(int(a), int(b))) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def _bits(answers: pa.Table, kind: int, n: int) -> np.ndarray:
    """The answers of all shards in hash order."""
    rows = sorted((r["shard"], r["bits"]) for r in answers.to_pylist() if r["kind"] == kind)
    if not rows:
        return np.zeros(n, bool)
    return np.concatenate([np.unpackbits(np.frombuffer(b[1:], np.uint8), bitorder="little")[:8 * (len(b) - 1) - b[0]]
                           for _, b in rows]).astype(bool)


def _packed(bits: np.ndarray) -> bytes:
    """Bits after a byte that tells how many of the last byte are unused."""
    return bytes([-len(bits) % 8]) + np.packbits(bits, bitorder="little").tobytes()


class Block:
    """A block's words, anchors and the questions it asks."""

    def __init__(self, texts: list[bytes], keys: np.ndarray):
        self.words: Words = words_of(texts)
        self.keys = keys
        self.hashes = self.words.hashes()
        starts = np.flatnonzero(self.words.fits(ANCHOR))
        self.starts = starts
        self.anchor, self.which = np.unique(self.words.runs(self.hashes, ANCHOR)[starts], return_inverse=True)

    def anchor_flags(self) -> tuple[np.ndarray, np.ndarray]:
        """Of each distinct anchor window: is it a block of the index here, and does it occur more than once?"""
        indexed = np.zeros(len(self.anchor), bool)
        indexed[self.which[self.words.place[self.starts] % ANCHOR == 0]] = True
        return indexed, np.bincount(self.which, minlength=len(self.anchor)) > 1

    def extend(self, hit: np.ndarray) -> None:
        """Windows around hits: distinct ones sorted, with the first place of each in document order."""
        n = len(self.words.start)
        marks = np.zeros(n + WINDOW + 1, np.int64)
        marks[self.starts[hit[self.which]] + 1] = 1
        marks = np.cumsum(marks)
        near = marks[np.arange(n) + WINDOW - ANCHOR + 1] > marks[np.arange(n)]
        self.windows = np.flatnonzero(near & self.words.fits(WINDOW))
        both = np.zeros(len(self.windows), [("high", np.uint64), ("low", np.uint32)])
        both["high"] = self.words.runs(self.hashes, WINDOW)[self.windows]
        second = self.words.hashes(1) if len(self.windows) else np.zeros(n, np.uint64)
        both["low"] = (self.words.runs(second, WINDOW, 1)[self.windows] >> np.uint64(32)).astype(np.uint32)
        order = np.lexsort((self.windows, both["low"], both["high"]))
        ranked = both[order]
        new = np.ones(len(order), bool)
        new[1:] = ranked[1:] != ranked[:-1]
        self.distinct = ranked[new]
        self.group = np.empty(len(order), np.int64)
        self.group[order] = np.cumsum(new) - 1
        self.first = self.windows[order[new]]
        text_of = np.repeat(np.arange(len(self.words.per_text)), self.words.per_text)
        self.first_key = self.keys[text_of[self.first]]

    def removed(self, here: np.ndarray) -> np.ndarray:
        """Words covered by a window that starts earlier somewhere; ``here``: the first of all occurrences is this block's."""
        later = np.ones(len(self.windows), bool)
        later[(self.first[self.group] == self.windows) & here[self.group]] = False
        n = len(self.words.start)
        edges = np.zeros(n + WINDOW + 1, np.int64)
        np.add.at(edges, self.windows[later], 1)
        np.add.at(edges, self.windows[later] + WINDOW, -1)
        return np.cumsum(edges)[:n] > 0


def _open(docs: pa.Table) -> tuple[Block, np.ndarray, list[bytes], int]:
    owned_by(__name__)
    order, texts = _sorted_texts(docs)
    return Block(texts, docs["__key"].to_numpy()[order]), order, texts, docs["__block"][0].as_py()


def _asked(rows: list[tuple]) -> pa.Table:
    columns = list(zip(*rows, strict=True)) or [()] * 5
    kinds = [pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["block", "shard", "low", "more", "doc"])


def _told(rows: list[tuple]) -> pa.Table:
    columns = list(zip(*rows, strict=True)) or [()] * 4
    kinds = [pa.int32(), pa.int32(), pa.int32(), pa.binary()]
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["block", "shard", "kind", "bits"])


def ask_anchors(shards: int):
    bits = shards.bit_length() - 1

    def run(docs: pa.Table) -> pa.Table:
        block, _, _, name = _open(docs)
        indexed, again = block.anchor_flags()
        low = (block.anchor >> np.uint64(32 - bits)).astype(np.uint32)
        return _asked([(name, shard, ascending(low[part]), _packed(indexed[part]), _packed(again[part]))
                       for shard, part in _by_shard(block.anchor, shards)])

    return run


def _flags(packed: bytes) -> np.ndarray:
    return np.unpackbits(np.frombuffer(packed[1:], np.uint8), bitorder="little")[:8 * (len(packed) - 1) - packed[0]].astype(bool)


def tell_anchors(asked: pa.Table) -> pa.Table:
    """A window is a hit where it is a block of the index somewhere and occurs more than once in all."""
    rows = asked.to_pylist()
    parts = [from_ascending(r["low"], np.uint32) for r in rows]
    distinct, which = np.unique(np.concatenate(parts), return_inverse=True)
    indexed, again = (np.concatenate([_flags(r[c]) for r in rows]) for c in ("more", "doc"))
    hit = (np.bincount(which, indexed, len(distinct)) > 0) & (
        (np.bincount(which, minlength=len(distinct)) > 1) | (np.bincount(which, again, len(distinct)) > 0))
    cuts = np.cumsum([len(p) for p in parts])[:-1]
    return _told([(r["block"], r["shard"], 1, _packed(h)) for r, h in zip(rows, np.split(hit[which], cuts), strict=True)])


def ask_windows(shards: int):
    def run(docs: pa.Table, told: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return _asked([])
        block, _, _, name = _open(docs)
        block.extend(_bits(told, 1, len(block.anchor)))
        high = np.ascontiguousarray(block.distinct["high"])
        low = np.ascontiguousarray(block.distinct["low"])
        return _asked([(name, shard, ascending(high[part]), planes(low[part]), planes(np.ascontiguousarray(block.first_key[part])))
                       for shard, part in _by_shard(high, shards)])

    return run


def tell_windows(asked: pa.Table) -> pa.Table:
    """Of each distinct window, whether the block that asks has the smallest document that holds it."""
    rows = asked.to_pylist()
    high = [from_ascending(r["low"], np.uint64) for r in rows]
    cuts = np.cumsum([len(p) for p in high])[:-1]
    high = np.concatenate(high)
    low = np.concatenate([from_planes(r["more"], np.uint32) for r in rows])
    doc = np.concatenate([from_planes(r["doc"], np.int64) for r in rows])
    of = np.repeat([r["block"] for r in rows], np.diff(np.concatenate([[0], cuts, [len(high)]])).astype(int))
    order = np.lexsort((of, doc, low, high))
    best = np.ones(len(order), bool)
    best[1:] = (high[order][1:] != high[order][:-1]) | (low[order][1:] != low[order][:-1])
    here = np.empty(len(order), bool)
    here[order] = best
    return _told([(r["block"], r["shard"], 2, _packed(h)) for r, h in zip(rows, np.split(here, cuts), strict=True)])


def _results(kept: list[str]):
    def run(docs: pa.Table, told: pa.Table) -> pa.Table:
        block, order, texts, _ = _open(docs)
        block.extend(_bits(told, 1, len(block.anchor)))
        gone = block.removed(_bits(told, 2, len(block.distinct)))
        counts, left, spans = [], [], []
        for text, first, n in zip(texts, block.words.first.tolist(), block.words.per_text.tolist(), strict=True):
            mine = gone[first:first + n]
            counts.append((n, int(mine.sum())))
            words = text.split()
            left.append(b" ".join(compress(words, (~mine).tolist())) if counts[-1][1] else b" ".join(words))
            edges = np.flatnonzero(np.diff(mine.astype(np.int8), prepend=0, append=0)).reshape(-1, 2).tolist()
            spans.append([{"start": a, "length": b - a} for a, b in edges])
        rows = docs.take(pa.array(order))
        new = [pa.array([c[0] for c in counts], pa.int64()), pa.array([c[1] for c in counts], pa.int64()),
               pa.array(left, pa.binary()).cast(pa.string()), pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("length", pa.int32())])))]
        return pa.table([*(rows[c] for c in kept), *new],
                        names=[*kept, "n_words", "n_removed", "kept_text", "removed_spans"])

    return run


def remove_repeats(df: DataFrame, doc_id: str = "doc_id", text: str = "text", block_bytes: int = BLOCK_BYTES,
                   shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Every row with the words of repeated passages removed from its text.

    Adds ``n_words``, ``n_removed``, ``kept_text`` (words joined by one space)
    and ``removed_spans`` (word places); columns of these names are replaced,
    all others stay. A word goes if a window of 20 words that covers it also
    starts earlier: in a smaller ``doc_id`` (null is smallest), or earlier in
    the same document; rows of one ``doc_id`` are ordered by their text, so of
    repeated rows the first stays whole (rows without id by a hash of the text). Windows are judged on the input. A
    null text has no words and becomes empty; texts under 20 words lose none.
    """
    new = ("n_words", "n_removed", "kept_text", "removed_spans")
    kind = df.schema[text].dataType
    names, df = carried_once(df, text, doc_id=doc_id)
    size = total_bytes(df, "__text")
    blocks = block_count(size, block_bytes)
    shards = 1 << (block_count(size, shard_bytes) - 1).bit_length()
    library_on_workers(df.sparkSession)
    bounded_batches(df.sparkSession, nbytes=GROUP_BATCH_BYTES)
    unnamed = F.lit(NULL_ID) + F.xxhash64("__text").bitwiseAND(2**40 - 1)  # before all ids, over many blocks
    key = F.coalesce(F.col("doc_id").cast("long"), unnamed)
    docs = (
        df.select("carried", key.alias("__key"), "__text")
        .withColumn("__block", F.pmod(F.xxhash64("__key"), F.lit(blocks)).cast("int"))
    )
    by_block = docs.groupBy("__block")
    hits = by_block.applyInArrow(frugal(ask_anchors(shards)), ASKED).groupBy("shard").applyInArrow(frugal(tell_anchors), TOLD)
    firsts = (
        by_block.cogroup(hits.groupBy("block")).applyInArrow(frugal(ask_windows(shards)), ASKED)
        .groupBy("shard").applyInArrow(frugal(tell_windows), TOLD)
    )
    fields = carried_and(df, "__text binary, n_words bigint, n_removed bigint, kept_text string, removed_spans array<struct<start:int,length:int>>")
    left = by_block.cogroup(hits.unionByName(firsts).groupBy("block")).applyInArrow(frugal(_results(["carried", "__text"])), fields)
    return released(left, names, new, (text, kind))


def op6_block_anchors(documents: DataFrame) -> DataFrame:
    """What is left of every document."""
    left = remove_repeats(documents.select("doc_id", "text"))
    return left.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


OP6_SQL = r"""
WITH docs AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS ws FROM documents
), windows AS (
  SELECT doc_id, i, array_to_string(list_slice(ws, i, i + 19), ' ') AS w
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 18, 1))) AS i FROM docs)
), later AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY w ORDER BY doc_id, i) AS r FROM windows) WHERE r > 1
), gone AS (
  SELECT doc_id, list(DISTINCT p) AS ps FROM (SELECT doc_id, unnest(range(i, i + 20)) AS p FROM later) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(len(ps), 0) AS BIGINT) AS n_removed,
       sha256(coalesce(array_to_string(CASE WHEN ps IS NULL THEN ws
         ELSE [ws[j] FOR j IN range(1, len(ws) + 1) IF NOT list_contains(ps, j)] END, ' '), '')) AS kept_sha256
FROM docs d LEFT JOIN gone g USING (doc_id)
"""
