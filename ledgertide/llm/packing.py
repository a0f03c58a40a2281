"""Packing documents into sequences of bounded length at balanced cost (operator 5).

A document's tokens are cut into full sequences, which need no company, and a
rest. Rests gather in a buffer of bounded size. A full buffer is packed: the
cost of a piece of ``n`` tokens is ``linear * n + quadratic * n * n``; longest
first, each rest goes to the sequence of lowest cost that has room for it, and
only where none has room is it cut. The number of sequences is the least that
can hold the buffer, so a buffer is padded by less than one sequence.

No shuffle: each task packs what it reads. A sequence's id joins the task's
partition with a counter.
"""

from __future__ import annotations

import heapq
from array import array
from collections.abc import Iterator

import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, text_or_empty
from .library import library_codec

DEFAULT_TOKENIZER = "word_bpe_49k.json"
SEQUENCE_TOKENS = 4096
END_ID = 2
LINEAR, QUADRATIC = 1.0, 1.0 / 1024
BUFFER_TOKENS = 2_000_000

OUT = "doc_id bigint, start bigint, length bigint, doc_tokens bigint, sequence_id bigint, offset bigint, ids binary"


def cost(tokens: int) -> float:
    return LINEAR * tokens + QUADRATIC * tokens * tokens


def assign(lengths: list[int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """``(item, start in item, length, sequence, offset)`` for items no longer than ``capacity``."""
    n = -(-sum(lengths) // capacity)
    used, heap = [0] * n, [(0.0, s) for s in range(n)]
    placed = []
    todo = [(-length, i, 0) for i, length in enumerate(lengths)]
    heapq.heapify(todo)
    while todo:
        negative, item, start = heapq.heappop(todo)
        length, skipped, target = -negative, [], None
        while heap:
            entry = heapq.heappop(heap)
            if capacity - used[entry[1]] >= length:
                target = entry
                break
            skipped.append(entry)
        if target is None:  # no sequence has room for all of it
            target = skipped.pop(0)
            room = capacity - used[target[1]]
            heapq.heappush(todo, (room - length, item, start + room))
            length = room
        for entry in skipped:
            heapq.heappush(heap, entry)
        total, s = target
        placed.append((item, start, length, s, used[s]))
        used[s] += length
        if used[s] < capacity:
            heapq.heappush(heap, (total + cost(length), s))
    return placed


def pack(df: DataFrame, doc_id: str = "doc_id", text: str = "text", tokenizer: str | None = None,
         capacity: int = SEQUENCE_TOKENS, end_id: int = END_ID, buffer_tokens: int = BUFFER_TOKENS) -> DataFrame:
    """Pieces of all documents with their places in sequences of at most ``capacity`` tokens.

    Columns: ``doc_id``, ``start`` (tokens of the document before the piece),
    ``length``, ``doc_tokens`` (with the end token), ``sequence_id``,
    ``offset`` (gapless from 0) and ``ids`` (little-endian unsigned 32-bit).
    A null or empty text is one end token. A null ``doc_id`` stays null;
    repeated rows are packed as documents of their own. Other columns are not
    carried. No rows give no pieces.
    """
    path = tokenizer or public_tokenizers.path(DEFAULT_TOKENIZER)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = library_codec(path)
        end = array("I", [end_id]).tobytes()
        base = TaskContext.get().partitionId() << 33
        rests: list[tuple[int | None, int, int, bytes]] = []
        held = opened = 0

        def packed() -> list[tuple]:
            nonlocal opened
            rows = []
            for item, start, length, s, offset in assign([len(r[3]) // 4 for r in rests], capacity):
                key, first, total, ids = rests[item]
                rows.append((key, first + start, length, total, base + opened + s, offset, ids[4 * start:4 * (start + length)]))
            opened += -(-held // capacity)
            return rows

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            kinds = [pa.int64()] * 6 + [pa.binary()]
            columns = list(zip(*rows, strict=True)) or [()] * 7
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                                              names=["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"])

        for batch in batches:
            rows = []
            for key, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = codec.encode(body) + end
                total = len(ids) // 4
                full = total - total % capacity
                for start in range(0, full, capacity):
                    rows.append((key, start, capacity, total, base + opened, 0, ids[4 * start:4 * (start + capacity)]))
                    opened += 1
                if full < total:
                    rests.append((key, full, total, ids[4 * full:]))
                    held += total - full
                if held >= buffer_tokens:
                    rows += packed()
                    rests, held = [], 0
            yield batch_of(rows)
        yield batch_of(packed())

    prepared = df.select(F.col(doc_id).cast("long").alias("doc_id"), text_or_empty(text).alias("__text"))
    return map_batches(prepared, run, OUT)


def op5_cost_packing(documents: DataFrame) -> DataFrame:
    """Every piece with a checksum of its ids."""
    return pack(documents).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
