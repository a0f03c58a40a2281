"""Byte-level BPE encoding and decoding (operator 1).

Two-tier lookup. A minimal perfect hash over the vocabulary resolves every
pre-token that is itself a token with one probe and one comparison. A miss is
merged: the pre-token's bytes form a doubly linked list, candidate pairs wait
in a heap by (rank, position), and stale heap entries are skipped.

Encoding is a map over rows: no shuffle, no state beyond a bounded memo, and
recomputable from the input alone.
"""

from __future__ import annotations

import base64
import functools
from array import array
from collections.abc import Iterator, Sequence
from heapq import heapify, heappop, heappush

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .chunks import MARKS, chunks, keeps_letters_whole
from .common import Memo, carried_and, droppable, map_batches, positional, released, text_or_empty

DEFAULT_RANKS = "byte_bpe_multi_50k.tiktoken"
KEYS_PER_BUCKET = 4
TRIES = ((0, 64), (64, 1024), (1024, 32768))
PRIME = 2**31 - 1
SLICE_ROWS = 512
CHUNK_ENTRIES, PIECE_ENTRIES = 300_000, 50_000  # words and words with marks need no memo of pieces


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class PerfectHash:
    """Minimal perfect hash by displacement: ``n`` keys onto slots ``0 … n-1``, foreign keys told by comparison.

    Keys fall into buckets; the fullest bucket first, each takes the smallest
    displacement that sends all its keys to free slots. A bucket of one key
    stores its slot outright, so building always ends with every slot used.
    """

    def __init__(self, values: dict[bytes, int]):
        self.n = len(values)
        self.buckets = max(1, self.n // KEYS_PER_BUCKET)
        for self.seed in range(64):
            if self._build(values):
                return
        raise ValueError("no perfect hash found")

    def _parts(self, key: bytes) -> tuple[int, int, int]:
        h = xxhash.xxh3_64_intdigest(key, self.seed)
        return h % self.buckets, h & PRIME, h >> 33

    def _build(self, values: dict[bytes, int]) -> bool:
        members: list[list[tuple[int, int, bytes]]] = [[] for _ in range(self.buckets)]
        for key in values:
            bucket, start, step = self._parts(key)
            members[bucket].append((start, step, key))
        free = np.ones(self.n, bool)
        self.shift = [0] * self.buckets
        self.keys: list[bytes | None] = [None] * self.n
        self.values = [0] * self.n
        singles = []
        for bucket in sorted(range(self.buckets), key=lambda b: -len(members[b])):
            group = members[bucket]
            if len(group) < 2:
                singles += [(bucket, group[0][2])] if group else []
                continue
            start, step = np.array([g[0] for g in group]), np.array([g[1] for g in group])
            for low, high in TRIES:
                slots = (start + np.arange(low, high)[:, None] * step) % PRIME % self.n
                good = free[slots].all(1)
                ordered = np.sort(slots, 1)
                good &= (ordered[:, 1:] != ordered[:, :-1]).all(1)
                if good.any():
                    break
            else:
                return False
            at = int(np.argmax(good))
            self.shift[bucket] = low + at
            for slot, (_, _, key) in zip(slots[at].tolist(), group, strict=True):
                free[slot] = False
                self.keys[slot], self.values[slot] = key, values[key]
        for (bucket, key), slot in zip(singles, np.flatnonzero(free).tolist(), strict=True):
            self.shift[bucket] = -slot - 1
            self.keys[slot], self.values[slot] = key, values[key]
        return True

    def get(self, key: bytes) -> int | None:
        bucket, start, step = self._parts(key)
        shift = self.shift[bucket]
        slot = (start + shift * step) % PRIME % self.n if shift >= 0 else -shift - 1
        return self.values[slot] if self.keys[slot] == key else None


def merge_bytes(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Token ids of a piece: the lowest rank merges first, leftmost on ties.

    Parts are linked by ``end`` (0 once a part has joined its left neighbour)
    and ``before``. A heap entry packs rank, left part and the end of the pair.
    """
    n = len(piece)
    rank_of = ranks.get
    bits = n.bit_length()
    mask = (1 << bits) - 1
    before, end = list(range(-1, n)), list(range(1, n + 1))
    end.append(0)
    heap = [((rank << bits) | i) << bits | i + 2 for i in range(n - 1) if (rank := rank_of(piece[i:i + 2])) is not None]
    heapify(heap)
    while heap:
        entry = heappop(heap)
        stop, left = entry & mask, entry >> bits & mask
        right = end[left]
        if not right or end[right] != stop:
            continue  # one of the two parts has merged meanwhile
        end[left], end[right] = stop, 0
        before[stop] = left
        if stop < n and (rank := rank_of(piece[left:end[stop]])) is not None:
            heappush(heap, ((rank << bits) | left) << bits | end[stop])
        if (prior := before[left]) >= 0 and (rank := rank_of(piece[prior:stop])) is not None:
            heappush(heap, ((rank << bits) | prior) << bits | stop)
    ids, at = [], 0
    while at < n:
        ids.append(ranks[piece[at:end[at]]])
        at = end[at]
    return ids


class Codec:
    """Encoder and decoder for one rank file."""

    def __init__(self, path: str, pattern: str):
        self.ranks = read_ranks(path)
        self.pieces = regex.compile(pattern).findall
        size = max(self.ranks.values(), default=-1) + 1
        self.token = [b""] * size
        for token, rank in self.ranks.items():
            self.token[rank] = token
        self.whole_letters = keeps_letters_whole(pattern) and "[\\p{L}]+" not in pattern  # after a space too
        self.piece_memo = Memo(self._encode_piece, PIECE_ENTRIES)
        self.memo = Memo(self._encode_chunk, CHUNK_ENTRIES)

    @functools.cached_property
    def whole(self) -> PerfectHash:
        return PerfectHash(self.ranks)

    def _encode_piece(self, piece: str) -> bytes:
        raw = piece.encode()
        known = self.whole.get(raw)
        return array("I", [known] if known is not None else merge_bytes(raw, self.ranks)).tobytes()

    def _encode_chunk(self, chunk: str) -> bytes:
        if self.whole_letters and chunk.isascii():
            word = chunk.rstrip(MARKS)
            if (word[1:] if word[:1] == " " else word).isalpha():
                return self.memo[word] + self.memo[chunk[len(word):]] if len(word) < len(chunk) else self._encode_piece(chunk)
        return b"".join(map(self.piece_memo.__getitem__, self.pieces(chunk)))

    def encode(self, text: str) -> bytes:
        """Ids of a whole text as little-endian unsigned 32-bit integers."""
        return b"".join(map(self.memo.__getitem__, chunks(text)))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.token.__getitem__, memoryview(ids).cast("I").tolist()))


@functools.lru_cache(maxsize=4)
def codec(path: str, pattern: str) -> Codec:
    """One per worker process and rank file."""
    return Codec(path, pattern)


droppable(codec.cache_clear)


def encode(df: DataFrame, text: str = "text", ranks: str | None = None, pattern: str = public_tokenizers.PATTERN,
           out: str = "ids", decoded: str | None = None, kept: Sequence[str] | None = None) -> DataFrame:
    """Add ``out``: each text's token ids as little-endian unsigned 32-bit integers (binary).

    With ``decoded`` also that column: the bytes that these ids decode to, made
    in the same pass. A null text counts as empty and has no ids. Every row of
    the input gives one row, in place, with all its other columns, or with those
    of ``kept`` only: a text that is not kept goes to the workers once and does
    not come back. Existing columns of the new ones' names are replaced.
    Repeated rows are encoded alike.
    """
    path = ranks or public_tokenizers.path(DEFAULT_RANKS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = codec(path, pattern)
        for batch in (whole.slice(at, SLICE_ROWS) for whole in batches for at in range(0, whole.num_rows, SLICE_ROWS)):
            made = [[code.encode(t) for t in batch.column("__text").to_pylist()]]
            if decoded:
                made.append([code.decode(x) for x in made[0]])
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(x, pa.binary()) for x in made)],
                                             names=["carried", out, *([decoded] if decoded else [])])

    new = (out, decoded) if decoded else (out,)
    names, inner = positional(df)
    at = [i for i, n in enumerate(names) if kept is None or n in kept]
    row = [F.col(f"c{i}").alias(f"c{n}") for n, i in enumerate(at)] or [F.lit(0).alias("c0")]
    prepared = inner.select(F.struct(*row).alias("carried"), text_or_empty(f"c{names.index(text)}").alias("__text"))
    fields = carried_and(prepared, ", ".join(f"`{c}` binary" for c in new))
    return released(map_batches(prepared, run, fields), [names[i] for i in at], new)


def decode(df: DataFrame, ids: str = "ids", ranks: str | None = None, pattern: str = public_tokenizers.PATTERN,
           out: str = "decoded") -> DataFrame:
    """Add ``out``: the bytes that ``ids`` stands for (binary; null ids give null)."""
    path = ranks or public_tokenizers.path(DEFAULT_RANKS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = codec(path, pattern)
        for batch in batches:
            texts = [None if x is None else code.decode(x) for x in batch.column(ids).to_pylist()]
            at = [i for i, n in enumerate(batch.schema.names) if n != out]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in at), pa.array(texts, pa.binary())],
                                             names=[*(batch.schema.names[i] for i in at), out])

    kept = [c for c in df.columns if c != out]
    fields = ", ".join([f"`{c}` {df.schema[c].dataType.simpleString()}" for c in kept] + [f"`{out}` binary"])
    return map_batches(df, run, fields)


def op1_byte_bpe(documents: DataFrame) -> DataFrame:
    """Digests of every document's ids and of what they decode to."""
    coded = encode(documents, decoded="decoded", kept=["doc_id"])
    return coded.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


