"""Token ids in directly addressable codes (operator 10).

An id is split into chunks of eight bits. Level ``k`` holds the ``k``-th chunk
of every id that has one; a bitmap beside it tells which ids go on to the next
level, and a directory holds the number of set bits before each block of 512,
so that an id's place on the next level is a rank query. Any token is read by
one lookup per level without decoding its neighbours.

Files are Parquet tables of segments (about a million tokens each), so that
they can live in any store Spark reaches. Segments follow ascending ``doc_id``.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import map_batches, scratch, text_or_empty
from .library import library_codec

DEFAULT_TOKENIZER = "byte_bpe_50k.json"
END_ID = 0
SEGMENT_TOKENS = 1_000_000
CHUNK_BITS = 8
RANK_BLOCK = 512

SEGMENT = ("part int, seq bigint, first_doc bigint, last_doc bigint, doc_ids array<bigint>, ends array<bigint>, n_tokens bigint, "
           "levels array<binary>, bitmaps array<binary>, ranks array<binary>")


def build_levels(ids: np.ndarray) -> tuple[list[bytes], list[bytes], list[bytes]]:
    """``(chunks, continuation bitmaps, rank directories)`` by level."""
    levels, bitmaps, ranks = [], [], []
    rest = ids.astype(np.uint32)
    while True:
        more = rest >> CHUNK_BITS
        goes_on = more > 0
        levels.append((rest & (2**CHUNK_BITS - 1)).astype(np.uint8).tobytes())
        bitmaps.append(np.packbits(goes_on, bitorder="little").tobytes())
        starts = np.arange(0, len(rest), RANK_BLOCK)
        sums = np.add.reduceat(goes_on.astype(np.uint32), starts) if len(rest) else np.zeros(0, np.uint32)
        ranks.append((np.cumsum(sums) - sums).astype("<u4").tobytes())
        if not goes_on.any():
            return levels, bitmaps, ranks
        rest = more[goes_on]


class Segment:
    """Random access to one segment's ids."""

    def __init__(self, levels: list[bytes], bitmaps: list[bytes], ranks: list[bytes]):
        self.levels = [np.frombuffer(x, np.uint8) for x in levels]
        self.bitmaps = [np.frombuffer(x, np.uint8) for x in bitmaps]
        self.ranks = [np.frombuffer(x, "<u4") for x in ranks]

    def _rank(self, level: int, at: int) -> int:
        """Ids before place ``at`` of a level that go on."""
        block = at // RANK_BLOCK
        if block >= len(self.ranks[level]):
            block = len(self.ranks[level]) - 1
        first = block * RANK_BLOCK
        bits = np.unpackbits(self.bitmaps[level][first // 8:-(-at // 8)], bitorder="little")[:at - first]
        return int(self.ranks[level][block]) + int(bits.sum())

    def token(self, at: int) -> int:
        """The id at one place."""
        value = 0
        for level, chunks in enumerate(self.levels):
            value |= int(chunks[at]) << (CHUNK_BITS * level)
            if not self.bitmaps[level][at // 8] >> (at % 8) & 1:
                break
            at = self._rank(level, at)
        return value

    def tokens(self, start: int, stop: int) -> np.ndarray:
        """The ids of a range: one rank query per level finds where it goes on."""
        out = np.zeros(stop - start, np.uint32)
        where = slice(None)
        for level, chunks in enumerate(self.levels):
            if start >= stop:
                break
            part = chunks[start:stop].astype(np.uint32) << np.uint32(CHUNK_BITS * level)
            out[where] |= part
            bits = np.unpackbits(self.bitmaps[level][start // 8:-(-stop // 8)], bitorder="little")
            bits = bits[start % 8:start % 8 + stop - start].astype(bool)
            places = np.arange(len(out)) if isinstance(where, slice) else where
            where = places[bits]
            begin = self._rank(level, start)
            start, stop = begin, begin + len(where)
        return out


def write(df: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", tokenizer: str | None = None,
          end_id: int = END_ID, segment_tokens: int = SEGMENT_TOKENS) -> None:
    """Write every document's ids and the end id, in ascending ``doc_id`` order (nulls first; equal ids by text).

    A null text counts as empty and is written as the end id alone. Repeated
    rows are written once each. Other columns are not written. Sorting also by
    the text's hash lets rows of one ``doc_id`` spread over tasks.
    """
    codec_path = tokenizer or public_tokenizers.path(DEFAULT_TOKENIZER)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = library_codec(codec_path)
        end = array("I", [end_id]).tobytes()
        part, seq = TaskContext.get().partitionId(), 0
        keys, ends, parts, held = [], [], [], 0

        def segment() -> pa.RecordBatch:
            levels, bitmaps, ranks = build_levels(np.frombuffer(b"".join(parts), "<u4"))
            named = [k for k in keys if k is not None]
            row = {"part": part, "seq": seq, "first_doc": named[0] if named else None, "last_doc": named[-1] if named else None, "doc_ids": keys, "ends": ends, "n_tokens": held, "levels": levels,
                   "bitmaps": bitmaps, "ranks": ranks}
            kinds = {"part": pa.int32(), "doc_ids": pa.list_(pa.int64()), "ends": pa.list_(pa.int64())} | {
                n: pa.list_(pa.binary()) for n in ("levels", "bitmaps", "ranks")}
            return pa.RecordBatch.from_arrays([pa.array([v], kinds.get(n, pa.int64())) for n, v in row.items()], names=list(row))

        for batch in batches:
            for key, ids in zip(batch.column(0).to_pylist(), codec.encode_column(batch.column(1)), strict=True):
                ids += end
                held += len(ids) // 4
                keys.append(key)
                ends.append(held)
                parts.append(ids)
                if held >= segment_tokens:
                    yield segment()
                    seq, keys, ends, parts, held = seq + 1, [], [], [], 0
        if keys:
            yield segment()

    ordered = (
        df.select(F.col(doc_id).cast("long").alias("doc_id"), text_or_empty(text).alias("__text"))
        .withColumn("__tie", F.xxhash64("__text")).repartitionByRange("doc_id", "__tie").sortWithinPartitions("doc_id", "__tie")
    )
    map_batches(ordered.select("doc_id", "__text"), run, SEGMENT).write.parquet(path)


def read(spark: SparkSession, path: str, values: tuple[Column | str, ...] = ("ids",)) -> DataFrame:
    """``doc_id``, ``start`` (ids of all documents before it), ``n_tokens`` and ``values`` of every document in the files.

    ``values`` are expressions over ``ids`` (little-endian unsigned 32-bit);
    they are taken before the segments' starts are joined, so that only they move.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                segment = Segment(row["levels"], row["bitmaps"], row["ranks"])
                ends = np.array(row["ends"], np.int64)
                starts = np.concatenate([[0], ends[:-1]])
                every = segment.tokens(0, int(ends[-1])).astype("<u4").tobytes()  # one rank query per level for all documents
                ids = [every[4 * s:4 * e] for s, e in zip(starts.tolist(), ends.tolist(), strict=True)]
                n = len(ends)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["part"]] * n, pa.int32()), pa.array([row["seq"]] * n, pa.int64()),
                     pa.array(row["doc_ids"], pa.int64()), pa.array(starts, pa.int64()), pa.array(ends - starts, pa.int64()),
                     pa.array(ids, pa.binary())], names=["part", "seq", "doc_id", "local", "n_tokens", "ids"])

    segments = spark.read.schema(SEGMENT).parquet(path)
    sizes = segments.select("part", "seq", "n_tokens")
    parts = sizes.groupBy("part").agg(F.sum("n_tokens").alias("of_part"))  # one row per task that wrote
    before = parts.select("part", (F.sum("of_part").over(Window.orderBy("part")) - F.col("of_part")).alias("before_part"))
    inside = Window.partitionBy("part").orderBy("seq")
    bases = sizes.join(before, "part").select(
        "part", "seq", (F.col("before_part") + F.sum("n_tokens").over(inside) - F.col("n_tokens")).alias("base"))
    docs = segments.select("part", "seq", "doc_ids", "ends", "levels", "bitmaps", "ranks").mapInArrow(
        run, "part int, seq bigint, doc_id bigint, local bigint, n_tokens bigint, ids binary"
    ).select("part", "seq", "doc_id", "local", "n_tokens", *values)
    return docs.join(bases, ["part", "seq"]).withColumn("start", F.col("base") + F.col("local")).drop("part", "seq", "base", "local")


def token(spark: SparkSession, path: str, doc_id: int, place: int) -> int | None:
    """The id at one place (from 0, the end id is the last) of one document in the files.

    Each segment's first and last ``doc_id`` prune all others from the scan;
    of the one that holds the document a single id is looked up, by one rank
    query per level. None if there is no such document or place. Of repeated
    rows of a ``doc_id`` the first written counts.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                nth = row["doc_ids"].index(doc_id)
                start = row["ends"][nth - 1] if nth else 0
                value = None
                if 0 <= place < row["ends"][nth] - start:
                    value = Segment(row["levels"], row["bitmaps"], row["ranks"]).token(start + place)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["part"]], pa.int32()), pa.array([row["seq"]], pa.int64()), pa.array([value], pa.int64())],
                    names=["part", "seq", "value"])

    near = spark.read.schema(SEGMENT).parquet(path).filter((F.col("first_doc") <= doc_id) & (F.col("last_doc") >= doc_id))
    found = near.filter(F.array_contains("doc_ids", F.lit(doc_id).cast("long"))).select(
        "part", "seq", "doc_ids", "ends", "levels", "bitmaps", "ranks")
    first = map_batches(found, run, "part int, seq bigint, value bigint").orderBy("part", "seq").first()
    return first.value if first else None


def op10_token_files(documents: DataFrame) -> DataFrame:
    """Write the files, read them back, and give each document's place and checksum."""
    spark = documents.sparkSession
    path = scratch(spark, "tokens")
    write(documents, path)
    return read(spark, path, (F.crc32("ids").alias("ids_crc32"),)).select("doc_id", "start", "n_tokens", "ids_crc32")

