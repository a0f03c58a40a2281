"""Helpers that several operators share: Arrow batches, scratch tables, bounded memos, blocks of documents."""

from __future__ import annotations

import ctypes
import os
import uuid
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType

MEMO_ENTRIES = 200_000
MEMO_KEY_CHARS = 64


def scratch(spark: SparkSession, label: str) -> str:
    """A new directory below the shared folder that the cluster names in ``spark.checkpoint.dir``.

    Where that is unset only a local master is accepted (tests): there the
    folder lies below the session's warehouse, which is on the same machine.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        shared = spark.conf.get("spark.sql.warehouse.dir")
    return f"{shared.rstrip('/')}/llm-{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and go on from the files (runs a job)."""
    path = scratch(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame) -> DataFrame:
    """``df`` with columns ``c0``, ``c1``, … and ``row``: an identity of each row that is the same whenever the frame is read again.

    Rows of a bare scan of files are known by file and place. Any other frame
    (there several rows may come from one place in a file) is written to the
    shared folder first, because row numbers that Spark gives while computing
    depend on how the work happens to be split.
    """
    place = ("file_path", "row_index")
    if df._jdf.queryExecution().analyzed().getClass().getSimpleName() == "LogicalRelation":
        try:
            row = F.struct(*[F.col(f"_metadata.{c}").alias(c) for c in place])
            return df.select("*", row).toDF(*positional(df)[1].columns, "row")
        except AnalysisException:  # no files, or a column of that name
            pass
    row = F.struct(F.lit("").alias(place[0]), F.monotonically_increasing_id().alias(place[1]))
    return stored(positional(df)[1].withColumn("row", row), "numbered")


def carried(df: DataFrame, **roles: str) -> tuple[list[str], DataFrame]:
    """Column names, and a frame of ``roles`` (name here: name in ``df``) and of all columns as one struct ``carried``.

    Whatever the columns of ``df`` are called, they can't clash with what an
    operator adds; :func:`released` gives them back.
    """
    names, inner = positional(df)
    whole = F.struct(*inner.columns)
    return names, inner.select(whole.alias("carried"), *[F.col(f"c{names.index(c)}").alias(r) for r, c in roles.items()])


def carried_once(df: DataFrame, text: str, **roles: str) -> tuple[list[str], DataFrame]:
    """Like :func:`carried`, with the texts once only: as bytes ``__text`` (null: empty) beside the struct.

    The struct tells at the text's place whether it is null; give :func:`released`
    the text's name and type to get the column back.
    """
    names, inner = positional(df)
    at = f"c{names.index(text)}"
    whole = F.struct(*[F.col(c).isNull().alias(c) if c == at else F.col(c) for c in inner.columns])
    return names, inner.select(whole.alias("carried"), as_bytes(at).alias("__text"),
                               *[F.col(f"c{names.index(c)}").alias(r) for r, c in roles.items()])


def carried_and(df: DataFrame, fields: str) -> StructType:
    """Schema of what an Arrow function makes of :func:`carried` rows: the struct as it is, and ``fields``."""
    return StructType([df.schema["carried"], *StructType.fromDDL(fields).fields])


def released(df: DataFrame, names: list[str], new: tuple[str, ...], once: tuple[str, DataType] | None = None) -> DataFrame:
    """The carried columns, without those that ``new`` ones replace, and the new ones; ``once``: the text of :func:`carried_once`."""
    kept = [i for i, n in enumerate(names) if n not in new]
    own = [F.col(f"carried.c{i}") for i in kept]
    if once and once[0] in names and names.index(once[0]) in kept:
        at = kept.index(names.index(once[0]))
        own[at] = F.when(~own[at], F.col("__text").cast(once[1]))
    return df.select(*own, *new).toDF(*[names[i] for i in kept], *new)


def bounded_batches(spark: SparkSession, rows: int = 4000, nbytes: int = 2**26) -> None:
    """Keep one Arrow batch of whole texts at a few dozen MB, or at ``nbytes``: a group's rows then go to the worker in several."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")) > rows:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    if int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", str(2**31 - 1)).removesuffix("b")) > nbytes:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(nbytes))


def positional(df: DataFrame) -> tuple[list[str], DataFrame]:
    """Column names, and ``df`` with its columns called ``c0``, ``c1``, … in order.

    Work on these, then give the names back with ``toDF``: no name of the
    input, not even one that differs from another by case only, can then clash.
    """
    return df.columns, df.toDF(*[f"c{i}" for i in range(len(df.columns))])


def text_or_empty(text: str = "text") -> Column:
    return F.coalesce(F.col(text), F.lit(""))


def as_bytes(text: str = "text") -> Column:
    """The text's UTF-8 bytes; null counts as empty."""
    return text_or_empty(text).cast("binary")


def total_bytes(df: DataFrame, text: str = "text") -> int:
    """Bytes of all texts: one number, it sizes blocks and shards so that each stays bounded."""
    return int(df.agg(F.sum(F.octet_length(F.col(text)))).first()[0] or 0)


def block_count(nbytes: int, block_bytes: int) -> int:
    return max(1, -(-nbytes // block_bytes))


class Memo(dict):
    """``make(key)`` with the latest results of short keys kept.

    A full memo becomes the old one, whose entries come back when they are asked
    for again: at most ``2 * entries`` results are held, and keys in steady use
    are not made anew.
    """

    def __init__(self, make: Callable, entries: int = MEMO_ENTRIES, key_chars: int = MEMO_KEY_CHARS):
        super().__init__()
        self.make, self.entries, self.key_chars, self.old = make, entries, key_chars, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(key) <= self.key_chars:
            if len(self) >= self.entries:
                self.old = dict(self)
                self.clear()
            self[key] = value
        return value


def byte_column(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``(all bytes, offsets)`` of a binary column without nulls, not copied."""
    n = len(column)
    if n == 0 or column.buffers()[2] is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    width = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    offsets = np.frombuffer(column.buffers()[1], width, n + 1, column.offset * np.dtype(width).itemsize)
    data = np.frombuffer(column.buffers()[2], np.uint8)
    return data[offsets[0]:offsets[-1]], offsets.astype(np.int64) - int(offsets[0])


def packed(values: np.ndarray) -> bytes:
    """Numbers byte by byte, all first bytes first: sorted ones compress well so; before them their number."""
    planes = values.view(np.uint8).reshape(len(values), values.itemsize).T.tobytes()
    return len(values).to_bytes(8, "little") + pa.compress(planes, "zstd", asbytes=True)


def unpacked(data: bytes | pa.Buffer, kind: str) -> np.ndarray:
    n, width = int.from_bytes(memoryview(data)[:8], "little"), np.dtype(kind).itemsize
    planes = pa.decompress(pa.py_buffer(data)[8:], n * width, "zstd") if n else b""
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(width, -1).T).view(kind).ravel()


def with_columns(batch: pa.RecordBatch, drop: tuple[str, ...], new: dict[str, pa.Array]) -> pa.RecordBatch:
    """The batch without ``drop`` and with ``new`` columns at the end."""
    kept = {n: batch.column(i) for i, n in enumerate(batch.schema.names) if n not in drop and n not in new}
    return pa.RecordBatch.from_pydict({**kept, **new})


def library_on_workers(spark: SparkSession) -> None:
    """Let Python workers import this library from where the driver did (a cluster may ship it by ``--py-files`` instead)."""
    root = str(Path(__file__).resolve().parents[2])
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, *paths]))


_caches: list[Callable[[], None]] = []
_owner: list[str] = [""]


def droppable(clear: Callable[[], None]) -> None:
    """Register what empties an operator's caches in a worker process."""
    _caches.append(clear)


def owned_by(name: str) -> None:
    """Called by a task's function before it works: caches that other operators left in this worker go.

    Workers outlive a stage, and what one stage keeps (codecs, memos) is of no
    use to the next. Tasks of one operator go on with what they have.
    """
    if _owner[0] == name:
        return
    _owner[0] = name
    for clear in _caches:
        clear()
    unused_returned()


def unused_returned() -> None:
    """Give memory that this process has freed back to the system, so that the two workers of an executor don't both hold their peaks."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def frugal(fn: Callable[..., pa.Table]) -> Callable[..., pa.Table]:
    """A function of one or two groups that gives what it has freed back to the system before it works and when its own arrays are gone."""
    if fn.__code__.co_argcount == 2:  # Spark tells the two kinds by their parameters
        def cogrouped(one: pa.Table, other: pa.Table) -> pa.Table:
            unused_returned()
            result = fn(one, other)
            unused_returned()
            return result

        return cogrouped

    def grouped(one: pa.Table) -> pa.Table:
        unused_returned()
        result = fn(one)
        unused_returned()
        return result

    return grouped


def map_batches(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | StructType) -> DataFrame:
    bounded_batches(df.sparkSession)
    library_on_workers(df.sparkSession)
    name = f"{fn.__module__}.{fn.__qualname__}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        owned_by(name)
        yield from fn(batches)

    return df.mapInArrow(run, schema)
