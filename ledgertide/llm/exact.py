"""Exact deduplication by block naming (operator 9).

Texts are cut into blocks of fixed size. Repeated blocks are sorted and numbered
within the partitions they hash to, and a block that occurs once takes a number
of its own, so that equal blocks and only they share an integer name. Then adjacent names are paired and the distinct pairs are named in
the same way, until each document has one name. Documents with as many blocks
are named in the same round, so (number of blocks, name) is an identity without
collisions: no digest decides.

DataFrame functions only. A round writes its names to the shared folder; only
the first round moves texts, every later one moves two integers per pair. The
names are joined on one more key than they were grouped by, so that both sides
of the join are plain exchanges and adaptive execution can split a hot block.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import numbered, stored, text_or_empty

BLOCK_BYTES = 4096


def folded(text: str) -> Column:
    """The text with A-Z lower-cased and nothing else; null counts as empty."""
    whole = text_or_empty(text)
    plain = F.octet_length(whole) == F.char_length(whole)
    return F.when(plain, F.lower(whole)).otherwise(F.translate(whole, string.ascii_uppercase, string.ascii_lowercase))


def named(rows: DataFrame, keys: list[str], check: Column) -> DataFrame:
    """``rows`` with ``keys`` replaced by ``name``: one integer for each distinct value of the keys.

    Values that occur more than once are numbered from 0 in sorted order by
    partition. A value that occurs once is like no other and takes a fresh
    number below -1 where it stands, so only repeated values are moved again.
    ``check`` is a value that follows from the keys.
    """
    names = (
        rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).where("__n > 1").sortWithinPartitions(*keys)
        .select(*keys, F.monotonically_increasing_id().alias("__name"), check.alias("__check"))
    )
    name = F.coalesce("__name", -2 - F.monotonically_increasing_id())
    return rows.withColumn("__check", check).join(names, [*keys, "__check"], "left").withColumn("name", name).drop(*keys, "__check", "__name")


def identities(df: DataFrame, doc_id: str = "doc_id", text: str = "text", block_bytes: int = BLOCK_BYTES,
               row: Column | None = None) -> DataFrame:
    """``row_id``, ``doc_id``, ``text_sha256``, ``blocks`` and ``name`` of every row; equal texts share the last two."""
    blocks = F.greatest(F.lit(1), F.ceil(F.octet_length("__text") / block_bytes)).cast("int")
    cut = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1),
                      lambda i: F.substring(F.col("__text"), i * block_bytes + 1, F.lit(block_bytes)))
    rows = (
        df.select((F.monotonically_increasing_id() if row is None else row).alias("row_id"), F.col(doc_id).alias("doc_id"),
                  folded(text).cast("binary").alias("__text"))
        .withColumn("blocks", blocks)
        .select("row_id", "doc_id", F.sha2("__text", 256).alias("text_sha256"), "blocks", F.col("blocks").alias("left"),
                F.posexplode(cut).alias("place", "block"))
    )
    current = stored(named(rows, ["block"], F.octet_length("block")), "names")
    done = []
    while True:
        done.append(current.where("left = 1"))
        current = current.where("left > 1")
        if current.isEmpty():
            break
        pairs = (
            current.groupBy("row_id", (F.col("place") / 2).cast("int").alias("place"))
            .agg(F.first("doc_id").alias("doc_id"), F.first("text_sha256").alias("text_sha256"),
                 F.first("blocks").alias("blocks"), F.ceil(F.first("left") / 2).cast("int").alias("left"),
                 F.max(F.when(F.col("place") % 2 == 0, F.col("name"))).alias("one"),
                 F.coalesce(F.max(F.when(F.col("place") % 2 == 1, F.col("name"))), F.lit(-1)).alias("two"))
        )
        current = stored(named(pairs, ["one", "two"], F.col("one") + F.col("two")), "names")
    whole = done[0]
    for part in done[1:]:
        whole = whole.unionByName(part)
    return whole.select("row_id", "doc_id", "text_sha256", "blocks", "name")


def exact_groups(df: DataFrame, doc_id: str = "doc_id", text: str = "text", block_bytes: int = BLOCK_BYTES,
                 row: Column | None = None) -> DataFrame:
    """Groups of rows whose texts are equal after lower-casing A-Z.

    One row per input row: ``row_id`` (``row`` if given), ``doc_id``, ``keep_id`` (largest ``doc_id`` of the
    group, nulls lowest), ``group_size``, ``kept`` (true for one row of each
    group; of repeated rows one stays) and ``text_sha256``. A null text counts
    as empty and empty texts are equal. Other columns are not carried.
    """
    rows = identities(df, doc_id, text, block_bytes, row)
    groups = rows.groupBy("blocks", "name").agg(
        F.max(F.struct("doc_id", "row_id")).alias("keep"), F.count(F.lit(1)).alias("group_size"),
        F.first("text_sha256").alias("__sha"))
    joined = rows.join(groups.select("*", F.col("__sha").alias("text_sha256")).drop("__sha"), ["blocks", "name", "text_sha256"])
    return joined.select("row_id", "doc_id", F.col("keep.doc_id").alias("keep_id"), "group_size",
                         (F.col("keep.row_id") == F.col("row_id")).alias("kept"), "text_sha256")


def one_per_group(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``df`` that stay, with all their columns: one of each group of equal texts."""
    rows, names = numbered(df), df.columns
    texts = rows.select("row", F.col(f"c{names.index(doc_id)}").alias("doc_id"), F.col(f"c{names.index(text)}").alias("text"))
    gone = exact_groups(texts, row=F.col("row")).where("NOT kept").select(F.col("row_id").alias("row"))
    return rows.join(gone, "row", "left_anti").drop("row").toDF(*names)


def op9_block_naming(documents: DataFrame) -> DataFrame:
    """Exact groups of all documents."""
    return exact_groups(documents).drop("row_id")


OP9_SQL = """
WITH folded AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(t) AS text_sha256
FROM folded WINDOW same AS (PARTITION BY t)
"""
