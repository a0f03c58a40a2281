"""Deterministic deduplication and first/last-per-key selection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _keep_one(df: DataFrame, keys: Sequence[str | Column], order: Sequence[Column]) -> DataFrame:
    # A `row_number() = 1` filter becomes a group limit before the shuffle, so of
    # a huge group of copies each map task sends one row.
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def dedup_first(df: DataFrame, keys: Sequence[str | Column], order_cols: Sequence[str]) -> DataFrame:
    """One row per key: the first by ``order_cols``."""
    return _keep_one(df, keys, [F.col(c).asc_nulls_last() for c in order_cols])


def dedup_last(df: DataFrame, keys: Sequence[str | Column], order_cols: Sequence[str]) -> DataFrame:
    """One row per key: the last by ``order_cols`` (last writer wins)."""
    return _keep_one(df, keys, [F.col(c).desc_nulls_last() for c in order_cols])


def latest_per(df: DataFrame, keys: Sequence[str | Column], order_cols: Sequence[str],
               cols: Sequence[str]) -> DataFrame:
    """Columns of the latest row per key (NULLs kept), by one combined aggregation."""
    return _pick(df, keys, order_cols, cols, F.max_by)


def earliest_per(df: DataFrame, keys: Sequence[str | Column], order_cols: Sequence[str],
                 cols: Sequence[str]) -> DataFrame:
    return _pick(df, keys, order_cols, cols, F.min_by)


def _pick(df, keys, order_cols, cols, choose) -> DataFrame:
    if len(cols) == 1 and len(order_cols) == 1:
        # Fixed-width value and order aggregate by hash, a struct only by sorting.
        return df.groupBy(*keys).agg(choose(F.col(cols[0]), F.col(order_cols[0])).alias(cols[0]))
    picked = df.groupBy(*keys).agg(
        choose(F.struct(*[F.col(c) for c in cols]), F.struct(*[F.col(c) for c in order_cols])).alias("_row"))
    names = [c for c in picked.columns if c != "_row"]
    return picked.select(*names, *[F.col("_row")[c].alias(c) for c in cols])


def duplicate_keys(df: DataFrame, key: str, sample: int = 5) -> DataFrame:
    """Report of keys that occur more than once, most frequent first."""
    return (
        df.groupBy(key).agg(F.count("*").alias("occurrences")).filter(F.col("occurrences") > 1)
        .orderBy(F.col("occurrences").desc(), F.col(key)).limit(sample)
    )
