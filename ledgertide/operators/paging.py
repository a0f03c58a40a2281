"""Paging and top-k."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def ordering(column: str, direction: str = "desc", tiebreak: Sequence[str] = ()) -> list[Column]:
    """Sort columns with a unique tiebreak, NULLs at the end either way."""
    main = F.col(column).asc_nulls_last() if direction == "asc" else F.col(column).desc_nulls_last()
    return [main, *[F.col(c).asc() for c in tiebreak]]


def page(df: DataFrame, order: Sequence[Column], limit: int | None, offset: int = 0) -> DataFrame:
    """One page; with a limit Spark keeps only ``offset + limit`` rows per task."""
    df = df.orderBy(*order)
    if offset:
        df = df.offset(offset)
    return df.limit(limit) if limit is not None else df


def page_with_total(df: DataFrame, order: Sequence[Column], limit: int | None, offset: int = 0) -> DataFrame:
    """The page with the size of the whole result in ``total_count``.

    The total is an uncorrelated scalar subquery: the unpaged rows are counted
    where they are and never meet in one task.  It keeps every column alive (the
    sample row is thrown away), so that it reads the same shuffle as the page
    instead of aggregating the source a second time with fewer columns.
    """
    counted = F.struct(F.count("*").alias("n"), F.any_value(F.struct(*df.columns)).alias("sample"))
    total = df.agg(counted.alias("t")).scalar()["n"]
    return page(df, order, limit, offset).withColumn("total_count", total)


def top_k_ranked(df: DataFrame, k: int, order: Sequence[Column], rank_col: str = "rank") -> DataFrame:
    """Top k rows with their global rank.

    The k rows are cut out first; only those k are numbered in a single group.
    """
    best = df.orderBy(*order).limit(k)
    return best.withColumn(rank_col, F.row_number().over(Window.orderBy(*order)).cast("long"))
