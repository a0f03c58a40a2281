"""Table statistics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def table_stats(df: DataFrame, date_col: str | None = None, distinct: Mapping[str, str] | Sequence[str] = ()) -> DataFrame:
    """Row count, first and last value of ``date_col`` and exact distinct counts.

    ``distinct`` maps output names to columns (or lists columns; ``unique_<c>``).
    """
    names = dict(distinct) if isinstance(distinct, Mapping) else {f"unique_{c}": c for c in distinct}
    aggs = [F.count("*").alias("total_rows")]
    if date_col:
        aggs += [F.min(date_col).alias("earliest"), F.max(date_col).alias("latest")]
    aggs += [F.count_distinct(F.col(c)).alias(name) for name, c in names.items()]
    return df.agg(*aggs)


def action_counts(df: DataFrame, column: str = "action_type") -> DataFrame:
    counts = df.groupBy(column).agg(F.count("*").alias("n"))
    return counts.orderBy(F.col("n").desc(), F.col(column))


def breakdown(df: DataFrame, *columns: str) -> DataFrame:
    return df.groupBy(*columns).agg(F.count("*").alias("n"))


def day_coverage(df: DataFrame, date_col: str, expected_start, expected_end) -> DataFrame:
    """Days spanned by the table against the days it should span."""
    lo, hi = F.lit(expected_start).cast("date"), F.lit(expected_end).cast("date")
    span = df.agg(
        F.min(F.to_date(date_col)).alias("earliest"), F.max(F.to_date(date_col)).alias("latest"),
        F.count_distinct(F.to_date(date_col)).alias("days_present"))
    return span.select(
        "earliest", "latest", "days_present",
        (F.date_diff("latest", "earliest") + 1).cast("long").alias("days_covered"),
        F.date_diff(hi, lo).cast("long").alias("expected_days"),
        ((F.col("earliest") <= lo) & (F.col("latest") >= hi)).alias("complete"),
    )


def watermark(df: DataFrame, ledger_col: str = "ledger_sequence", date_col: str | None = None) -> DataFrame:
    """Highest ledger (and day) already stored: where an incremental run resumes."""
    aggs = [F.max(ledger_col).alias("last_ledger")]
    if date_col:
        aggs.append(F.max(date_col).alias("last_date"))
    return df.agg(*aggs)
