"""Daily gap filling and running totals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _day(value) -> Column:
    return value if isinstance(value, Column) else F.lit(value).cast("date")


def day_series(df: DataFrame, start, end, name: str) -> DataFrame:
    """One row per input row and day of ``[start, end]`` (a lateral explode)."""
    return df.withColumn(name, F.explode(F.sequence(_day(start), _day(end))))


def forward_fill(
    facts: DataFrame, keys: Sequence[str], date_col: str, value_cols: Sequence[str], start, end,
    out_col: str = "day", order_cols: Sequence[str] = (), leading_nulls: bool = False,
) -> DataFrame:
    """Value of each key on every day of ``[start, end]``: the last fact on or before it.

    Facts are first reduced to one per key and day (latest by ``order_cols``).
    A fact then holds until the day before the key's next fact, so the filled
    series is an explode of those intervals: no calendar join, and a window group
    holds one row per day of its key.  Facts before ``start`` seed the first day.
    ``leading_nulls`` also emits the days before a key's first fact, valued NULL.
    """
    keys = list(keys)
    value = F.struct(*[F.col(c) for c in value_cols])
    order = F.struct(*[F.col(c) for c in (order_cols or value_cols)])
    start, end = _day(start), _day(end)
    daily = (
        facts.filter(F.col(date_col) <= end)
        .groupBy(*keys, F.col(date_col).alias("_from"))
        .agg(F.max_by(value, order).alias("_value"))
    )
    if leading_nulls:
        seeds = daily.select(*keys).distinct().select(
            *keys, F.lit("0001-01-01").cast("date").alias("_from"),
            F.lit(None).cast(daily.schema["_value"].dataType).alias("_value"))
        daily = daily.unionByName(seeds)
    following = F.lead("_from").over(Window.partitionBy(*keys).orderBy("_from"))
    spans = daily.select(
        *keys, "_from", "_value",
        F.greatest(F.col("_from"), start).alias("_lo"),
        F.least(F.coalesce(F.date_sub(following, 1), end), end).alias("_hi"),
    ).filter(F.col("_lo") <= F.col("_hi"))
    return spans.select(
        *keys, F.explode(F.sequence("_lo", "_hi")).alias(out_col), F.col("_from").alias("fact_date"),
        *[F.col("_value")[c].alias(c) for c in value_cols],
    )


def running_total(df: DataFrame, keys: Sequence[str], date_col: str, delta: Column, out_col: str) -> DataFrame:
    """Cumulative sum per key over days.

    The rows are summed per key and day before the window, so its groups hold one
    row per day whatever the number of input rows.
    """
    keys = list(keys)
    daily = df.groupBy(*keys, date_col).agg(F.sum(delta).alias("daily_delta"))
    w = Window.partitionBy(*keys).orderBy(date_col).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return daily.withColumn(out_col, F.sum("daily_delta").over(w))
