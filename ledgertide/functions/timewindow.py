"""Time predicates and normalisation.

Every window is written against the raw time column with constant bounds, so it
reaches the Parquet scan; a date partition column, where the table has one, gets
the matching bounds and prunes whole partitions.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import ALL_TIME_START


def _as_datetime(value: str | date | datetime) -> datetime:
    if isinstance(value, datetime):
        return value
    if isinstance(value, date):
        return datetime(value.year, value.month, value.day)
    return datetime.fromisoformat(value.replace("Z", "+00:00")).replace(tzinfo=None)


def _now(now) -> datetime:
    return _as_datetime(now) if now is not None else datetime.now(timezone.utc).replace(tzinfo=None)


def window_bounds(
    start=None, end=None, *, days_back: int = 90, end_inclusive: bool = True,
    lookback_from_end: bool = True, widen_days: int = 0, now=None,
) -> tuple[datetime | None, datetime | None]:
    """``[low, high)`` bounds of the four ways to give a range.

    * start and end: both hold, and the whole end day is inside (``end_inclusive``)
    * start only: open end
    * end only: ``days_back`` days before end (unless ``lookback_from_end`` is off)
    * neither: the last ``days_back`` days before ``now``

    ``widen_days`` moves the lower bound further back (existence probes).
    """
    low = _as_datetime(start) if start is not None else None
    high = _as_datetime(end) if end is not None else None
    if low is None and high is None:
        low = _now(now) - timedelta(days=days_back)
    elif low is None and lookback_from_end:
        low = high - timedelta(days=days_back)
    if high is not None and end_inclusive:
        high = high + timedelta(days=1)
    if low is not None and widen_days:
        low = low - timedelta(days=widen_days)
    return low, high


def between(df: DataFrame, column: str, low: datetime | None, high: datetime | None,
            partition_col: str | None = None) -> DataFrame:
    """Keep ``low <= column < high``; literals take the column's own type.

    A log with a ``date`` partition column (the day of ``closed_at``) is pruned by it.
    """
    kind = df.schema[column].dataType
    if partition_col is None and column == "closed_at" and "date" in df.columns:
        partition_col = "date"
    if low is not None:
        df = df.filter(F.col(column) >= F.lit(low.isoformat(sep=" ")).cast(kind))
        if partition_col:
            df = df.filter(F.col(partition_col) >= F.lit(low.date()))
    if high is not None:
        df = df.filter(F.col(column) < F.lit(high.isoformat(sep=" ")).cast(kind))
        if partition_col:
            df = df.filter(F.col(partition_col) <= F.lit(high.date()))
    return df


def date_window(df: DataFrame, column: str, start=None, end=None, *, partition_col: str | None = None,
                **options) -> DataFrame:
    """Filter to the window described by :func:`window_bounds`."""
    low, high = window_bounds(start, end, **options)
    return between(df, column, low, high, partition_col)


def optional_window(df: DataFrame, column: str, start=None, end=None, *, end_inclusive: bool = False,
                    partition_col: str | None = None) -> DataFrame:
    """Half-open range in which a missing bound simply does not apply."""
    if start is None and end is None:
        return df
    low, high = window_bounds(start, end, end_inclusive=end_inclusive, lookback_from_end=False)
    return between(df, column, low, high, partition_col)


def ledger_range(df: DataFrame, first: int | None = None, last: int | None = None,
                 column: str = "ledger_sequence") -> DataFrame:
    """Ledger bounds, inclusive on both sides."""
    if first is not None:
        df = df.filter(F.col(column) >= first)
    if last is not None:
        df = df.filter(F.col(column) <= last)
    return df


_PRESET_DAYS = {"7d": 7, "30d": 30, "90d": 90, "1y": 365}


def preset_window(preset: str, now=None) -> tuple[datetime, datetime]:
    """Bounds of a named range; unknown names mean all time."""
    end = _now(now)
    days = _PRESET_DAYS.get(preset)
    return (end - timedelta(days=days) if days else _as_datetime(ALL_TIME_START)), end


def iso_z(ts: Column) -> Column:
    """UTC wall-clock text such as ``2024-01-31T23:59:00Z``."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def parse_day(value: Column) -> Column:
    """Date from ``2024-01-31``, ``2024-01-31T…`` or a timestamp text; else NULL."""
    head = F.substring(F.trim(value.cast("string")), 1, 10)
    return F.try_to_date(head, "yyyy-MM-dd")


def parse_instant(value: Column) -> Column:
    """Timestamp from ISO text, SQL text, epoch seconds or epoch milliseconds."""
    text = F.trim(value.cast("string"))
    epoch = F.when(text.rlike(r"^\d{9,10}$"), F.timestamp_seconds(text.try_cast("long"))).when(
        text.rlike(r"^\d{12,14}$"), F.timestamp_millis(text.try_cast("long")))
    return F.coalesce(epoch, text.try_cast("timestamp"))
