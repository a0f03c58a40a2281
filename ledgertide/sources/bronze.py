"""Stored layout of the two raw logs.

The logs keep their JSON as it came.  What every query filters by is stored beside
it as plain columns, because a predicate on a JSON path never reaches the scan:
the kind of entry or action, the address in an entry's key, and the day, by which
the files are partitioned. Within a file rows are sorted by kind, contract and
address, so row groups of others are skipped by their statistics; a Bloom filter
per row group tells an address that lies between two others.

Beside the log lies a small table of each day's least and greatest ledger
(``_ledgers``, which readers of the log do not see). It turns a range of ledgers
into a range of days before the log is scanned. It knows what :func:`land` wrote,
so a log that has it must be written by nothing else.
"""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.jsonvalues import json_scalar

DAY = "date"
ADDRESS = "key_address"
_MAP = "date date, first_ledger bigint, last_ledger bigint"
#: Files written up to so long before a landing began are read again for the map; clocks of store and driver may differ.
_SLACK = dt.timedelta(hours=1)


def with_state_layout(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "entry_type": F.get_json_object("key_decoded", "$.vec[0].symbol"),
        ADDRESS: json_scalar(F.col("key_decoded"), "$.vec[1].address"), DAY: F.to_date("closed_at")})


def with_event_layout(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "action_type": F.get_json_object("topics_decoded", "$[0].symbol"), DAY: F.to_date("closed_at")})


def land(df: DataFrame, path: str, mode: str = "errorifexists", addresses: int = 100_000, **options) -> None:
    """Write a log in this layout and note its ledgers; a day too large for one task is split.

    ``addresses`` sizes the Bloom filters: distinct addresses of a row group.
    ``options`` go to the Parquet writer.
    """
    kind = "entry_type" if "entry_type" in df.columns else "action_type"
    order = [DAY, kind, "contract_id", *([ADDRESS] if ADDRESS in df.columns else []), "closed_at"]
    writer = df.hint("rebalance", DAY).sortWithinPartitions(*order).write.mode(mode).partitionBy(DAY).options(**options)
    if ADDRESS in df.columns:
        writer = writer.option(f"parquet.bloom.filter.enabled#{ADDRESS}", "true").option(
            f"parquet.bloom.filter.expected.ndv#{ADDRESS}", addresses)
    began = dt.datetime.now(dt.timezone.utc)
    writer.parquet(path)
    if "ledger_sequence" in df.columns:
        _note_ledgers(df.sparkSession, path, began - _SLACK, mode)


def _map_path(path: str) -> str:
    return f"{path.rstrip('/')}/_ledgers"


def _note_ledgers(spark: SparkSession, path: str, since: dt.datetime, mode: str) -> None:
    """Add the days of the files that a landing wrote; days may be noted more than once."""
    rows = spark.read.schema(f"ledger_sequence bigint, {DAY} date").parquet(path)
    fresh = rows.filter(F.col("_metadata.file_modification_time") >= F.lit(since)) if mode == "append" else rows
    fresh.groupBy(DAY).agg(F.min("ledger_sequence").alias("first_ledger"), F.max("ledger_sequence").alias("last_ledger")).select(
        DAY, "first_ledger", "last_ledger").coalesce(1).write.mode("append" if mode == "append" else "overwrite").parquet(_map_path(path))


def ledger_days(spark: SparkSession, path: str) -> DataFrame | None:
    """Each day's least and greatest ledger; ``None`` for a log without the table."""
    try:
        noted = spark.read.schema(_MAP).parquet(_map_path(path))
    except AnalysisException:
        return None
    return noted.groupBy(DAY).agg(F.min("first_ledger").alias("first_ledger"), F.max("last_ledger").alias("last_ledger"))


def newest_ledger(spark: SparkSession, path: str) -> int | None:
    days = ledger_days(spark, path)
    return None if days is None else days.agg(F.max("last_ledger")).first()[0]


def in_days_of(df: DataFrame, path: str, first: int | None = None, last: int | None = None) -> DataFrame:
    """Rows of the days on which ledgers of the range (inclusive) closed; all rows if that is not known."""
    days = None if first is None and last is None else ledger_days(df.sparkSession, path)
    if days is None:
        return df
    if first is not None:
        days = days.filter(F.col("last_ledger") >= first)
    if last is not None:
        days = days.filter(F.col("first_ledger") <= last)
    low, high, unknown = days.agg(F.min(DAY), F.max(DAY), F.count_if(F.col(DAY).isNull()) > 0).first()
    inside = F.lit(False) if low is None else F.col(DAY).between(F.lit(low), F.lit(high))
    return df.filter(inside | F.col(DAY).isNull() if unknown else inside)
