"""Scans of the two ledger logs, batch and streaming."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions.timewindow import date_window, ledger_range
from . import bronze


def scan_state(
    spark: SparkSession, path: str, contracts: Sequence[str] | None = None, start=None, end=None,
    first_ledger: int | None = None, last_ledger: int | None = None, newest: int | None = None, **window,
) -> DataFrame:
    """Contract-state change log; contract, time and ledger bounds reach the scan.

    A range of ledgers becomes a range of days by the log's ledger table.
    ``newest`` asks for the ledgers from the newest one less ``newest``.
    """
    return _bounded(spark.read.schema(schemas.STORED_CONTRACT_DATA).parquet(path), path, contracts, start, end,
                    first_ledger, last_ledger, newest, window)


def scan_events(
    spark: SparkSession, path: str, contracts: Sequence[str] | None = None, start=None, end=None,
    first_ledger: int | None = None, last_ledger: int | None = None, newest: int | None = None, **window,
) -> DataFrame:
    """Contract-event log with the same pushed-down bounds."""
    return _bounded(spark.read.schema(schemas.STORED_CONTRACT_EVENTS).parquet(path), path, contracts, start, end,
                    first_ledger, last_ledger, newest, window)


def _bounded(df, path, contracts, start, end, first_ledger, last_ledger, newest, window) -> DataFrame:
    if newest is not None:
        at = bronze.newest_ledger(df.sparkSession, path)
        if at is None:  # no ledger table, or nothing in it
            at = df.agg(F.max("ledger_sequence")).first()[0]
        first_ledger = max(first_ledger or 0, (at or 0) - newest)
    df = bronze.in_days_of(df, path, first_ledger, last_ledger)
    if contracts is not None:
        df = df.filter(F.col("contract_id").isin(list(contracts)))
    if start is not None or end is not None or window:
        df = date_window(df, "closed_at", start, end, **window)
    return ledger_range(df, first_ledger, last_ledger)


def read_reserve_state(spark: SparkSession, path: str) -> DataFrame:
    """Reserve-state feed: rates, supplies, emissions and oracle price per pool and asset."""
    return spark.read.schema(schemas.RESERVE_STATE).parquet(path)


def read_backstop_state(spark: SparkSession, path: str) -> DataFrame:
    """Backstop-state feed: shares, tokens, queued amount and emissions per pool."""
    return spark.read.schema(schemas.BACKSTOP_STATE).parquet(path)


def stream_events(spark: SparkSession, path: str, start_at: str | int = "earliest",
                  max_files: int | None = None, remember: str | None = None) -> DataFrame:
    """Contract-event stream over a directory of Parquet files.

    ``start_at``: ``"earliest"``, ``"latest"`` (only ledgers above what is there
    at the first start) or a ledger number. ``remember`` is a table beside the
    stream's checkpoint that keeps the ledger found at the first start; a
    restart reads it, so nothing that landed in between is passed over.
    """
    reader = spark.readStream.schema(schemas.STREAM_EVENTS)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    stream = reader.parquet(path)
    if start_at == "earliest":
        return stream
    if start_at == "latest":
        return stream.filter(F.col("ledger_sequence") > _start_ledger(spark, path, remember))
    return stream.filter(F.col("ledger_sequence") >= int(start_at))


def _start_ledger(spark: SparkSession, path: str, remember: str | None) -> int:
    """The newest ledger at the stream's first start; -1 if there is none."""
    if remember:
        try:
            return spark.read.schema("ledger bigint").parquet(remember).first()[0]
        except AnalysisException:  # first start: the table does not exist
            pass
    newest = spark.read.schema(schemas.STREAM_EVENTS).parquet(path).agg(
        F.coalesce(F.max("ledger_sequence"), F.lit(-1)).alias("ledger"))
    if not remember:
        return newest.first()[0]
    newest.write.parquet(remember)
    return spark.read.schema("ledger bigint").parquet(remember).first()[0]


def normalise_close_time(df: DataFrame, column: str = "ledger_closed_at") -> DataFrame:
    """Close time given as epoch milliseconds → timestamp; timestamps pass through."""
    if dict(df.dtypes)[column] == "bigint":
        return df.withColumn(column, F.timestamp_millis(column))
    return df


def stream_state_batches(spark: SparkSession, path: str, max_files: int | None = None,
                         one_per_line: bool = True) -> DataFrame:
    """Micro-batches of state changes: JSON payloads ``{events: […], timestamp, network}``.

    A file holds one payload per line, or (``one_per_line=False``) a single one.
    """
    reader = spark.readStream.schema(schemas.STATE_BATCH).option("multiLine", not one_per_line)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.json(path)


def split_state_batches(payloads: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(state entries, malformed payloads)``; a payload without ``events`` is malformed."""
    malformed = payloads.filter(F.col("events").isNull()).select(
        F.lit("payload without events array").alias("reject_reason"), "timestamp", "network")
    e = F.col("e")
    entries = payloads.select(F.explode("events").alias("e")).select(
        e["contract_id"].alias("contract_id"),
        F.try_to_timestamp(e["closed_at"]).alias("closed_at"),
        e["ledger_sequence"].alias("ledger_sequence"),
        e["ledger_key_hash"].alias("ledger_key_hash_base_64"),
        e["ledger_entry_change"].cast("long").alias("ledger_entry_change"),
        F.coalesce(e["deleted"], F.lit(False)).alias("deleted"),
        e["key_decoded"].alias("key_decoded"), e["val_decoded"].alias("val_decoded"),
    )
    return entries, malformed


def pool_dimension(spark: SparkSession, rows: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Tracked pools ``(pool_id, name, version)`` as a small table."""
    return spark.createDataFrame(list(rows), "pool_id string, name string, version string")


def tracked(df: DataFrame, pools: DataFrame, column: str = "contract_id") -> DataFrame:
    """Rows whose contract is a tracked pool."""
    return df.join(pools.select(F.col("pool_id").alias(column)).distinct(), column, "left_semi")


def flatten_discovery(pools: DataFrame) -> DataFrame:
    """``(pool_id, assets: array<…>)`` → one row per pool and reserve index."""
    return pools.select("pool_id", F.posexplode("assets").alias("reserve_index", "asset_address"))
