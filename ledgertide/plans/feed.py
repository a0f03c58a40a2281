"""Live feed of one pool's latest events: from both event tables, or from a table that keeps the newest ones."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import schemas

_FEED = ("id", "time", "action_type", "source", "user_address", "amount", "asset_address", "transaction_hash",
         "ledger_sequence")

#: A maintained feed: the newest events of each pool and source.
LIVE_FEED = schemas._struct(
    pool_id=schemas._S, id=schemas._S, time=schemas._TS, action_type=schemas._S, source=schemas._S, user_address=schemas._S,
    amount=schemas.INT38, asset_address=schemas._S, transaction_hash=schemas._S, ledger_sequence=schemas._L)


def feed_rows(events: DataFrame, source: str) -> DataFrame:
    """Events of one of the two tables (``source``: pool or backstop) in the shape of the feed; those without a pool never show."""
    pool, amount = ("pool_id", "amount_underlying") if source == "pool" else ("pool_address", "lp_tokens")
    rows = events.select(
        F.col(pool).alias("pool_id"), "id", F.col("ledger_closed_at").alias("time"), "action_type", F.lit(source).alias("source"),
        "user_address", F.col(amount).alias("amount"), *(["asset_address"] if source == "pool" else []), "transaction_hash",
        "ledger_sequence")
    return schemas.conform(rows, LIVE_FEED).filter(F.col("pool_id").isNotNull())


def feed_of_pool(feed: DataFrame, pool_id: str, limit: int = 50, tokens: DataFrame | None = None) -> DataFrame:
    """What :func:`live_feed` gives, from the maintained feed: reads its rows of one pool, not the event tables."""
    rank = F.row_number().over(Window.partitionBy("source").orderBy(F.col("time").desc(), "id"))
    rows = feed.filter(F.col("pool_id") == pool_id).withColumn("_rank", rank).filter(F.col("_rank") <= limit).select(*_FEED)
    return _shown(rows, tokens)


def _shown(rows: DataFrame, tokens: DataFrame | None) -> DataFrame:
    if tokens is not None:
        rows = rows.join(tokens.select("asset_address", F.col("symbol").alias("asset_symbol")), "asset_address", "left")
    return rows.orderBy(F.col("time").desc(), F.col("id"))


def latest_of_pool(events: DataFrame, pool_col: str, pool_id: str, limit: int) -> DataFrame:
    """Latest rows of one pool (top-k per task, then over the tasks' results)."""
    return events.filter(F.col(pool_col) == pool_id).orderBy(
        F.col("ledger_closed_at").desc(), F.col("id")).limit(limit)


def live_feed(actions: DataFrame, backstop: DataFrame, pool_id: str, limit: int = 50, tokens: DataFrame | None = None,
              include_actions: bool = True, include_backstop: bool = True) -> DataFrame:
    parts = []
    if include_actions:
        parts.append(latest_of_pool(actions, "pool_id", pool_id, limit).select(
            "id", F.col("ledger_closed_at").alias("time"), "action_type", F.lit("pool").alias("source"),
            "user_address", F.col("amount_underlying").alias("amount"), "asset_address", "transaction_hash",
            "ledger_sequence"))
    if include_backstop:
        parts.append(latest_of_pool(backstop, "pool_address", pool_id, limit).select(
            "id", F.col("ledger_closed_at").alias("time"), "action_type", F.lit("backstop").alias("source"),
            "user_address", F.col("lp_tokens").alias("amount"), "transaction_hash", "ledger_sequence"))
    if not parts:
        raise ValueError("the feed needs at least one of the two event tables")
    rows = parts[0]
    for more in parts[1:]:
        rows = rows.unionByName(more, allowMissingColumns=True)
    if "asset_address" not in rows.columns:
        rows = rows.withColumn("asset_address", F.lit(None).cast("string"))
    return _shown(rows.select(*_FEED), tokens)
