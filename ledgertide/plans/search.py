"""Searches over raw events and encoded transactions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import AUCTION_ACTIONS, LEDGERS_PER_DAY
from ..sources.ledger import scan_events
from .decode import with_action


def topic_window_search(
    events: DataFrame, action: str = "bad_debt", n_ledgers: int = LEDGERS_PER_DAY,
    fallback: Sequence[str] = AUCTION_ACTIONS, contract: str | None = None, topics: str = "topics_decoded",
) -> DataFrame:
    """Events with a first topic in the last ``n_ledgers`` ledgers.

    If there is none, events with one of the ``fallback`` topics.  Both sizes are
    decided inside one plan: the newest ledger and the existence test are scalar
    subqueries.
    """
    newest = events.agg(F.max("ledger_sequence").alias("m")).scalar()
    recent = events.filter(F.col("ledger_sequence") >= newest - F.lit(n_ledgers))
    if contract is not None:
        recent = recent.filter(F.col("contract_id") == contract)
    named = with_action(recent, topics)
    hits = named.filter(F.col("action_type") == action)
    instead = named.filter(F.col("action_type").isin(list(fallback))).where(~hits.exists())
    return hits.unionByName(instead)


def search_log(
    spark: SparkSession, path: str, action: str = "bad_debt", n_ledgers: int = LEDGERS_PER_DAY,
    fallback: Sequence[str] = AUCTION_ACTIONS, contract: str | None = None,
) -> DataFrame:
    """:func:`topic_window_search` over a stored log, of which only the days of these ledgers are read."""
    recent = scan_events(spark, path, newest=n_ledgers)
    return topic_window_search(recent, action, n_ledgers, fallback, contract)


def contains_bytes(encoded: Column, needle: bytes) -> Column:
    """Whether base64-encoded content holds a byte sequence."""
    return F.coalesce(F.contains(F.unbase64(encoded), F.lit(bytearray(needle))), F.lit(False))


def byte_scan(transactions: DataFrame, needle: bytes, envelope: str = "envelope", meta: str = "meta") -> DataFrame:
    """Transactions whose envelope or result metadata holds the bytes."""
    flagged = transactions.withColumns({
        "in_envelope": contains_bytes(F.col(envelope), needle), "in_meta": contains_bytes(F.col(meta), needle)})
    return flagged.filter(F.col("in_envelope") | F.col("in_meta"))
