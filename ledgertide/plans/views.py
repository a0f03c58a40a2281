"""Derived frames over the lending events.

Those that aggregate also come as mergeable partials per key and day
(:data:`PARTIALS`): a table of them is kept by recounting the days that new
events touch, and the functions ``…_from_partials`` merge it to the same frame.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..operators.dedup import latest_per
from .explore import net_positions

B_RATE_ACTIONS = ("supply", "withdraw", "supply_collateral", "withdraw_collateral")
D_RATE_ACTIONS = ("borrow", "repay")


def user_positions(events: DataFrame) -> DataFrame:
    """Net positions per user, pool and asset with action count and last activity."""
    lending = events.filter(F.col("action_type").isin(*B_RATE_ACTIONS, *D_RATE_ACTIONS))
    return net_positions(
        lending, ["user_address", "pool_id", "asset_address"], F.count("*").alias("action_count"),
        F.max("ledger_closed_at").alias("last_action_time"))


def derived_rates(events: DataFrame) -> DataFrame:
    """Rate seen in each action: b_rate on the supply side, d_rate on the borrow side."""
    kind = F.when(F.col("action_type").isin(*B_RATE_ACTIONS), "b_rate").when(
        F.col("action_type").isin(*D_RATE_ACTIONS), "d_rate")
    return events.filter(F.col("implied_rate").isNotNull() & kind.isNotNull()).select(
        "id", "pool_id", "asset_address", "ledger_sequence", "action_type", kind.alias("rate_type"),
        "implied_rate", F.col("ledger_closed_at").alias("event_time"))


def latest_rates(events: DataFrame) -> DataFrame:
    return latest_per(derived_rates(events), ["pool_id", "asset_address", "rate_type"],
                      ["ledger_sequence", "id"], ["implied_rate", "ledger_sequence", "event_time"])


def daily_rate_stats(events: DataFrame) -> DataFrame:
    rates = derived_rates(events).withColumn("snapshot_date", F.to_date("event_time"))
    return rates.groupBy("pool_id", "asset_address", "rate_type", "snapshot_date").agg(
        F.avg("implied_rate").alias("avg_rate"), F.min("implied_rate").alias("min_rate"),
        F.max("implied_rate").alias("max_rate"), F.count("*").alias("samples"))


def user_claims(events: DataFrame) -> DataFrame:
    return events.filter(F.col("action_type") == "claim").select(
        "id", "user_address", "pool_id", "asset_address", F.col("amount_underlying").alias("claim_amount"),
        F.col("ledger_closed_at").alias("claim_time"))


def user_total_claims(events: DataFrame) -> DataFrame:
    return user_claims(events).groupBy("user_address").agg(
        F.sum("claim_amount").alias("total_claimed"), F.count("*").alias("claim_count"),
        F.min("claim_time").alias("first_claim"), F.max("claim_time").alias("last_claim"))


def positions_by_day(events: DataFrame) -> DataFrame:
    lending = events.filter(F.col("action_type").isin(*B_RATE_ACTIONS, *D_RATE_ACTIONS))
    return net_positions(
        lending, ["user_address", "pool_id", "asset_address", "event_date"], F.count("*").alias("action_count"),
        F.max("ledger_closed_at").alias("last_action_time"))


def rates_by_day(events: DataFrame) -> DataFrame:
    rates = derived_rates(events).withColumn("event_date", F.to_date("event_time"))
    return rates.groupBy("pool_id", "asset_address", "rate_type", "event_date").agg(
        F.sum("implied_rate").cast(_SUM).alias("rate_sum"), F.min("implied_rate").alias("min_rate"),
        F.max("implied_rate").alias("max_rate"), F.count("*").alias("samples"))


def claims_by_day(events: DataFrame) -> DataFrame:
    claims = user_claims(events).withColumn("event_date", F.to_date("claim_time"))
    return claims.groupBy("user_address", "event_date").agg(
        F.sum("claim_amount").alias("total_claimed"), F.count("*").alias("claim_count"),
        F.min("claim_time").alias("first_claim"), F.max("claim_time").alias("last_claim"))


_SUM = "decimal(38,12)"
_PARTIAL = {"event_date": schemas._D}
#: Table of partials: schema, and how it comes from the events (with ``event_date``) of whole days.
PARTIALS = {
    "positions_by_day": (schemas._struct(
        user_address=schemas._S, pool_id=schemas._S, asset_address=schemas._S, supply_btokens=schemas.INT38,
        collateral_btokens=schemas.INT38, debt_dtokens=schemas.INT38, action_count=schemas._L, last_action_time=schemas._TS,
        **_PARTIAL), positions_by_day),
    "rates_by_day": (schemas._struct(
        pool_id=schemas._S, asset_address=schemas._S, rate_type=schemas._S, rate_sum=schemas.RATE,
        min_rate=schemas.PARSED_EVENTS["implied_rate"].dataType, max_rate=schemas.PARSED_EVENTS["implied_rate"].dataType,
        samples=schemas._L, **_PARTIAL), rates_by_day),
    "claims_by_day": (schemas._struct(
        user_address=schemas._S, total_claimed=schemas.INT38, claim_count=schemas._L, first_claim=schemas._TS,
        last_claim=schemas._TS, **_PARTIAL), claims_by_day),
}


def user_positions_from_partials(partials: DataFrame) -> DataFrame:
    """:func:`user_positions` from ``positions_by_day``."""
    return partials.groupBy("user_address", "pool_id", "asset_address").agg(
        *[F.sum(c).alias(c) for c in ("supply_btokens", "collateral_btokens", "debt_dtokens", "action_count")],
        F.max("last_action_time").alias("last_action_time"))


def daily_rate_stats_from_partials(partials: DataFrame) -> DataFrame:
    """:func:`daily_rate_stats` from ``rates_by_day``."""
    return partials.select(
        "pool_id", "asset_address", "rate_type", F.col("event_date").alias("snapshot_date"),
        (F.col("rate_sum") / F.col("samples")).alias("avg_rate"), "min_rate", "max_rate", "samples")


def user_total_claims_from_partials(partials: DataFrame) -> DataFrame:
    """:func:`user_total_claims` from ``claims_by_day``."""
    return partials.groupBy("user_address").agg(
        F.sum("total_claimed").alias("total_claimed"), F.sum("claim_count").alias("claim_count"),
        F.min("first_claim").alias("first_claim"), F.max("last_claim").alias("last_claim"))


def daily_rates(snapshots: DataFrame) -> DataFrame:
    """Pool rates per day, as the balance queries read them."""
    return snapshots.select("pool_id", "asset_address", F.col("snapshot_date").alias("rate_date"), "b_rate", "d_rate")


def user_action_log(events: DataFrame, user: str, limit: int = 50) -> DataFrame:
    return events.filter(F.col("user_address") == user).orderBy(
        F.col("ledger_sequence").desc(), F.col("id")).limit(limit)
