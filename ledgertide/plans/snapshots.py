"""Daily state: pool snapshots, backstop balances and LP token price."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import SRC_BACKFILL, SRC_STATE_FEED
from ..functions.numbers import lp_token_price, q4w_percent, scaled_amount, scaled_rate
from ..functions.timewindow import date_window, optional_window
from . import decode


def pool_snapshots(state: DataFrame, pools: Sequence[str] | None = None, start_date=None, end_date=None,
                   days_back: int = 90, mode: str = "key", now=None) -> DataFrame:
    """Last reserve state per pool, asset and day.

    One aggregation keeps the whole latest row (NULLs of it included) beside the
    greatest time and ledger of the day, so each map task sends one row per group.
    """
    if pools is not None:
        state = state.filter(F.col("contract_id").isin(list(pools)))
    state = date_window(state, "closed_at", start_date, end_date, days_back=days_back, now=now)
    return daily_reserve_state(decode.decode_reserve_state(state, mode))


_RESERVE_VALUES = ("b_rate", "d_rate", "b_supply", "d_supply", "last_time")


def daily_reserve_state(rows: DataFrame) -> DataFrame:
    values = F.struct(*[F.col(c) for c in _RESERVE_VALUES])
    order = F.struct("snapshot_timestamp", "ledger_sequence", values)
    return rows.groupBy("pool_id", "asset_address", "snapshot_date").agg(
        F.max("snapshot_timestamp").alias("snapshot_timestamp"),
        F.max("ledger_sequence").alias("ledger_sequence"),
        F.max_by(values, order).alias("_v"),
    ).select("pool_id", "asset_address", "snapshot_date", "snapshot_timestamp", "ledger_sequence", "_v.*")


def backstop_balances(state: DataFrame, contract: str | None = None, start_date=None, end_date=None,
                      pool_address: str | None = None, limit: int | None = None) -> DataFrame:
    """Last backstop balance per pool and day with the share queued for withdrawal."""
    if contract is not None:
        state = state.filter(F.col("contract_id") == contract)
    state = optional_window(state, "closed_at", start_date, end_date)
    rows = decode.decode_pool_balance(state)
    if pool_address is not None:
        rows = rows.filter(F.col("pool_address") == pool_address)
    values = ("snapshot_timestamp", "ledger_sequence", "shares", "tokens", "q4w")
    latest = rows.groupBy("pool_address", "snapshot_date").agg(
        F.max_by(F.struct(*values), F.struct("ledger_sequence", "snapshot_timestamp", "shares", "tokens", "q4w"))
        .alias("_v")).select("pool_address", "snapshot_date", "_v.*")
    out = latest.withColumns({
        "q4w_pct": q4w_percent(F.col("q4w"), F.col("shares")), "src": F.lit(SRC_BACKFILL)})
    return out.orderBy("pool_address", "snapshot_date").limit(limit) if limit is not None else out


def lp_prices(state: DataFrame, contract: str | None = None, start_date=None, end_date=None) -> DataFrame:
    """LP token price per day from share and quote-balance entries of one ledger.

    Of several entries in a ledger the greatest balance and the least share
    count above zero give the price, so each side is one row before the join.
    """
    if contract is not None:
        state = state.filter(F.col("contract_id") == contract)
    state = optional_window(state, "closed_at", start_date, end_date)
    shares = decode.decode_total_shares(state).groupBy("ledger_sequence", "price_date").agg(
        F.min(F.when(F.col("total_shares") > 0, F.col("total_shares"))).alias("total_shares"))
    quotes = decode.decode_quote_balance(state).groupBy("ledger_sequence").agg(F.max("quote_balance").alias("quote_balance"))
    both = shares.join(quotes, "ledger_sequence")
    priced = both.withColumn("lp_token_price", lp_token_price(F.col("quote_balance"), F.col("total_shares")))
    return priced.groupBy("price_date").agg(
        F.max_by(F.struct("lp_token_price", "ledger_sequence"), F.struct("ledger_sequence", "lp_token_price"))
        .alias("_v")).select("price_date", "_v.*")


def snapshots_from_state(reserve_state: DataFrame, day, at) -> DataFrame:
    """Reserve-state feed → pool snapshots of one day."""
    return reserve_state.select(
        "pool_id", F.col("asset_id").alias("asset_address"), F.lit(day).cast("date").alias("snapshot_date"),
        F.lit(at).cast("timestamp").alias("snapshot_timestamp"), "ledger_sequence",
        scaled_rate(F.col("b_rate")).alias("b_rate"), scaled_rate(F.col("d_rate")).alias("d_rate"),
        scaled_amount(F.col("b_supply")).alias("b_supply"), scaled_amount(F.col("d_supply")).alias("d_supply"),
        "last_time")


def balances_from_state(backstop_state: DataFrame, day, at) -> DataFrame:
    """Backstop-state feed → backstop balances of one day."""
    return backstop_state.select(
        F.col("pool_id").alias("pool_address"), F.lit(day).cast("date").alias("snapshot_date"),
        F.lit(at).cast("timestamp").alias("snapshot_timestamp"), "ledger_sequence", "shares", "tokens", "q4w",
        q4w_percent(F.col("q4w"), F.col("shares")).alias("q4w_pct"), F.lit(SRC_STATE_FEED).alias("src"))


def q4w_history(balances: DataFrame, pool_address: str, start_date=None, end_date=None) -> DataFrame:
    """Ordered history of one pool; both bounds are optional and inclusive."""
    rows = balances.filter(F.col("pool_address") == pool_address)
    if start_date is not None:
        rows = rows.filter(F.col("snapshot_date") >= F.lit(start_date).cast("date"))
    if end_date is not None:
        rows = rows.filter(F.col("snapshot_date") <= F.lit(end_date).cast("date"))
    return rows.select("snapshot_date", "shares", "tokens", "q4w", "q4w_pct").orderBy("snapshot_date")


def latest_q4w_by_pool(balances: DataFrame) -> DataFrame:
    from ..operators.dedup import latest_per

    cols = ["snapshot_date", "q4w_pct", "shares", "tokens", "q4w"]
    return latest_per(balances, ["pool_address"], cols, cols)
