"""Exploration queries over the lending events.

Amounts in the events are raw integers with 7 decimals.  Pool and token names are
joined after the events have been aggregated by address, never to the events
themselves.  Prices come as a table ``(symbol, price)``; a symbol without a price
is worth 0.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import DEPOSIT_ACTIONS, WITHDRAW_ACTIONS
from ..functions.timewindow import iso_z, optional_window
from ..operators.dedup import latest_per
from ..operators.paging import ordering, page, page_with_total, top_k_ranked

_UNIT = 1e7


def tokens_of(raw_sum: Column) -> Column:
    return raw_sum.cast("double") / _UNIT


def latest_symbol_prices(prices: DataFrame, tokens: DataFrame) -> DataFrame:
    """Latest price of each token (one price per token and day), by upper-cased symbol."""
    latest = latest_per(prices, ["token_address"], ["price_date"], ["usd_price"])
    named = latest.join(tokens.select(F.col("asset_address").alias("token_address"), "symbol"), "token_address")
    return named.groupBy(F.upper("symbol").alias("symbol")).agg(F.max("usd_price").alias("price"))


def with_price(df: DataFrame, prices: DataFrame, symbol_col: str = "asset_symbol") -> DataFrame:
    """Adds ``price`` by upper-cased symbol, 0 where there is none.

    The rows this is used on are already aggregated; whether the price side is
    broadcast is left to the measured sizes.
    """
    looked = df.join(prices.select(F.upper("symbol").alias("_symbol"), F.col("price").cast("double").alias("price")),
                     F.upper(F.col(symbol_col)) == F.col("_symbol"), "left").drop("_symbol")
    return looked.withColumn("price", F.coalesce("price", F.lit(0.0)))


def native_threshold(minimum: float, price: float, in_usd: bool) -> float:
    """A threshold in USD as token amount; without a usable price it stays as given."""
    return minimum / price if in_usd and price > 0 else minimum


def with_symbol(df: DataFrame, tokens: DataFrame) -> DataFrame:
    names = tokens.select("asset_address", F.col("symbol").alias("asset_symbol"), F.col("name").alias("asset_name"))
    return df.join(names, "asset_address", "left")


def accounts_by_min_deposit(history: DataFrame, asset_address: str, min_amount: float, price: float = 0.0,
                            in_usd: bool = False, limit: int | None = 100, offset: int = 0,
                            order_dir: str = "desc", order_by: str = "total_deposited") -> DataFrame:
    """Accounts whose deposits of one asset reach a threshold, with the total count."""
    threshold = native_threshold(min_amount, price, in_usd)
    accounts = (
        history.filter((F.col("asset_address") == asset_address) & F.col("action_type").isin(*DEPOSIT_ACTIONS))
        .groupBy("user_address")
        .agg(tokens_of(F.sum("amount_underlying")).alias("total_deposited"), F.count("*").alias("deposit_count"),
             iso_z(F.max("ledger_closed_at")).alias("last_deposit_date"))
        .filter(F.col("total_deposited") >= threshold)
        .withColumn("total_deposited_usd", F.col("total_deposited") * F.lit(float(price)))
    )
    return page_with_total(accounts, ordering(order_by, order_dir, ["user_address"]), limit, offset)


def accounts_by_event_count(history: DataFrame, event_types: Sequence[str], min_count: int,
                            asset_address: str | None = None, limit: int | None = 100, offset: int = 0,
                            order_dir: str = "desc", order_by: str = "event_count") -> DataFrame:
    """Accounts with at least ``min_count`` events, and their counts per event type.

    Counted per (user, type) first: the second level sees one row per type.  No
    event type at all selects nothing.
    """
    rows = history.filter(F.col("action_type").isin(list(event_types)))
    if asset_address:
        rows = rows.filter(F.col("asset_address") == asset_address)
    per_type = rows.groupBy("user_address", "action_type").agg(
        F.count("*").alias("n"), F.min("ledger_closed_at").alias("first"), F.max("ledger_closed_at").alias("last"))
    accounts = per_type.groupBy("user_address").agg(
        F.sum("n").alias("event_count"),
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("action_type", "n")))).alias("events_by_type"),
        iso_z(F.min("first")).alias("first_event_date"), iso_z(F.max("last")).alias("last_event_date"),
    ).filter(F.col("event_count") >= min_count)
    return page_with_total(accounts, ordering(order_by, order_dir, ["user_address"]), limit, offset)


def net(add: Sequence[str], remove: Sequence[str], amount: str = "amount_tokens") -> Column:
    """Sum of an amount over the adding actions less that over the removing ones."""
    a, zero = F.col(amount), F.lit(0).cast("decimal(38,0)")
    return F.sum(
        F.when(F.col("action_type").isin(*add), F.coalesce(a, zero))
        .when(F.col("action_type").isin(*remove), -F.coalesce(a, zero)).otherwise(zero))


def net_positions(history: DataFrame, keys: Sequence[str] = ("user_address", "pool_id"), *more: Column) -> DataFrame:
    """Net token positions per key from the action history (and ``more`` aggregates)."""
    return history.groupBy(*keys).agg(
        net(["supply"], ["withdraw"]).alias("supply_btokens"),
        net(["supply_collateral"], ["withdraw_collateral"]).alias("collateral_btokens"),
        net(["borrow"], ["repay"]).alias("debt_dtokens"), *more,
    )


def rated_balances(history: DataFrame, daily_rates: DataFrame, keys: Sequence[str] = ("user_address",)) -> DataFrame:
    """Balances per key at each pool's latest rates (a pool without rates counts at 1).

    ``keys`` may include ``asset_address``; rates are looked up per pool and asset
    when the positions still carry the asset.
    """
    at = ["pool_id", "asset_address"]
    position_keys = list(dict.fromkeys([*keys, "user_address", *at]))
    rates = latest_per(daily_rates, at, ["rate_date", "b_rate", "d_rate"], ["b_rate", "d_rate"])
    rated = net_positions(history, position_keys).join(rates, at, "left")
    b = F.coalesce(F.col("b_rate").cast("double"), F.lit(1.0))
    d = F.coalesce(F.col("d_rate").cast("double"), F.lit(1.0))
    return rated.groupBy(*keys).agg(
        F.sum(tokens_of(F.col("supply_btokens")) * b).alias("supply_balance"),
        F.sum(tokens_of(F.col("collateral_btokens")) * b).alias("collateral_balance"),
        F.sum(tokens_of(F.col("debt_dtokens")) * d).alias("debt_balance"),
    ).withColumn("net_balance", F.col("supply_balance") + F.col("collateral_balance") - F.col("debt_balance"))


@dataclass(frozen=True)
class TokenFilter:
    asset_address: str
    symbol: str = ""
    min_amount: float = 0.0


def _sign_filters(has_borrows: bool | None, has_deposits: bool | None) -> list[Column]:
    out = []
    deposits = F.col("supply_balance") + F.col("collateral_balance")
    if has_borrows is not None:
        out.append(F.col("debt_balance") > 0 if has_borrows else F.col("debt_balance") <= 0)
    if has_deposits is not None:
        out.append(deposits > 0 if has_deposits else deposits <= 0)
    return out


def accounts_by_balance(
    history: DataFrame, daily_rates: DataFrame, filters: Sequence[TokenFilter], prices: Mapping[str, float] = {},
    backstop_events: DataFrame | None = None, in_usd: bool = False, limit: int | None = 100, offset: int = 0,
    order_dir: str = "desc", has_borrows: bool | None = None, has_deposits: bool | None = None,
    has_backstop: bool | None = None, order_by: str = "net_balance",
) -> DataFrame:
    """Accounts that meet every token filter; shown are the balances of the first token.

    All tokens are aggregated in one pass over the history: a user qualifies when
    as many tokens meet their threshold as there are filters, which equals the
    intersection of the per-token user sets.
    """
    if not filters:
        return rated_balances(history, daily_rates).limit(0)
    wanted: dict[str, float] = {}
    for f in filters:
        price = float(prices.get(f.symbol.upper(), 0.0))
        threshold = native_threshold(f.min_amount, price, in_usd)
        wanted[f.asset_address] = max(threshold, wanted.get(f.asset_address, threshold))
    assets = list(wanted)
    balances = rated_balances(
        history.filter(F.col("asset_address").isin(assets)), daily_rates.filter(F.col("asset_address").isin(assets)),
        ["user_address", "asset_address"])
    reaches = reduce(lambda acc, a: acc.when(F.col("asset_address") == a, F.col("net_balance") >= wanted[a]),
                     assets, F)
    for condition in _sign_filters(has_borrows, has_deposits):
        reaches = reaches & condition if isinstance(reaches, Column) else condition
    primary = filters[0]
    shown = [F.max(F.when(F.col("asset_address") == primary.asset_address, F.col(c))).alias(c)
             for c in ("supply_balance", "collateral_balance", "debt_balance", "net_balance")]
    accounts = (
        balances.withColumn("_meets", reaches).groupBy("user_address")
        .agg(F.count_if("_meets").alias("_met"), *shown)
        .filter((F.col("_met") == len(assets)) & F.col("user_address").isNotNull()).drop("_met")
    )
    if has_backstop is not None:
        members = backstop_events.filter(F.col("user_address").isNotNull()).select("user_address")
        accounts = accounts.join(members, "user_address", "left_semi" if has_backstop else "left_anti")
    price = float(prices.get(primary.symbol.upper(), 0.0))
    accounts = accounts.withColumn("balance_usd", F.col("net_balance") * F.lit(price))
    return page_with_total(accounts, ordering(order_by, order_dir, ["user_address"]), limit, offset)


def matching_users(per_token: Sequence[DataFrame]) -> DataFrame:
    """Intersection of user sets given one by one (the general form of the AND filter)."""
    return reduce(DataFrame.intersect, per_token)


def top_depositors(events: DataFrame, pools: DataFrame, tokens: DataFrame, pool_id: str, limit: int,
                   asset_address: str | None = None, prices: DataFrame | None = None) -> DataFrame:
    """Largest depositors of a pool per token symbol, with their rank."""
    rows = events.filter((F.col("pool_id") == pool_id) & F.col("action_type").isin(*DEPOSIT_ACTIONS))
    if asset_address:
        rows = rows.filter(F.col("asset_address") == asset_address)
    per_asset = rows.groupBy("user_address", "pool_id", "asset_address").agg(F.sum("amount_underlying").alias("raw"))
    totals = with_symbol(per_asset, tokens).groupBy("user_address", "pool_id", "asset_symbol").agg(
        tokens_of(F.sum("raw")).alias("total_deposited"))
    ranked = top_k_ranked(totals, limit, ordering("total_deposited", "desc", ["user_address", "asset_symbol"]))
    named = ranked.join(pools.select("pool_id", F.col("name").alias("pool_name")), "pool_id", "left")
    named = named.withColumn("pool_name", F.coalesce("pool_name", F.lit("Unknown Pool")))
    return _usd(named, prices, {"total_deposited_usd": "total_deposited"})


def _usd(df: DataFrame, prices: DataFrame | None, values: Mapping[str, str]) -> DataFrame:
    if prices is None:
        return df
    priced = with_price(df, prices)
    return priced.withColumns({out: F.col(c) * F.col("price") for out, c in values.items()}).drop("price")


def _raw_flow(kind: Sequence[str]) -> Column:
    zero = F.lit(0).cast("decimal(38,0)")
    return F.coalesce(F.sum(F.when(F.col("action_type").isin(*kind), F.col("amount_underlying")).otherwise(zero)), zero)


def _flows(kind: Sequence[str]) -> Column:
    return tokens_of(_raw_flow(kind))


def _selected(history: DataFrame, start_date, end_date, pool_id=None, asset_address=None) -> DataFrame:
    rows = optional_window(history, "ledger_closed_at", start_date, end_date)
    if pool_id:
        rows = rows.filter(F.col("pool_id") == pool_id)
    if asset_address:
        rows = rows.filter(F.col("asset_address") == asset_address)
    return rows


def aggregate_metrics(events: DataFrame, tokens: DataFrame, prices: DataFrame, start_date=None, end_date=None,
                      pool_id: str | None = None, asset_address: str | None = None) -> DataFrame:
    """One row of flow totals; active accounts are counted over all symbols at once.

    Events are netted per (asset, account), which the exact count of accounts
    needs; names and prices are joined to one row per asset.
    """
    per_account = _selected(events, start_date, end_date, pool_id, asset_address).groupBy(
        "asset_address", "user_address").agg(
            _raw_flow(DEPOSIT_ACTIONS).alias("deposits"), _raw_flow(WITHDRAW_ACTIONS).alias("withdrawals"),
            F.count("*").alias("events"))
    per_asset = per_account.groupBy("asset_address").agg(
        *[F.sum(c).alias(c) for c in ("deposits", "withdrawals", "events")])
    accounts = per_account.agg(F.count_distinct("user_address").alias("n")).scalar()
    zero = F.lit(0.0)

    def total(side: str) -> Column:
        return F.coalesce(tokens_of(F.sum(side)), zero)

    def usd(side: str) -> Column:
        return F.coalesce(F.sum(tokens_of(F.col(side)) * F.col("price")), zero)

    folded = with_price(with_symbol(per_asset, tokens), prices).agg(
        total("deposits").alias("total_deposits"), usd("deposits").alias("total_deposits_usd"),
        total("withdrawals").alias("total_withdrawals"), usd("withdrawals").alias("total_withdrawals_usd"),
        F.coalesce(F.sum("events"), F.lit(0)).alias("total_events"),
    ).withColumn("active_accounts", accounts)
    return folded.withColumns({
        "net_flow": F.col("total_deposits") - F.col("total_withdrawals"),
        "net_flow_usd": F.col("total_deposits_usd") - F.col("total_withdrawals_usd"),
    })


def volume_by_token(events: DataFrame, tokens: DataFrame, limit: int, prices: DataFrame | None = None,
                    start_date=None, end_date=None) -> DataFrame:
    """Deposit, withdrawal and net volume per token, largest deposits first."""
    volumes = _selected(events, start_date, end_date).groupBy("asset_address").agg(
        _flows(DEPOSIT_ACTIONS).alias("deposit_volume"), _flows(WITHDRAW_ACTIONS).alias("withdraw_volume"),
    ).withColumn("net_volume", F.col("deposit_volume") - F.col("withdraw_volume"))
    top = with_symbol(page(volumes, ordering("deposit_volume", "desc", ["asset_address"]), limit), tokens)
    return _usd(top, prices, {
        "deposit_volume_usd": "deposit_volume", "withdraw_volume_usd": "withdraw_volume",
        "net_volume_usd": "net_volume"}).orderBy(*ordering("deposit_volume", "desc", ["asset_address"]))


def pool_statistics(pools: DataFrame, history: DataFrame, limit: int | None = 100, offset: int = 0,
                    order_dir: str = "desc", order_by: str = "event_count") -> DataFrame:
    """Event statistics of the active pools, pools without events included."""
    stats = history.groupBy("pool_id").agg(
        F.count("*").alias("event_count"), F.sort_array(F.collect_set("action_type")).alias("unique_event_types"),
        iso_z(F.min("ledger_closed_at")).alias("first_event_date"),
        iso_z(F.max("ledger_closed_at")).alias("last_event_date"))
    active = pools.filter(F.col("is_active")).select(
        "pool_id", F.col("name").alias("pool_name"), F.col("short_name").alias("pool_short_name"))
    joined = active.join(stats, "pool_id", "left").withColumns({
        "event_count": F.coalesce("event_count", F.lit(0)),
        "unique_event_types": F.coalesce("unique_event_types", F.array().cast("array<string>")),
    }).withColumn("unique_event_type_count", F.size("unique_event_types").cast("long"))
    return page_with_total(joined, ordering(order_by, order_dir, ["pool_id"]), limit, offset)


def pool_list(pools: DataFrame) -> DataFrame:
    return pools.filter(F.col("is_active")).select(
        "pool_id", "name", "short_name", "description", "icon_url", "website_url", "is_active",
        F.col("version")).orderBy("name")


def token_list(tokens: DataFrame) -> DataFrame:
    return tokens.select("asset_address", "symbol", "name", F.col("decimals").cast("int").alias("decimals"),
                         "icon_url", "coingecko_id", "is_native").orderBy("symbol")
