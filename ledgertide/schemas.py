"""Declared schemas: raw sources and curated tables (never inferred)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

_S, _L, _TS, _D, _B, _I = (
    T.StringType(), T.LongType(), T.TimestampType(), T.DateType(), T.BooleanType(), T.IntegerType(),
)
INT38 = T.DecimalType(38, 0)
AMOUNT = T.DecimalType(38, 7)
RATE = T.DecimalType(38, 12)
PCT = T.DecimalType(10, 4)


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


# --- raw sources -------------------------------------------------------------
CONTRACT_DATA = _struct(
    contract_id=_S, closed_at=_TS, ledger_sequence=_L, ledger_key_hash_base_64=_S,
    ledger_entry_change=_L, deleted=_B, key_decoded=_S, val_decoded=_S,
)
CONTRACT_EVENTS = _struct(
    id=_S, type=_S, transaction_hash=_S, ledger_sequence=_L, closed_at=_TS, contract_id=_S,
    in_successful_contract_call=_B, operation_id=_L, topics_decoded=_S, data_decoded=_S,
)
# As stored by sources.bronze: the filter columns beside the JSON, partitioned by day.
STORED_CONTRACT_DATA = T.StructType([
    *CONTRACT_DATA.fields, T.StructField("entry_type", _S), T.StructField("key_address", _S), T.StructField("date", _D)])
STORED_CONTRACT_EVENTS = T.StructType([
    *CONTRACT_EVENTS.fields, T.StructField("action_type", _S), T.StructField("date", _D)])
STREAM_EVENTS = _struct(
    id=_S, type=_S, transaction_hash=_S, ledger_sequence=_L, ledger_closed_at=_TS, contract_id=_S,
    in_successful_contract_call=_B, topics=_S, data=_S,
)
STATE_BATCH = _struct(
    events=T.ArrayType(_struct(
        ledger_sequence=_L, closed_at=_S, contract_id=_S, ledger_key_hash=_S,
        ledger_entry_change=_I, deleted=_B, key_decoded=_S, val_decoded=_S,
    )),
    timestamp=_S, network=_S,
)
PRICE_SERIES = _struct(prices=T.ArrayType(T.ArrayType(T.DoubleType())))
BOND_HISTORY = _struct(historyRange=T.ArrayType(
    _struct(date=_S, tokenPrice=_S, usdExchangeRate=_S, statusType=_S)))
EXCHANGE_RATES = _struct(rates=T.MapType(_S, _struct(value=T.DoubleType(), type=_S)))

# --- curated tables ----------------------------------------------------------
_ASSET_LIST = T.ArrayType(_struct(asset=_S, amount=_S))

PARSED_EVENTS = _struct(
    id=_S, pool_id=_S, transaction_hash=_S, ledger_sequence=_L, ledger_closed_at=_TS, action_type=_S,
    asset_address=_S, user_address=_S, amount_underlying=INT38, amount_tokens=INT38,
    implied_rate=T.DecimalType(20, 12), auction_type=_I, filler_address=_S, liquidation_percent=INT38,
    bid_asset=_S, bid_amount=INT38, lot_asset=_S, lot_amount=INT38,
    bid_assets=_ASSET_LIST, lot_assets=_ASSET_LIST, src=_S,
)
BACKSTOP_EVENTS = _struct(
    id=_S, transaction_hash=_S, ledger_sequence=_L, ledger_closed_at=_TS, action_type=_S, pool_address=_S,
    user_address=_S, lp_tokens=INT38, shares=INT38, q4w_exp=_L, emissions_amount=INT38,
    emissions_shares=INT38, src=_S,
)
POOL_SNAPSHOTS = _struct(
    pool_id=_S, asset_address=_S, snapshot_date=_D, snapshot_timestamp=_TS, ledger_sequence=_L,
    b_rate=RATE, d_rate=RATE, b_supply=AMOUNT, d_supply=AMOUNT, last_time=_L,
)
USER_POSITIONS = _struct(
    pool_id=_S, user_address=_S, asset_address=_S, snapshot_date=_D, snapshot_timestamp=_TS,
    ledger_sequence=_L, entry_hash=_S, ledger_entry_change=_L, supply_btokens=AMOUNT,
    collateral_btokens=AMOUNT, liabilities_dtokens=AMOUNT, b_rate=RATE, d_rate=RATE,
)
BACKSTOP_POOL_SNAPSHOTS = _struct(
    pool_address=_S, snapshot_date=_D, snapshot_timestamp=_TS, ledger_sequence=_L,
    shares=INT38, tokens=INT38, q4w=INT38, q4w_pct=PCT, src=_S,
)
DAILY_TOKEN_PRICES = _struct(token_address=_S, price_date=_D, usd_price=T.DoubleType(), source=_S)
DAILY_EMISSION_APY = _struct(
    rate_date=_D, apy_type=_S, pool_address=_S, asset_address=_S, eps=INT38, eps_decimals=_I,
    total_supply=T.DoubleType(), reward_price_usd=T.DoubleType(), asset_price_usd=T.DoubleType(),
    emissions_per_year_per_token=T.DoubleType(), emission_apy=T.DoubleType(), source=_S,
)
EMISSION_CONFIGS = _struct(
    config_type=_S, pool_address=_S, asset_address=_S, eps=INT38, eps_decimals=_I, expiration=_L,
)
POOLS = _struct(
    pool_id=_S, name=_S, short_name=_S, description=_S, icon_url=_S, website_url=_S, version=_S,
    is_active=_B, updated_at=_TS,
)
TOKENS = _struct(
    asset_address=_S, symbol=_S, name=_S, decimals=_I, icon_url=_S, coingecko_id=_S, pegged_currency=_S,
    is_native=_B, created_at=_TS, updated_at=_TS,
)
RESERVE_STATE = _struct(
    pool_id=_S, asset_id=_S, b_rate=INT38, d_rate=INT38, b_supply=INT38, d_supply=INT38,
    total_supply=INT38, total_liabilities=INT38, decimals=_I, supply_eps=INT38, borrow_eps=INT38,
    supply_expiration=_L, borrow_expiration=_L, oracle_price=T.DoubleType(), last_time=_L,
    ledger_sequence=_L,
)
BACKSTOP_STATE = _struct(
    pool_id=_S, shares=INT38, tokens=INT38, q4w=INT38, eps=INT38, eps_decimals=_I, expiration=_L,
    ledger_sequence=_L,
)

# Upsert keys of the curated tables and the date column each is partitioned by.
TABLE_KEYS = {
    "parsed_events": ["id"],
    "backstop_events": ["id"],
    "pool_snapshots": ["pool_id", "asset_address", "snapshot_date"],
    "user_positions": ["pool_id", "user_address", "asset_address", "ledger_sequence"],
    "backstop_pool_snapshots": ["pool_address", "snapshot_date"],
    "daily_token_prices": ["token_address", "price_date"],
    "daily_emission_apy": ["rate_date", "apy_type", "pool_address", "asset_address"],
    "emission_configs": ["config_type", "pool_address", "asset_address"],
    "pools": ["pool_id"],
    "tokens": ["asset_address"],
}
TABLE_PARTITIONS = {
    "parsed_events": "event_date",
    "backstop_events": "event_date",
    "pool_snapshots": "snapshot_date",
    "user_positions": "snapshot_date",
    "backstop_pool_snapshots": "snapshot_date",
    "daily_token_prices": "price_date",
    "daily_emission_apy": "rate_date",
    "pending_positions": "snapshot_date",
}


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project ``df`` onto ``schema``: cast what is there, NULL for the rest."""
    from pyspark.sql import functions as F

    have = set(df.columns)
    return df.select([
        (F.col(f.name).try_cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in schema.fields
    ])
