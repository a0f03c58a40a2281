"""Decoding of contract events and contract-state entries into typed rows.

Batch backfills and the streams use the same functions.  Each JSON text is parsed
once, into a struct that names only the paths some rule needs; the rules are then
plain field accesses inside generated code.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..constants import (
    ALL_RECORD_DATA, AUCTION_ACTIONS, BACKSTOP_ACTIONS, LENDING_ACTIONS, POOL_BALANCE, POSITIONS,
    RESERVE_CONFIG, RESERVE_DATA, TOTAL_SHARES,
)
from ..functions.identity import content_id
from ..functions.jsonvalues import find_by_key, i128_text, json_scalar, keys_of, scalar_text, with_integers
from ..functions.numbers import scaled_amount, scaled_rate

# Columns whose texts make up the identity of an event, in this order.
ACTION_IDENTITY = (
    "transaction_hash", "pool_id", "action_type", "asset_address", "user_address", "amount_underlying",
    "amount_tokens", "auction_type", "filler_address", "liquidation_percent", "bid_asset", "bid_amount",
    "lot_asset", "lot_amount",
)
BACKSTOP_IDENTITY = (
    "transaction_hash", "action_type", "pool_address", "user_address", "lp_tokens", "shares", "q4w_exp",
    "emissions_amount", "emissions_shares",
)

_TOPICS = "array<struct<symbol:string,address:string,u32:string>>"
_ASSET_MAP = "array<struct<key:struct<address:string>,val:struct<i128:string>>>"
_DATA = (
    "struct<i128:string,vec:array<struct<i128:string,address:string,u32:string,u64:string,"
    f"map:array<struct<val:struct<map:{_ASSET_MAP}>>>>>>"
)
ACTION_SYMBOL_PATH = "$[0].symbol"


def action_of(topics: Column) -> Column:
    """First topic symbol.  Always compared with known names, so a nested value
    (whose text starts with a brace) needs no guard of its own."""
    return F.get_json_object(topics, ACTION_SYMBOL_PATH)


def _parsed(df: DataFrame, topics: str, data: str) -> DataFrame:
    # Some auction payloads are a bare array; of those only the head is read.
    bare = F.ltrim(F.col(data)).startswith("[")
    return df.withColumns({
        "_t": F.from_json(F.col(topics), _TOPICS),
        "_d": F.from_json(F.when(~bare, F.col(data)), _DATA),
        "_bare": F.when(bare, F.col(data)),
    })


def _fields(df: DataFrame, topics: str, data: str, low_word_only: bool) -> DataFrame:
    """Every part of an event that some rule reads, each extracted once.

    A layer of its own: the rules read the parts several times, and an integer
    that may be nested costs too much to be repeated in each of them.
    """
    parsed = _parsed(df, topics, data)
    payload = F.col("_d")

    def topic(i: int, field: str) -> Column:
        return scalar_text(F.get(F.col("_t"), i)[field])

    def integer(text: Column) -> Column:
        return i128_text(text, low_word_only)

    def element(i: int) -> Column:
        return F.get(payload["vec"], i)

    def head(field: str) -> Column:
        # First element of the payload, whether wrapped in `vec` or bare.
        return F.coalesce(scalar_text(element(0)[field]), json_scalar(F.col("_bare"), f"$[0].{field}"))

    def side(slot: int, n: int) -> Column:
        return F.get(element(slot)["map"], n)["val"]["map"]

    def holdings(n: int) -> Column:
        return F.transform(F.coalesce(side(1, n), side(2, n)), lambda e: F.struct(
            scalar_text(e["key"]["address"]).alias("asset"), integer(e["val"]["i128"]).alias("amount")))

    parts = with_integers(
        parsed, {"vec0": element(0)["i128"], "vec1": element(1)["i128"], "whole": payload["i128"]}, low_word_only)
    return parts.withColumns({
        "topic1_address": topic(1, "address"), "topic2_address": topic(2, "address"), "topic1_u32": topic(1, "u32"),
        "vec1_u64": scalar_text(element(1)["u64"]), "head_address": head("address"), "head_u32": head("u32"),
        "bids": holdings(BID), "lots": holdings(LOT),
    })


BID, LOT = 0, 2


def _by_action(action: Column, cases: Sequence[tuple[Sequence[str], Column]], default: Column | None = None) -> Column:
    branches = F
    for actions, value in cases:
        branches = branches.when(action.isin(*actions), value)
    return branches.otherwise(default) if default is not None else branches


def _long_division(u: Column, t: Column) -> Column:
    big = "decimal(38,0)"
    wide = t >= F.lit("1" + "0" * 35).cast(big)

    def fitted(c: Column) -> Column:
        return F.when(wide, (c - c % 1000).cast(big) * F.lit("0.001").cast("decimal(4,3)")).otherwise(c).cast(big)

    def three_decimals(by: Column):
        def step(done: Column, _: Column) -> Column:
            scaled = (done["rest"] * F.lit(1000).cast("decimal(4,0)")).cast(big)
            rest = (scaled % by).cast(big)
            return F.struct(rest.alias("rest"), (done["decimals"] * 1000 + F.try_divide(scaled - rest, by).cast("bigint")).alias("decimals"))
        return step

    def divided(p: Column) -> Column:
        rest = (p["size"] % p["by"]).cast(big)
        whole = F.try_divide(p["size"] - rest, p["by"]).cast(big)
        start = F.struct(rest.alias("rest"), F.lit(0).cast("bigint").alias("decimals"))

        def text(done: Column) -> Column:
            decimals = done["decimals"] + F.when(done["rest"] * 2 >= p["by"], 1).otherwise(0)
            full = decimals >= 10**18
            return F.concat((whole + F.when(full, 1).otherwise(0)).cast(big).cast("string"), F.lit("."),
                            F.lpad(F.when(full, 0).otherwise(decimals).cast("string"), 18, "0"))

        return F.aggregate(F.sequence(F.lit(1), F.lit(6)), start, three_decimals(p["by"]), text)

    # The lambdas bind each value once; spelled out, the steps would not fit a compiled method.
    bound = F.array(F.struct(fitted(F.abs(u)).alias("size"), fitted(t).alias("by")))
    return F.concat(F.when(u < 0, "-").otherwise(""), F.get(F.transform(bound, divided), 0)).try_cast("decimal(38,18)")


def implied_rate(underlying: Column, tokens: Column) -> Column:
    """underlying / tokens with 18 decimals, rounded half up; NULL for no tokens, or a rate of more than 20 digits.

    Operands of up to 20 digits divide as decimals. A division of wider ones goes by
    steps, to the same 18 decimals: the whole quotient, then six times three
    decimals of what remains, each step within 38 digits because a remainder is
    less than the divisor. Of a divisor of more than 35 digits both operands lose their last
    three, which moves the rate by less than one part in ten to the 31st.
    """
    u, t = underlying.try_cast("decimal(38,0)"), tokens.try_cast("decimal(38,0)")
    narrow = F.try_divide(u.try_cast("decimal(20,0)"), t.try_cast("decimal(20,0)")).cast("decimal(38,18)")
    return F.when(t > 0, F.coalesce(narrow, _long_division(u, t)))


def decode_actions(
    df: DataFrame, topics: str = "topics_decoded", data: str = "data_decoded", closed_at: str = "closed_at",
    low_word_only: bool = False,
) -> DataFrame:
    """Lending events → one typed row each, with content identity.

    Amounts stay digit texts here: the identity is over texts, and a value beyond
    38 digits must not vanish before it can be reported (``typed_actions``).
    """
    a, nothing = F.col("action_type"), F.lit(None).cast("string")
    plain_actions = (*AUCTION_ACTIONS, "claim")
    first_bid, first_lot = F.get("bids", 0), F.get("lots", 0)
    parts = _fields(with_action(df, topics), topics, data, low_word_only)
    rows = parts.select(
        F.col("contract_id").alias("pool_id"), "transaction_hash", "ledger_sequence",
        F.col(closed_at).alias("ledger_closed_at"), "action_type",
        _by_action(a, [(["claim"], F.col("topic2_address")), (AUCTION_ACTIONS, nothing)], F.col("topic1_address"))
        .alias("asset_address"),
        _by_action(a, [
            (["claim"], F.col("topic1_address")),
            (AUCTION_ACTIONS, F.coalesce("topic2_address", "topic1_address")),
        ], F.col("topic2_address")).alias("user_address"),
        _by_action(a, [(AUCTION_ACTIONS, nothing), (["claim"], F.col("vec1"))], F.coalesce("vec0", "whole"))
        .alias("amount_underlying"),
        _by_action(a, [(plain_actions, nothing)], F.col("vec1")).alias("amount_tokens"),
        _by_action(a, [(plain_actions, F.lit(None).cast("decimal(38,18)"))],
                   implied_rate(F.col("vec0"), F.col("vec1"))).alias("implied_rate"),
        _by_action(a, [(AUCTION_ACTIONS, F.col("topic1_u32"))]).alias("auction_type"),
        _by_action(a, [(["fill_auction"], F.col("head_address"))]).alias("filler_address"),
        _by_action(a, [(["new_auction"], F.col("head_u32")), (["fill_auction"], F.col("vec1"))])
        .alias("liquidation_percent"),
        _by_action(a, [(AUCTION_ACTIONS, first_bid["asset"])]).alias("bid_asset"),
        _by_action(a, [(AUCTION_ACTIONS, first_bid["amount"])]).alias("bid_amount"),
        _by_action(a, [(AUCTION_ACTIONS, first_lot["asset"])]).alias("lot_asset"),
        _by_action(a, [(AUCTION_ACTIONS, first_lot["amount"])]).alias("lot_amount"),
        _by_action(a, [(AUCTION_ACTIONS, F.col("bids"))]).alias("bid_assets"),
        _by_action(a, [(AUCTION_ACTIONS, F.col("lots"))]).alias("lot_assets"),
    )
    return rows.select(content_id("ledger_sequence", ACTION_IDENTITY).alias("id"), "*")


def decode_backstop(
    df: DataFrame, topics: str = "topics_decoded", data: str = "data_decoded", closed_at: str = "closed_at",
    low_word_only: bool = False,
) -> DataFrame:
    """Backstop events → one typed row each, with content identity.

    ``draw`` and ``gulp_emissions`` carry no LP-token amount, so they do not move
    running totals of it.
    """
    a, nothing = F.col("action_type"), F.lit(None).cast("string")
    parts = _fields(with_action(df, topics), topics, data, low_word_only)
    rows = parts.select(
        "transaction_hash", "ledger_sequence", F.col(closed_at).alias("ledger_closed_at"), "action_type",
        _by_action(a, [(["claim"], nothing)], F.col("topic1_address")).alias("pool_address"),
        _by_action(a, [(["claim"], F.col("topic1_address")), (["gulp_emissions", "draw"], nothing)],
                   F.col("topic2_address")).alias("user_address"),
        _by_action(a, [(["deposit"], F.col("vec0")), (["withdraw"], F.col("vec1")),
                       (["claim", "donate"], F.col("whole"))]).alias("lp_tokens"),
        _by_action(a, [(["deposit"], F.col("vec1")), (["withdraw", "queue_withdrawal"], F.col("vec0")),
                       (["dequeue_withdrawal"], F.col("whole"))]).alias("shares"),
        _by_action(a, [(["queue_withdrawal"], F.col("vec1_u64"))]).alias("q4w_exp"),
        _by_action(a, [(["gulp_emissions"], F.col("vec0"))]).alias("emissions_amount"),
        _by_action(a, [(["gulp_emissions"], F.col("vec1"))]).alias("emissions_shares"),
    )
    return rows.select(content_id("ledger_sequence", BACKSTOP_IDENTITY).alias("id"), "*")


def lending_events(df: DataFrame, pools: Sequence[str] | None, topics: str = "topics_decoded") -> DataFrame:
    """Successful, well-formed events of the tracked pools with a known action."""
    return _relevant(df, pools, LENDING_ACTIONS, topics)


def backstop_events(df: DataFrame, contract: str | None, topics: str = "topics_decoded") -> DataFrame:
    return _relevant(df, [contract] if contract else None, BACKSTOP_ACTIONS, topics)


def _relevant(df: DataFrame, contracts, actions, topics: str) -> DataFrame:
    df = df.filter(F.col("in_successful_contract_call"))
    if "type" in df.columns:
        df = df.filter(F.coalesce(F.col("type"), F.lit("contract")) == "contract")
    if "operation_id" in df.columns:
        df = df.filter(F.col("operation_id").isNotNull())
    if contracts is not None:
        df = df.filter(F.col("contract_id").isin(list(contracts)))
    return with_action(df, topics).filter(F.col("action_type").isin(*actions))


def with_action(df: DataFrame, topics: str = "topics_decoded") -> DataFrame:
    """``action_type`` from the topics, unless the log stores it (then the scan can filter by it)."""
    return df if "action_type" in df.columns else df.withColumn("action_type", action_of(F.col(topics)))


# --- contract-state entries ---------------------------------------------------

_KEY = "struct<vec:array<struct<symbol:string,address:string>>>"
_RESERVE_MAP = "array<struct<key:struct<u32:string>,val:struct<i128:string>>>"
_POSITION_VAL = f"struct<map:array<struct<key:struct<u32:string>,val:struct<map:{_RESERVE_MAP}>>>>"
_NUMBER_VAL = "struct<map:array<struct<key:struct<u32:string>,val:struct<i128:string,u64:string,u32:string>>>>"
COLLATERAL, LIABILITIES, SUPPLY = 0, 1, 2
STATE_KINDS = (POSITIONS, RESERVE_DATA, RESERVE_CONFIG)


def entry_type(key_decoded: Column) -> Column:
    """Kind of a state entry: Positions, ResData, ResConfig or Unknown."""
    symbol = F.get_json_object(key_decoded, "$.vec[0].symbol")
    return F.when(symbol.isin(*STATE_KINDS), symbol).otherwise("Unknown")


def entries_of(df: DataFrame, kind: str, include_deleted: bool = False) -> DataFrame:
    """Entries of one kind, with the address from their key as ``key_address`` (a column of stored logs)."""
    stored = "entry_type" in df.columns
    df = df.filter((F.col("entry_type") if stored else F.get_json_object("key_decoded", "$.vec[0].symbol")) == kind)
    if not include_deleted:
        df = df.filter(~F.col("deleted"))
    if "key_address" in df.columns:
        return df
    return df.withColumn("key_address", json_scalar(F.col("key_decoded"), "$.vec[1].address"))


def _slot(entries: Column, number: int, mode: str) -> Column:
    """Entry ``number`` of a map: by its own key, or by position in the list.

    Maps whose entries are named by symbols come sorted by name, so there the
    position is the number in either mode.
    """
    by_place = F.get(entries, number)
    if mode == "position":
        return by_place
    named = F.get(entries, 0)["key"]["u32"].isNull()
    return F.when(named, by_place).otherwise(find_by_key(entries, number))


def _check_mode(mode: str) -> None:
    if mode not in ("key", "position"):
        raise ValueError(f"mode must be 'key' or 'position', not {mode!r}")


def _numbers(df: DataFrame, mode: str, **slots: tuple[int, str]) -> DataFrame:
    """Numbers of a value map as digit texts: ``name=(slot, field)``."""
    _check_mode(mode)
    parsed = df.withColumn("_m", F.from_json("val_decoded", _NUMBER_VAL)["map"])
    return with_integers(parsed, {
        name: _slot(F.col("_m"), n, mode)["val"][field] for name, (n, field) in slots.items()})


def decode_positions(df: DataFrame, mode: str = "key") -> DataFrame:
    """Position entries → one row per reserve index held.

    ``mode="key"`` reads the indices stored in the maps and emits every one of
    them; ``mode="position"`` takes the place in the list as the index, as older
    backfills did (rows where any of the three slots exists).
    """
    _check_mode(mode)
    p = F.col("_p")
    sides = entries_of(df, POSITIONS).withColumn("_p", F.from_json("val_decoded", _POSITION_VAL)["map"]).select(
        F.col("contract_id").alias("pool_id"), F.col("key_address").alias("user_address"),
        F.col("closed_at").alias("snapshot_timestamp"), "ledger_sequence",
        F.col("ledger_key_hash_base_64").alias("entry_hash"), "ledger_entry_change",
        *[_slot(p, n, mode)["val"]["map"].alias(name)
          for name, n in (("supply", SUPPLY), ("collateral", COLLATERAL), ("liabilities", LIABILITIES))])
    names = ("supply", "collateral", "liabilities")
    if mode == "key":
        none = F.array().cast("array<bigint>")
        held = [F.coalesce(keys_of(F.col(c)), none) for c in ("collateral", "liabilities", "supply")]
        indices = F.array_union(F.array_union(held[0], held[1]), held[2])
        entry = lambda c: find_by_key(F.col(c), F.col("reserve_index"))
    else:
        longest = F.greatest(*[F.coalesce(F.size(c), F.lit(0)) for c in names])
        indices = F.when(longest > 0, F.sequence(F.lit(0), longest - 1))
        entry = lambda c: F.get(F.col(c), F.col("reserve_index"))
    rows = sides.withColumn("reserve_index", F.explode(indices))
    if mode == "position":
        rows = rows.filter(entry("supply").isNotNull() | entry("collateral").isNotNull() | entry("liabilities").isNotNull())
    return with_integers(rows, {f"{c}_raw": entry(c)["val"]["i128"] for c in names}).drop(*names)


def with_position_amounts(df: DataFrame) -> DataFrame:
    """Raw position texts → scaled amounts, missing ones as 0."""
    return df.select(
        *[c for c in df.columns if c not in ("supply_raw", "collateral_raw", "liabilities_raw")],
        scaled_amount(F.col("supply_raw")).alias("supply_btokens"),
        scaled_amount(F.col("collateral_raw")).alias("collateral_btokens"),
        scaled_amount(F.col("liabilities_raw")).alias("liabilities_dtokens"),
    )


def has_amount(df: DataFrame) -> DataFrame:
    """Rows in which any of the three amounts is present and not zero."""
    nonzero = [
        F.coalesce(F.col(c).try_cast("decimal(38,0)"), F.lit(0)) != 0
        for c in ("supply_raw", "collateral_raw", "liabilities_raw")
    ]
    return df.filter(nonzero[0] | nonzero[1] | nonzero[2])


def decode_reserve_state(df: DataFrame, mode: str = "key", null_rate_as_zero: bool = False,
                         include_deleted: bool = False) -> DataFrame:
    """Reserve data entries → rates and supplies."""
    rows = _numbers(
        entries_of(df, RESERVE_DATA, include_deleted), mode, _b=(0, "i128"), _bs=(1, "i128"), _d=(3, "i128"),
        _ds=(4, "i128"), _t=(6, "u64"))
    return rows.select(
        F.col("contract_id").alias("pool_id"), F.col("key_address").alias("asset_address"),
        F.to_date("closed_at").alias("snapshot_date"), F.col("closed_at").alias("snapshot_timestamp"),
        "ledger_sequence",
        scaled_rate(F.col("_b"), null_rate_as_zero).alias("b_rate"),
        scaled_rate(F.col("_d"), null_rate_as_zero).alias("d_rate"),
        scaled_amount(F.col("_bs")).alias("b_supply"), scaled_amount(F.col("_ds")).alias("d_supply"),
        F.col("_t").try_cast("long").alias("last_time"), "deleted",
    )


def decode_reserve_config(df: DataFrame, mode: str = "key", include_deleted: bool = True) -> DataFrame:
    """Reserve configuration entries → (pool, reserve index, asset).

    A deleted entry has no value; it comes out with index -1 and ``deleted``.
    """
    rows = _numbers(entries_of(df, RESERVE_CONFIG, include_deleted), mode, _i=(3, "u32"))
    index = F.col("_i").try_cast("long")
    return rows.select(
        F.col("contract_id").alias("pool_id"), F.col("key_address").alias("asset_address"),
        F.when(F.col("deleted"), F.lit(-1)).otherwise(index).alias("reserve_index"),
        "ledger_sequence", "deleted",
    )


def reserve_mapping(df: DataFrame, mode: str = "key", latest_only: bool = False) -> DataFrame:
    """Pool, reserve index → asset, from the configuration entries.

    By default every asset an index ever stood for, as a backfill joins it;
    ``latest_only`` keeps the assignment valid now.
    """
    from ..operators.dedup import latest_per

    config = decode_reserve_config(df, mode, include_deleted=False).filter(F.col("reserve_index").isNotNull())
    if latest_only:
        return latest_per(config, ["pool_id", "reserve_index"], ["ledger_sequence", "asset_address"],
                          ["asset_address"])
    return config.select("pool_id", "reserve_index", "asset_address").distinct()


def reserve_validity(df: DataFrame, mode: str = "key") -> DataFrame:
    """Pool, reserve index → asset, with the ledgers in which it holds it: ``from_ledger`` up to before ``until_ledger``.

    An asset holds the index of its configuration entry until it is deleted or
    configured with another one (a deletion comes last in its ledger). An index
    that another asset takes ends there for the one before; of several assets
    in one ledger the greatest counts. Spans of an index never overlap; the one
    that lasts has a NULL end. Configuration entries are few: some per reserve.
    """
    from ..operators.dedup import latest_per

    config = decode_reserve_config(df, mode).filter(F.col("reserve_index").isNotNull())
    said = latest_per(config, ["pool_id", "asset_address", "ledger_sequence"], ["deleted", "reserve_index"],
                      ["deleted", "reserve_index"])
    own = Window.partitionBy("pool_id", "asset_address").orderBy("ledger_sequence")
    held = said.withColumn("_own_end", F.lead("ledger_sequence").over(own)).filter(~F.col("deleted"))
    in_index = Window.partitionBy("pool_id", "reserve_index").orderBy("ledger_sequence", "asset_address")
    spans = held.select(
        "pool_id", "reserve_index", "asset_address", F.col("ledger_sequence").alias("from_ledger"),
        F.least("_own_end", F.lead("ledger_sequence").over(in_index)).alias("until_ledger"),
    ).filter("until_ledger IS NULL OR until_ledger > from_ledger")
    # Statements that follow on one another without a gap are one span.
    by_start = Window.partitionBy("pool_id", "reserve_index").orderBy("from_ledger")
    goes_on = (F.lag("asset_address").over(by_start) == F.col("asset_address")) & (
        F.lag("until_ledger").over(by_start) == F.col("from_ledger"))
    numbered = spans.withColumn("_new", F.when(F.coalesce(goes_on, F.lit(False)), 0).otherwise(1)).withColumn(
        "_span", F.sum("_new").over(by_start))
    return numbered.groupBy("pool_id", "reserve_index", "_span").agg(
        F.first("asset_address").alias("asset_address"), F.min("from_ledger").alias("from_ledger"),
        F.max_by("until_ledger", "from_ledger").alias("until_ledger")).drop("_span")


def discovery_totals(mapping: DataFrame) -> DataFrame:
    """How many pools, pool-asset pairs and distinct assets the mapping holds."""
    return mapping.agg(
        F.count_distinct("pool_id").alias("total_pools"), F.count("*").alias("total_pairs"),
        F.count_distinct("asset_address").alias("unique_assets"))


def decode_pool_balance(df: DataFrame) -> DataFrame:
    """Backstop balance entries per pool (tombstones are not filtered here)."""
    rows = _numbers(entries_of(df, POOL_BALANCE, include_deleted=True), "position", _q=(0, "i128"), _s=(1, "i128"),
                    _t=(2, "i128"))
    return rows.select(
        F.col("key_address").alias("pool_address"), F.to_date("closed_at").alias("snapshot_date"),
        F.col("closed_at").alias("snapshot_timestamp"), "ledger_sequence",
        *[F.col(c).try_cast("decimal(38,0)").alias(name) for c, name in (("_s", "shares"), ("_t", "tokens"), ("_q", "q4w"))],
    )


def decode_total_shares(df: DataFrame) -> DataFrame:
    rows = with_integers(entries_of(df, TOTAL_SHARES, include_deleted=True),
                         {"_n": F.get_json_object("val_decoded", "$.i128")})
    return rows.select("ledger_sequence", F.to_date("closed_at").alias("price_date"),
                       F.col("_n").try_cast("decimal(38,0)").alias("total_shares"))


def decode_quote_balance(df: DataFrame) -> DataFrame:
    rows = with_integers(entries_of(df, ALL_RECORD_DATA, include_deleted=True),
                         {"_n": F.get_json_object("val_decoded", "$.map[0].val.map[0].val.i128")})
    return rows.select("ledger_sequence", F.col("_n").try_cast("decimal(38,0)").alias("quote_balance"))
