"""Decoding, snapshots, positions and balances."""

from pyspark.sql import functions as F

from ..functions import json_scalar
from ..functions.timewindow import iso_z
from ..plans import balances, decode, events, positions, snapshots, views
from .adapters import Tables
from .explore_queries import day, r6
from .registry import query
from .sqltables import with_tables

# --- event decoding -----------------------------------------------------------

_ID = "{ledger} || '-' || substr(sha256({parts}), 1, 16)"


def _hash(*parts: str) -> str:
    return _ID.format(ledger="event_id", parts=" || ".join(f"coalesce(CAST({p} AS VARCHAR), '')" for p in parts))


_LENDING_FIELDS = ("'T' || event_id", "pool_id", "a", "asset", "u_addr", "under", "toks", "auction_type", "filler",
                   "pct", "bid_asset", "bid_amount", "lot_asset", "lot_amount")
_LENDING = """act AS (
  SELECT *, CASE event_type WHEN 'signup' THEN CASE WHEN event_id % 2 = 0 THEN 'supply' ELSE 'supply_collateral' END
              WHEN 'click' THEN CASE WHEN event_id % 2 = 0 THEN 'withdraw' ELSE 'withdraw_collateral' END
              WHEN 'purchase' THEN 'borrow' WHEN 'view' THEN 'repay'
              ELSE CASE event_id % 3 WHEN 0 THEN 'claim' WHEN 1 THEN 'new_auction' ELSE 'fill_auction' END END AS a
  FROM ev WHERE event_id % 11 <> 0 AND event_id % 13 <> 0),
dec AS (
  SELECT *, a IN ('new_auction', 'fill_auction') AS auc, a = 'new_auction' AND event_id % 4 = 0 AS bare,
         a = 'repay' AND event_id % 7 = 0 AS flat FROM act),
lend AS (
  SELECT event_id, ts, pool_id, a, CASE WHEN NOT auc THEN asset_address END AS asset, user_address AS u_addr,
         CASE WHEN auc THEN NULL WHEN a = 'claim' THEN cents * 90000 + k ELSE cents * 100000 END AS under,
         CASE WHEN NOT auc AND a <> 'claim' AND NOT flat THEN cents * 90000 + k END AS toks,
         CASE WHEN auc THEN k % 3 END AS auction_type, CASE WHEN a = 'fill_auction' THEN 'F' || user_id END AS filler,
         CASE WHEN auc THEN k END AS pct, CASE WHEN auc AND NOT bare THEN asset_address END AS bid_asset,
         CASE WHEN auc AND NOT bare THEN cents * 100000 END AS bid_amount, CASE WHEN auc AND NOT bare THEN 'B' || k END AS lot_asset,
         CASE WHEN auc AND NOT bare THEN cents * 90000 + k END AS lot_amount FROM dec)"""


@query(with_tables(f"""
SELECT {_hash(*_LENDING_FIELDS)} AS id, pool_id, 'T' || event_id AS transaction_hash, event_id AS ledger_sequence,
       strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS ledger_closed_at, a AS action_type, asset AS asset_address,
       u_addr AS user_address, CAST(under AS VARCHAR) AS amount_underlying, CAST(toks AS VARCHAR) AS amount_tokens,
       CASE WHEN a <> 'claim' AND toks > 0 THEN round(under / CAST(toks AS DOUBLE), 9) END AS implied_rate,
       CAST(auction_type AS VARCHAR) AS auction_type, filler AS filler_address, CAST(pct AS VARCHAR) AS liquidation_percent,
       bid_asset, CAST(bid_amount AS VARCHAR) AS bid_amount, lot_asset, CAST(lot_amount AS VARCHAR) AS lot_amount
FROM lend""", "ev", more=_LENDING))
def lending_events_decode(t: Tables):
    raw = t.raw_lending()
    out = events.lending_table(raw.unionByName(raw), None)
    return out.drop("bid_assets", "lot_assets").withColumns({
        "ledger_closed_at": iso_z(F.col("ledger_closed_at")),
        "implied_rate": F.round(F.col("implied_rate").cast("double"), 9)})


@query(with_tables("""
SELECT event_id AS ledger_sequence, bid_asset || ':' || bid_amount AS bids, lot_asset || ':' || lot_amount AS lots
FROM lend WHERE a IN ('new_auction', 'fill_auction') AND bid_asset IS NOT NULL""", "ev", more=_LENDING))
def auction_asset_lists(t: Tables):
    rows = decode.decode_actions(decode.lending_events(t.raw_lending(), None)).filter(F.col("bid_asset").isNotNull())
    text = lambda c: F.array_join(F.transform(c, lambda e: F.concat_ws(":", e["asset"], e["amount"])), ",")
    return rows.select("ledger_sequence", text(F.col("bid_assets")).alias("bids"), text(F.col("lot_assets")).alias("lots"))


_BACKSTOP_FIELDS = ("'T' || event_id", "a", "pool", "u_addr", "lp", "shares", "exp", "em", "es")
_BACK = """act AS (
  SELECT *, CASE event_type WHEN 'signup' THEN 'deposit' WHEN 'click' THEN 'withdraw'
              WHEN 'purchase' THEN CASE WHEN event_id % 2 = 0 THEN 'queue_withdrawal' ELSE 'dequeue_withdrawal' END
              WHEN 'view' THEN CASE WHEN k % 2 = 0 THEN 'donate' ELSE 'draw' END
              ELSE CASE WHEN k % 2 = 0 THEN 'claim' ELSE 'gulp_emissions' END END AS a
  FROM ev WHERE event_id % 11 <> 0 AND event_id % 13 <> 0),
back AS (
  SELECT event_id, ts, a, CASE WHEN a <> 'claim' THEN pool_id END AS pool,
         CASE WHEN a NOT IN ('gulp_emissions', 'draw') THEN user_address END AS u_addr,
         CASE WHEN a IN ('deposit', 'withdraw', 'claim', 'donate') THEN cents * 100000 END AS lp,
         CASE WHEN a IN ('deposit', 'withdraw', 'queue_withdrawal', 'dequeue_withdrawal') THEN cents * 90000 + k END AS shares,
         CASE WHEN a = 'queue_withdrawal' THEN event_id + 1700000000 END AS exp,
         CASE WHEN a = 'gulp_emissions' THEN cents * 100000 END AS em,
         CASE WHEN a = 'gulp_emissions' THEN cents * 90000 + k END AS es FROM act)"""


@query(with_tables(f"""
SELECT {_hash(*_BACKSTOP_FIELDS)} AS id, event_id AS ledger_sequence, a AS action_type, pool AS pool_address,
       u_addr AS user_address, CAST(lp AS VARCHAR) AS lp_tokens, CAST(shares AS VARCHAR) AS shares,
       CAST(exp AS VARCHAR) AS q4w_exp, CAST(em AS VARCHAR) AS emissions_amount, CAST(es AS VARCHAR) AS emissions_shares
FROM back""", "ev", more=_BACK))
def backstop_events_decode(t: Tables):
    raw = t.raw_backstop()
    out = events.backstop_table(raw.unionByName(raw), "BACKSTOP")
    return out.drop("transaction_hash", "ledger_closed_at")


@query(with_tables("""
SELECT 'T' || event_id AS transaction_hash, a AS action_type, event_id AS ledger_sequence FROM lend
WHERE NOT (event_type_gs)""".replace("(event_type_gs)", "(event_id % 2 = 0 AND a IN ('supply', 'withdraw', 'borrow', 'repay', 'claim'))"),
    "ev", more=_LENDING))
def streamed_rows_win(t: Tables):
    decoded, _ = events.typed_actions(events.lending_table(t.raw_lending()))
    streamed = decoded.filter((F.col("ledger_sequence") % 2 == 0) & F.col("action_type").isin(
        "supply", "withdraw", "borrow", "repay", "claim")).withColumn("src", F.lit("gs"))
    return events.new_actions(decoded, streamed).select("transaction_hash", "action_type", "ledger_sequence")


# --- state decoding -----------------------------------------------------------

@query(with_tables("""
SELECT pool_id, asset_address, CAST(day AS VARCHAR) AS snapshot_date, strftime(max(ts), '%Y-%m-%dT%H:%M:%SZ') AS snapshot_timestamp,
       max(event_id) AS ledger_sequence, round(arg_max(b_rate, event_id), 9) AS b_rate, round(arg_max(d_rate, event_id), 9) AS d_rate,
       round(arg_max(cents, event_id) * 1000 / 1e7::DOUBLE, 7) AS b_supply, round(arg_max(k, event_id) / 1e7::DOUBLE, 7) AS d_supply,
       arg_max(event_id, event_id) + 1700000000 AS last_time
FROM reserves GROUP BY pool_id, asset_address, day""", "reserves"))
def pool_snapshots_daily(t: Tables):
    out = snapshots.pool_snapshots(t.state(), start_date="2024-01-01", mode="key")
    return out.select("pool_id", "asset_address", day("snapshot_date"), iso_z(F.col("snapshot_timestamp"))
                      .alias("snapshot_timestamp"), "ledger_sequence", *[
                          F.round(F.col(c).cast("double"), 9).alias(c) for c in ("b_rate", "d_rate")], *[
                          F.round(F.col(c).cast("double"), 7).alias(c) for c in ("b_supply", "d_supply")], "last_time")


_POS_AMOUNTS = """round(coalesce(s, 0) / 1e7::DOUBLE, 7) AS supply_btokens, round(coalesce(c, 0) / 1e7::DOUBLE, 7) AS collateral_btokens,
       round(coalesce(l, 0) / 1e7::DOUBLE, 7) AS liabilities_dtokens"""


def _position_columns(df, *more):
    return df.select("pool_id", "user_address", "asset_address", "ledger_sequence", day("snapshot_date"), *[
        F.round(F.col(c).cast("double"), 7).alias(c)
        for c in ("supply_btokens", "collateral_btokens", "liabilities_dtokens")], *more)


_RATES9 = [("b_rate", 9), ("d_rate", 9)]


def _rates():
    return [F.round(F.col(c).cast("double"), n).alias(c) for c, n in _RATES9]


@query(with_tables(f"""
SELECT h.pool_id, h.user_address, 'RP3_1' AS asset_address, h.event_id AS ledger_sequence, CAST(h.day AS VARCHAR) AS snapshot_date,
       {_POS_AMOUNTS}, round(r.b_rate, 9) AS b_rate, round(r.d_rate, 9) AS d_rate
FROM (SELECT * FROM held WHERE pool_id = 'P3' AND reserve_index = 1) h
ASOF LEFT JOIN (SELECT event_id, b_rate, d_rate FROM reserves WHERE pool_id = 'P3' AND asset_address = 'RP3_1') r
  ON h.event_id >= r.event_id""", "held_by_place", "reserves"))
def position_changes_one_asset(t: Tables):
    out = positions.asset_position_changes(t.state(), "P3", "RP3_1", 1, mode="position", start_date="2024-01-01")
    return _position_columns(out, *_rates())


@query(with_tables(f"""
SELECT h.pool_id, h.user_address, m.asset_address, h.event_id AS ledger_sequence, CAST(h.day AS VARCHAR) AS snapshot_date,
       {_POS_AMOUNTS}
FROM held h LEFT JOIN mapping m USING (pool_id, reserve_index)
WHERE h.pool_id = 'P1' AND (coalesce(s, 0) <> 0 OR coalesce(c, 0) <> 0 OR coalesce(l, 0) <> 0)""", "held_by_key", "mapping"))
def pool_position_changes(t: Tables):
    return _position_columns(positions.pool_position_changes(t.state(), "P1", mode="key", start_date="2024-01-01"))


@query(with_tables(f"""
SELECT h.pool_id, h.user_address, h.asset_address, h.event_id AS ledger_sequence, CAST(h.day AS VARCHAR) AS snapshot_date,
       {_POS_AMOUNTS}, round(r.b_rate, 9) AS b_rate, round(r.d_rate, 9) AS d_rate
FROM (SELECT * FROM held JOIN mapping USING (pool_id, reserve_index)) h
ASOF LEFT JOIN reserves r ON h.pool_id = r.pool_id AND h.asset_address = r.asset_address AND h.event_id >= r.event_id""",
    "held_by_key", "mapping", "reserves"))
def position_changes_all_pools(t: Tables):
    out = positions.position_changes_with_rates(t.state(), mode="key", start_date="2024-01-01")
    return _position_columns(out, *_rates())


def _reassigned(t: Tables):
    """The state log with two assets that take each reserve index from one another."""
    second = (F.col("entry_type") == "ResConfig") & (F.col("ledger_sequence") % 3 == 0)
    return t.state().withColumns({
        "key_decoded": F.when(second, F.regexp_replace("key_decoded", "R(P[0-9]+)_", "R$1x")).otherwise(F.col("key_decoded")),
        "key_address": F.when(second, F.regexp_replace("key_address", "R(P[0-9]+)_", "R$1x")).otherwise(F.col("key_address"))})


_SPANS = """conf AS (
  SELECT pool_id, idx, event_id, event_id % 17 = 0 AS gone, 'R' || pool_id || CASE WHEN event_id % 3 = 0 THEN 'x' ELSE '_' END || idx AS asset
  FROM ev WHERE event_type = 'error'),
own AS (SELECT *, lead(event_id) OVER (PARTITION BY asset ORDER BY event_id) AS own_end FROM conf),
spans AS (
  SELECT pool_id, idx AS reserve_index, asset AS asset_address, event_id AS from_ledger,
         least(own_end, lead(event_id) OVER (PARTITION BY pool_id, idx ORDER BY event_id)) AS until_ledger
  FROM own WHERE NOT gone)"""


@query(with_tables(f"""
SELECT h.pool_id, h.user_address, CASE WHEN m.until_ledger <= h.event_id THEN NULL ELSE m.asset_address END AS asset_address,
       h.event_id AS ledger_sequence, CAST(h.day AS VARCHAR) AS snapshot_date, {_POS_AMOUNTS}
FROM held h ASOF LEFT JOIN spans m ON h.pool_id = m.pool_id AND h.reserve_index = m.reserve_index AND h.event_id >= m.from_ledger
WHERE coalesce(s, 0) <> 0 OR coalesce(c, 0) <> 0 OR coalesce(l, 0) <> 0""", "held_by_key", more=_SPANS))
def position_changes_valid_mapping(t: Tables):
    return _position_columns(positions.all_assets_changes(_reassigned(t), then_valid=True, start_date="2024-01-01"))


@query(with_tables(f"""
SELECT h.pool_id, h.user_address, m.asset_address, h.event_id AS ledger_sequence, CAST(h.day AS VARCHAR) AS snapshot_date,
       {_POS_AMOUNTS}
FROM held h LEFT JOIN mapping m USING (pool_id, reserve_index)
WHERE h.user_address = 'U7' AND (coalesce(s, 0) <> 0 OR coalesce(c, 0) <> 0 OR coalesce(l, 0) <> 0)""", "held_by_place", "mapping"))
def user_position_changes(t: Tables):
    return _position_columns(positions.user_position_changes(t.state(), "U7", mode="position", start_date="2024-01-01"))


@query(with_tables("SELECT pool_id, CAST(reserve_index AS BIGINT) AS reserve_index, asset_address FROM mapping", "mapping"))
def reserve_mapping(t: Tables):
    return decode.reserve_mapping(t.state(), "key")


@query(with_tables("""SELECT count(DISTINCT pool_id) AS total_pools, count(*) AS total_pairs,
       count(DISTINCT asset_address) AS unique_assets FROM mapping""", "mapping"))
def discovery_totals(t: Tables):
    return decode.discovery_totals(decode.reserve_mapping(t.state(), "key"))


@query(with_tables("""
SELECT CASE event_type WHEN 'view' THEN 'ResData' WHEN 'error' THEN 'ResConfig' ELSE 'Positions' END AS kind, count(*) AS n
FROM ev GROUP BY 1""", "ev"))
def entry_kinds(t: Tables):
    return t.state().groupBy(decode.entry_type(F.col("key_decoded")).alias("kind")).agg(F.count("*").alias("n"))


@query(with_tables("""
SELECT pool_address, snapshot_date, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS snapshot_timestamp, event_id AS ledger_sequence,
       shares, tokens, q4w, CASE WHEN shares > 0 THEN round(q4w * 100.0::DOUBLE / shares, 4) ELSE 0 END AS q4w_pct
FROM (SELECT pool_id AS pool_address, CAST(day AS VARCHAR) AS snapshot_date, ts, event_id, cents AS q4w,
             CASE WHEN k = 0 THEN 0 ELSE cents * 100 END AS shares, cents * 110 AS tokens,
             row_number() OVER (PARTITION BY pool_id, day ORDER BY event_id DESC) AS rn
      FROM ev WHERE ts >= TIMESTAMP '2024-01-02' AND ts < TIMESTAMP '2024-01-29') WHERE rn = 1""", "ev"))
def q4w_daily_pct(t: Tables):
    out = snapshots.backstop_balances(t.lp_state(), "BACKSTOP", "2024-01-02", "2024-01-29")
    return out.select("pool_address", day("snapshot_date"), iso_z(F.col("snapshot_timestamp")).alias("snapshot_timestamp"),
                      "ledger_sequence", *[F.col(c).cast("bigint").alias(c) for c in ("shares", "tokens", "q4w")], "q4w_pct")


_DAILY_Q4W = """balances AS (
  SELECT pool_id AS pool_address, CAST(day AS VARCHAR) AS snapshot_date, arg_max(cents, event_id) AS q4w,
         arg_max(CASE WHEN k = 0 THEN 0 ELSE cents * 100 END, event_id) AS shares FROM ev GROUP BY 1, 2)"""
_PCT = "CASE WHEN shares > 0 THEN round(q4w * 100.0::DOUBLE / shares, 4) ELSE 0 END AS q4w_pct"


@query(with_tables(f"""SELECT snapshot_date, q4w, {_PCT} FROM balances
WHERE pool_address = 'P4' AND snapshot_date >= '2024-01-05' AND snapshot_date <= '2024-01-20'""", "ev", more=_DAILY_Q4W))
def q4w_history(t: Tables):
    out = snapshots.q4w_history(snapshots.backstop_balances(t.lp_state(), "BACKSTOP"), "P4", "2024-01-05", "2024-01-20")
    return out.select(day("snapshot_date"), F.col("q4w").cast("bigint").alias("q4w"), "q4w_pct")


@query(with_tables(f"""SELECT pool_address, snapshot_date, q4w, {_PCT} FROM balances
QUALIFY row_number() OVER (PARTITION BY pool_address ORDER BY snapshot_date DESC) = 1""", "ev", more=_DAILY_Q4W))
def latest_q4w_by_pool(t: Tables):
    out = snapshots.latest_q4w_by_pool(snapshots.backstop_balances(t.lp_state(), "BACKSTOP"))
    return out.select("pool_address", day("snapshot_date"), F.col("q4w").cast("bigint").alias("q4w"), "q4w_pct")


@query(with_tables("""
SELECT CAST(day AS VARCHAR) AS price_date, max(event_id) AS ledger_sequence,
       round(arg_max(5.0::DOUBLE * (cents * 7) / (cents * 11 + k + 1), event_id), 6) AS lp_token_price FROM ev GROUP BY day""", "ev"))
def lp_price_daily(t: Tables):
    return snapshots.lp_prices(t.lp_state(), "LPTOKEN").select(day("price_date"), "ledger_sequence", *r6("lp_token_price"))


_BALANCES = ("supply_balance", "collateral_balance", "debt_balance", "net_balance")

# --- balances -----------------------------------------------------------------

@query(with_tables("""
SELECT p.pool_id, p.user_address, p.asset_address, CAST(p.snapshot_date AS VARCHAR) AS snapshot_date, p.ledger_sequence,
       round(p.supply_btokens * r.b_rate, 9) AS supply_balance, round(p.collateral_btokens * r.b_rate, 9) AS collateral_balance,
       round(p.liabilities_dtokens * r.d_rate, 9) AS debt_balance,
       round((p.supply_btokens + p.collateral_btokens) * r.b_rate - p.liabilities_dtokens * r.d_rate, 9) AS net_balance
FROM (SELECT * FROM positions WHERE snapshot_date = (SELECT max(snapshot_date) FROM positions)
      QUALIFY row_number() OVER (PARTITION BY pool_id, user_address, asset_address ORDER BY ledger_sequence DESC) = 1) p
JOIN snapshots r USING (pool_id, asset_address, snapshot_date)""", "positions", "snapshots"))
def user_balance_latest(t: Tables):
    out = balances.user_balance(t.positions(), t.snapshots())
    return out.select("pool_id", "user_address", "asset_address", day("snapshot_date"), "ledger_sequence",
                      *[F.round(c, 9).alias(c) for c in _BALANCES])


@query(with_tables("""
SELECT pool_id, user_address, asset_address, CAST(d AS VARCHAR) AS snapshot_date, position_date, ledger_sequence,
       round(b, 9) AS b_rate, round(s * b, 9) AS supply_balance, round(c * b, 9) AS collateral_balance,
       round(l * r, 9) AS debt_balance, round((s + c) * b - l * r, 9) AS net_balance
FROM (
  SELECT g.pool_id, g.user_address, g.asset_address, g.d, CAST(p.snapshot_date AS VARCHAR) AS position_date, p.ledger_sequence,
         p.supply_btokens AS s, p.collateral_btokens AS c, p.liabilities_dtokens AS l,
         CASE WHEN p.snapshot_date = g.d THEN coalesce(p.b_rate, r.b_rate, 1.0) ELSE coalesce(r.b_rate, 1.0) END AS b,
         CASE WHEN p.snapshot_date = g.d THEN coalesce(p.d_rate, r.d_rate, 1.0) ELSE coalesce(r.d_rate, 1.0) END AS r
  FROM (SELECT pool_id, user_address, asset_address, CAST(d AS DATE) AS d
        FROM (SELECT DISTINCT pool_id, user_address, asset_address FROM positions),
             generate_series(TIMESTAMP '2024-01-10', TIMESTAMP '2024-01-31', INTERVAL 1 DAY) s(d)) g
  ASOF JOIN (SELECT * FROM positions QUALIFY row_number() OVER (
               PARTITION BY pool_id, user_address, asset_address, snapshot_date ORDER BY ledger_sequence DESC) = 1) p
    ON g.pool_id = p.pool_id AND g.user_address = p.user_address AND g.asset_address = p.asset_address AND g.d >= p.snapshot_date
  ASOF LEFT JOIN snapshots r ON g.pool_id = r.pool_id AND g.asset_address = r.asset_address AND g.d >= r.snapshot_date)""",
    "positions", "snapshots"))
def balance_history(t: Tables):
    out = balances.balance_history(t.positions(), t.snapshots(), "2024-01-10", "2024-01-31")
    return out.select("pool_id", "user_address", "asset_address", day("snapshot_date"), day("position_date"),
                      "ledger_sequence", F.round("b_rate", 9).alias("b_rate"),
                      *[F.round(c, 9).alias(c) for c in _BALANCES])


# --- derived views ------------------------------------------------------------

_VIEW_RATES = """rates AS (
  SELECT id, pool_id, asset_address, ledger_sequence, implied_rate, ledger_closed_at,
         CASE WHEN action_type IN ('borrow', 'repay') THEN 'd_rate' ELSE 'b_rate' END AS rate_type
  FROM actions WHERE action_type <> 'claim' AND implied_rate IS NOT NULL)"""


@query(with_tables("""
SELECT user_address, pool_id, asset_address,
  CAST(sum(CASE action_type WHEN 'supply' THEN amount_tokens WHEN 'withdraw' THEN -amount_tokens ELSE 0 END) AS BIGINT) AS supply_btokens,
  CAST(sum(CASE action_type WHEN 'supply_collateral' THEN amount_tokens WHEN 'withdraw_collateral' THEN -amount_tokens ELSE 0 END) AS BIGINT) AS collateral_btokens,
  CAST(sum(CASE action_type WHEN 'borrow' THEN amount_tokens WHEN 'repay' THEN -amount_tokens ELSE 0 END) AS BIGINT) AS debt_dtokens,
  count(*) AS action_count, strftime(max(ledger_closed_at), '%Y-%m-%dT%H:%M:%SZ') AS last_action_time
FROM actions WHERE action_type <> 'claim' GROUP BY 1, 2, 3""", "actions"))
def view_user_positions(t: Tables):
    return views.user_positions(t.actions()).select(
        "user_address", "pool_id", "asset_address",
        *[F.col(c).cast("bigint").alias(c) for c in ("supply_btokens", "collateral_btokens", "debt_dtokens")],
        "action_count", iso_z(F.col("last_action_time")).alias("last_action_time"))


@query(with_tables("SELECT id, pool_id, asset_address, rate_type, round(implied_rate, 9) AS implied_rate FROM rates",
                   "actions", more=_VIEW_RATES))
def view_derived_rates(t: Tables):
    return views.derived_rates(t.actions()).select("id", "pool_id", "asset_address", "rate_type",
                                                   F.round("implied_rate", 9).alias("implied_rate"))


@query(with_tables("""SELECT pool_id, asset_address, rate_type, round(arg_max(implied_rate, ledger_sequence), 9) AS implied_rate,
  max(ledger_sequence) AS ledger_sequence FROM rates GROUP BY 1, 2, 3""", "actions", more=_VIEW_RATES))
def view_latest_rates(t: Tables):
    return views.latest_rates(t.actions()).select("pool_id", "asset_address", "rate_type",
                                                  F.round("implied_rate", 9).alias("implied_rate"), "ledger_sequence")


@query(with_tables("""SELECT pool_id, asset_address, rate_type, CAST(CAST(ledger_closed_at AS DATE) AS VARCHAR) AS snapshot_date,
  round(avg(implied_rate), 6) AS avg_rate, round(min(implied_rate), 6) AS min_rate, round(max(implied_rate), 6) AS max_rate,
  count(*) AS samples FROM rates GROUP BY 1, 2, 3, 4""", "actions", more=_VIEW_RATES))
def view_daily_rates(t: Tables):
    return views.daily_rate_stats(t.actions()).select("pool_id", "asset_address", "rate_type", day("snapshot_date"),
                                                      *r6("avg_rate", "min_rate", "max_rate"), "samples")


@query(with_tables("""SELECT id, user_address, pool_id, asset_address, amount_underlying AS claim_amount,
  strftime(ledger_closed_at, '%Y-%m-%dT%H:%M:%SZ') AS claim_time FROM actions WHERE action_type = 'claim'""", "actions"))
def view_user_claims(t: Tables):
    return views.user_claims(t.actions()).withColumns({
        "claim_amount": F.col("claim_amount").cast("bigint"), "claim_time": iso_z(F.col("claim_time"))})


@query(with_tables("""SELECT user_address, CAST(sum(amount_underlying) AS BIGINT) AS total_claimed, count(*) AS claim_count,
  strftime(min(ledger_closed_at), '%Y-%m-%dT%H:%M:%SZ') AS first_claim, strftime(max(ledger_closed_at), '%Y-%m-%dT%H:%M:%SZ') AS last_claim
  FROM actions WHERE action_type = 'claim' GROUP BY 1""", "actions"))
def view_user_total_claims(t: Tables):
    return views.user_total_claims(t.actions()).withColumns({
        "total_claimed": F.col("total_claimed").cast("bigint"),
        "first_claim": iso_z(F.col("first_claim")), "last_claim": iso_z(F.col("last_claim"))})


@query("SELECT event_id, json_extract_string(props, '$.k') AS k FROM events")
def json_extract_scalar(t: Tables):
    return t.raw("events").select("event_id", json_scalar(F.col("props"), "$.k").alias("k"))
