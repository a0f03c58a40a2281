"""The adapters' tables as common table expressions for the SQL twins."""

from __future__ import annotations

EV = """ev AS (
  SELECT event_id, ts, user_id, event_type, value, props, k, CAST(round(value * 100) AS BIGINT) AS cents,
         'P' || (k % 5) AS pool_id, 'A' || ((k // 5) % 10) AS asset_address, 'U' || user_id AS user_address,
         (k // 5) % 4 AS idx, CAST(ts AS DATE) AS day
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events))"""

ACTIONS = """actions AS (
  SELECT CAST(event_id AS VARCHAR) AS id, pool_id, 'T' || event_id AS transaction_hash, event_id AS ledger_sequence,
         ts AS ledger_closed_at,
         CASE event_type WHEN 'signup' THEN CASE WHEN event_id % 2 = 0 THEN 'supply' ELSE 'supply_collateral' END
              WHEN 'click' THEN CASE WHEN event_id % 2 = 0 THEN 'withdraw' ELSE 'withdraw_collateral' END
              WHEN 'purchase' THEN 'borrow' WHEN 'view' THEN 'repay' ELSE 'claim' END AS action_type,
         asset_address, user_address, cents * 100000 AS amount_underlying,
         CASE WHEN event_type <> 'error' THEN cents * 90000 + k END AS amount_tokens,
         CASE WHEN event_type <> 'error' AND cents * 90000 + k <> 0
              THEN (cents * 100000.0::DOUBLE) / CAST(cents * 90000 + k AS DOUBLE) END AS implied_rate,
         CASE WHEN event_id % 2 = 0 THEN 'gs' ELSE 'bq' END AS src
  FROM ev)"""

TOKENS = """tokens AS (
  SELECT 'A' || p_partkey AS asset_address, 'S' || p_partkey AS symbol, p_name AS name, 7 AS decimals,
         CASE WHEN p_size % 2 = 0 THEN p_type END AS coingecko_id,
         CASE p_size % 5 WHEN 0 THEN 'USD' WHEN 1 THEN 'eur' WHEN 2 THEN 'gbp' END AS pegged_currency, p_partkey = 0 AS is_native
  FROM part)"""

POOLS = """pools AS (
  SELECT 'P' || n_nationkey AS pool_id, n_name AS name, substr(n_name, 1, 6) AS short_name, 'v2' AS version,
         n_regionkey <> 1 AS is_active FROM nation)"""

HISTORY = """history AS (
  SELECT a.*, p.name AS pool_name, t.symbol AS asset_symbol, t.name AS asset_name
  FROM actions a LEFT JOIN pools p USING (pool_id) LEFT JOIN tokens t USING (asset_address))"""

BACKSTOP = """backstop AS (
  SELECT 'b' || event_id AS id, 'T' || event_id AS transaction_hash, event_id AS ledger_sequence, ts AS ledger_closed_at,
         CASE event_type WHEN 'signup' THEN 'deposit' WHEN 'click' THEN 'withdraw' WHEN 'purchase' THEN 'queue_withdrawal'
              WHEN 'view' THEN 'donate' ELSE 'claim' END AS action_type,
         CASE WHEN event_type <> 'error' THEN pool_id END AS pool_address, user_address,
         CASE WHEN event_type <> 'purchase' THEN cents * 100000 END AS lp_tokens
  FROM ev)"""

PRICES = """prices AS (
  SELECT 'A' || l_partkey AS token_address, CAST(l_shipdate AS DATE) AS price_date,
         max(l_extendedprice) / 1000.0::DOUBLE AS usd_price, max(l_returnflag) AS source
  FROM lineitem GROUP BY 1, 2)"""

SYMBOL_PRICES = """symbol_prices AS (
  SELECT upper(t.symbol) AS symbol, max(p.usd_price) AS price
  FROM (SELECT token_address, arg_max(usd_price, price_date) AS usd_price FROM prices GROUP BY 1) p
  JOIN tokens t ON t.asset_address = p.token_address GROUP BY 1)"""

DAY_PRICES = """day_prices AS (
  SELECT asset_address AS token_address, day AS price_date, max(cents) / 100.0::DOUBLE AS usd_price FROM ev GROUP BY 1, 2
  UNION ALL
  SELECT CASE event_type WHEN 'view' THEN 'RWD' ELSE 'LP' END, day, max(cents) / 100.0::DOUBLE FROM ev
  WHERE event_type IN ('view', 'click') GROUP BY 1, 2)"""

SNAPSHOTS = """snapshots AS (
  SELECT pool_id, asset_address, day AS snapshot_date, max(event_id) AS ledger_sequence,
         (arg_max(cents, event_id) + 1000000) / 1e6::DOUBLE AS b_rate,
         (arg_max(cents, event_id) * 2 + 1000000) / 1e6::DOUBLE AS d_rate,
         CAST(arg_max(cents, event_id) AS DOUBLE) AS b_supply, CAST(arg_max(k, event_id) AS DOUBLE) AS d_supply
  FROM ev WHERE event_type = 'view' GROUP BY 1, 2, 3)"""

POSITIONS = """positions AS (
  SELECT pool_id, user_address, asset_address, day AS snapshot_date, ts AS snapshot_timestamp, event_id AS ledger_sequence,
         cents / 100.0::DOUBLE AS supply_btokens, CAST(k AS DOUBLE) AS collateral_btokens,
         CAST(event_id % 50 AS DOUBLE) AS liabilities_dtokens,
         CASE WHEN k % 2 = 0 THEN (cents * 3 + 1000000) / 1e6::DOUBLE END AS b_rate,
         CASE WHEN k % 3 = 0 THEN (cents * 4 + 1000000) / 1e6::DOUBLE END AS d_rate
  FROM ev WHERE event_type = 'purchase')"""

CONFIGS = """configs AS (
  SELECT 'backstop' AS config_type, 'P' || n_nationkey AS pool_address, NULL AS asset_address,
         CAST((n_nationkey + 1) AS BIGINT) * 1000000000000 AS eps, 14 AS eps_decimals, NULL AS expiration FROM nation
  UNION ALL
  SELECT 'lending_' || s.side, pool_id, asset_address, CAST(k + 1 AS BIGINT) * s.factor, 14,
         CASE WHEN k % 2 = 1 THEN 1705276800 END
  FROM (SELECT pool_id, asset_address, max(k) AS k FROM ev GROUP BY 1, 2),
       (VALUES ('supply', 100000000000), ('borrow', 70000000000)) s(side, factor))"""

RESERVE_STATE = """reserve_state AS (
  SELECT pool_id, asset_id, last_ledger AS ledger_sequence, c * 20000000 AS total_supply, k * 20000000 AS total_liabilities,
         CASE WHEN k % 2 = 0 THEN CAST(k AS BIGINT) * 1000000000 ELSE 0 END AS supply_eps,
         CASE WHEN k % 3 = 0 THEN CAST(k AS BIGINT) * 2000000000 ELSE 0 END AS borrow_eps,
         CASE WHEN k % 4 = 0 THEN 0 ELSE 1705276800 END AS supply_expiration,
         CASE WHEN k % 5 = 0 THEN 0 ELSE 1705276800 END AS borrow_expiration,
         CASE WHEN k % 7 = 0 THEN 0.0::DOUBLE ELSE c / 100.0::DOUBLE END AS oracle_price
  FROM (SELECT pool_id, asset_address AS asset_id, max(event_id) AS last_ledger, arg_max(cents, event_id) AS c,
               arg_max(k, event_id) AS k FROM ev GROUP BY 1, 2))"""

BACKSTOP_STATE = """backstop_state AS (
  SELECT pool_id, CAST(sum(cents) AS BIGINT) * 1000 AS shares, CAST(sum(cents) AS BIGINT) * 1100 AS tokens,
         CAST(sum(cents) AS BIGINT) * 10 AS q4w, 500000000000 AS eps, 14 AS eps_decimals, 0 AS expiration
  FROM ev GROUP BY 1)"""

# Contract-state rows without the JSON wrapping: what a right decode must return.
RESERVES = """reserves AS (
  SELECT pool_id, 'R' || pool_id || '_' || idx AS asset_address, day, ts, event_id, cents, k,
         (cents * 1000000 + 1000000000000) / 1e12::DOUBLE AS b_rate, (cents * 2000000 + 1000000000000) / 1e12::DOUBLE AS d_rate
  FROM ev WHERE event_type = 'view' AND event_id % 17 <> 0)"""

MAPPING = """mapping AS (
  SELECT DISTINCT pool_id, idx AS reserve_index, 'R' || pool_id || '_' || idx AS asset_address
  FROM ev WHERE event_type = 'error' AND event_id % 17 <> 0)"""

# One row per reserve index held: by the stored key, and by the place in the list.
HELD_BY_KEY = """held AS (
  SELECT pool_id, user_address, event_id, ts, day, i.n AS reserve_index,
         CASE WHEN i.n = idx THEN cents * 2000 ELSE k END AS s, CASE WHEN i.n = idx THEN cents * 1000 END AS c,
         CASE WHEN i.n = idx + 1 THEN k * 1000 END AS l
  FROM ev, LATERAL (SELECT unnest([idx, idx + 1]) AS n) i
  WHERE event_type IN ('signup', 'click', 'purchase') AND event_id % 17 <> 0)"""

HELD_BY_PLACE = """held AS (
  SELECT pool_id, user_address, event_id, ts, day, i.n AS reserve_index,
         CASE WHEN i.n = 0 THEN cents * 2000 ELSE k END AS s, CASE WHEN i.n = 0 THEN cents * 1000 END AS c,
         CASE WHEN i.n = 0 THEN k * 1000 END AS l
  FROM ev, LATERAL (SELECT unnest([0, 1]) AS n) i
  WHERE event_type IN ('signup', 'click', 'purchase') AND event_id % 17 <> 0)"""

_NEEDS = {
    "actions": ["ev"], "history": ["actions", "pools", "tokens"], "backstop": ["ev"], "symbol_prices": ["prices", "tokens"],
    "day_prices": ["ev"], "snapshots": ["ev"], "positions": ["ev"], "configs": ["ev"], "reserve_state": ["ev"],
    "backstop_state": ["ev"], "reserves": ["ev"], "mapping": ["ev"], "held_by_key": ["ev"], "held_by_place": ["ev"],
}
_TABLES = {
    "ev": EV, "actions": ACTIONS, "tokens": TOKENS, "pools": POOLS, "history": HISTORY, "backstop": BACKSTOP,
    "prices": PRICES, "symbol_prices": SYMBOL_PRICES, "day_prices": DAY_PRICES, "snapshots": SNAPSHOTS,
    "positions": POSITIONS, "configs": CONFIGS, "reserve_state": RESERVE_STATE, "backstop_state": BACKSTOP_STATE,
    "reserves": RESERVES, "mapping": MAPPING, "held_by_key": HELD_BY_KEY, "held_by_place": HELD_BY_PLACE,
}


def with_tables(body: str, *names: str, more: str = "") -> str:
    """``WITH <tables> <body>``; tables that the named ones need come along."""
    order: list[str] = []

    def add(name: str) -> None:
        for needed in _NEEDS.get(name, []):
            add(needed)
        if name not in order:
            order.append(name)

    for n in names:
        add(n)
    parts = [_TABLES[n] for n in order] + ([more] if more else [])
    return f"WITH {', '.join(parts)}\n{body}"
