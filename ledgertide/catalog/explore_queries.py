"""Exploration queries over the action history."""

from pyspark.sql import functions as F

from ..operators.paging import ordering, page_with_total
from ..plans import explore
from .adapters import Tables
from .registry import query
from .sqltables import with_tables


def r6(*names: str):
    return [F.round(F.col(n).cast("double"), 6).alias(n) for n in names]


def day(name: str):
    return F.col(name).cast("string").alias(name)


_FLOW = """CAST(sum(CASE WHEN action_type IN ('{a}', '{b}') THEN amount_underlying ELSE 0 END) AS DOUBLE) / 1e7"""
_DEP, _WD = _FLOW.format(a="supply", b="supply_collateral"), _FLOW.format(a="withdraw", b="withdraw_collateral")


@query(with_tables(f"""
SELECT round(sum(d), 6) AS total_deposits, round(sum(d * coalesce(price, 0)), 6) AS total_deposits_usd,
       round(sum(w), 6) AS total_withdrawals, round(sum(w * coalesce(price, 0)), 6) AS total_withdrawals_usd,
       round(sum(d) - sum(w), 6) AS net_flow, round(sum(d * coalesce(price, 0)) - sum(w * coalesce(price, 0)), 6) AS net_flow_usd,
       CAST(sum(n) AS BIGINT) AS total_events,
       (SELECT count(DISTINCT user_address) FROM history
        WHERE ledger_closed_at >= TIMESTAMP '2024-01-03' AND ledger_closed_at < TIMESTAMP '2024-01-28') AS active_accounts
FROM (SELECT asset_symbol, {_DEP} AS d, {_WD} AS w, count(*) AS n FROM history
      WHERE ledger_closed_at >= TIMESTAMP '2024-01-03' AND ledger_closed_at < TIMESTAMP '2024-01-28' GROUP BY 1) f
LEFT JOIN symbol_prices s ON s.symbol = upper(f.asset_symbol)""", "history", "symbol_prices"))
def aggregate_flows(t: Tables):
    prices = explore.latest_symbol_prices(t.prices(), t.tokens())
    out = explore.aggregate_metrics(t.actions(), t.tokens(), prices, "2024-01-03", "2024-01-28")
    return out.select(*r6("total_deposits", "total_deposits_usd", "total_withdrawals", "total_withdrawals_usd",
                          "net_flow", "net_flow_usd"), "total_events", "active_accounts")


@query(with_tables(f"""
SELECT asset_address, asset_symbol, asset_name, round(d, 6) AS deposit_volume, round(w, 6) AS withdraw_volume,
       round(d - w, 6) AS net_volume, round(d * coalesce(price, 0), 6) AS deposit_volume_usd
FROM (SELECT asset_address, asset_symbol, asset_name, {_DEP} AS d, {_WD} AS w FROM history GROUP BY 1, 2, 3
      ORDER BY d DESC, asset_address LIMIT 7) v
LEFT JOIN symbol_prices s ON s.symbol = upper(v.asset_symbol)""", "history", "symbol_prices"))
def volume_by_asset(t: Tables):
    prices = explore.latest_symbol_prices(t.prices(), t.tokens())
    out = explore.volume_by_token(t.actions(), t.tokens(), 7, prices)
    return out.select("asset_address", "asset_symbol", "asset_name",
                      *r6("deposit_volume", "withdraw_volume", "net_volume", "deposit_volume_usd"))


_MIN_DEPOSIT = """
SELECT user_address, CAST(sum(amount_underlying) AS DOUBLE) / 1e7 AS total, count(*) AS deposit_count,
       strftime(max(ledger_closed_at), '%Y-%m-%dT%H:%M:%SZ') AS last_deposit_date
FROM actions WHERE asset_address = 'A3' AND action_type IN ('supply', 'supply_collateral')
GROUP BY 1 HAVING CAST(sum(amount_underlying) AS DOUBLE) / 1e7 >= 40 / 2.5"""


@query(with_tables(f"""
SELECT user_address, round(total, 6) AS total_deposited, round(total * 2.5, 6) AS total_deposited_usd, deposit_count,
       last_deposit_date, (SELECT count(*) FROM ({_MIN_DEPOSIT})) AS total_count
FROM ({_MIN_DEPOSIT}) ORDER BY total DESC, user_address LIMIT 20 OFFSET 5""", "actions"))
def having_min_deposit(t: Tables):
    out = explore.accounts_by_min_deposit(t.actions(), "A3", 40.0, price=2.5, in_usd=True, limit=20, offset=5)
    return out.select("user_address", *r6("total_deposited", "total_deposited_usd"), "deposit_count",
                      "last_deposit_date", "total_count")


@query(with_tables("""
SELECT user_address, CAST(sum(n) AS BIGINT) AS event_count, string_agg(action_type || ':' || n, ',' ORDER BY action_type) AS events_by_type,
       strftime(min(lo), '%Y-%m-%dT%H:%M:%SZ') AS first_event_date, strftime(max(hi), '%Y-%m-%dT%H:%M:%SZ') AS last_event_date
FROM (SELECT user_address, action_type, count(*) AS n, min(ledger_closed_at) AS lo, max(ledger_closed_at) AS hi
      FROM actions WHERE action_type IN ('supply', 'borrow', 'claim') GROUP BY 1, 2)
GROUP BY 1 HAVING sum(n) >= 5""", "actions"))
def event_count_map(t: Tables):
    out = explore.accounts_by_event_count(t.actions(), ["supply", "borrow", "claim"], 5, limit=None)
    pairs = F.array_sort(F.transform(F.map_entries("events_by_type"), lambda e: F.concat_ws(":", e["key"], e["value"])))
    return out.select("user_address", "event_count", F.array_join(pairs, ",").alias("events_by_type"),
                      "first_event_date", "last_event_date")


_NET = """SELECT user_address, pool_id, asset_address,
 sum(CASE action_type WHEN 'supply' THEN amount_tokens WHEN 'withdraw' THEN -amount_tokens ELSE 0 END) AS s,
 sum(CASE action_type WHEN 'supply_collateral' THEN amount_tokens WHEN 'withdraw_collateral' THEN -amount_tokens ELSE 0 END) AS c,
 sum(CASE action_type WHEN 'borrow' THEN amount_tokens WHEN 'repay' THEN -amount_tokens ELSE 0 END) AS d
 FROM actions GROUP BY 1, 2, 3"""
_RATED = f"""net AS ({_NET}),
latest AS (SELECT pool_id, asset_address, arg_max(b_rate, snapshot_date) AS b, arg_max(d_rate, snapshot_date) AS d
           FROM snapshots GROUP BY 1, 2),
bal AS (SELECT user_address, asset_address, sum(CAST(s AS DOUBLE) / 1e7 * coalesce(l.b, 1)) AS supply_balance,
        sum(CAST(c AS DOUBLE) / 1e7 * coalesce(l.b, 1)) AS collateral_balance,
        sum(CAST(n.d AS DOUBLE) / 1e7 * coalesce(l.d, 1)) AS debt_balance
        FROM net n LEFT JOIN latest l USING (pool_id, asset_address) GROUP BY 1, 2)"""


@query(with_tables("""
SELECT user_address, pool_id, CAST(sum(s) AS BIGINT) AS supply_btokens, CAST(sum(c) AS BIGINT) AS collateral_btokens,
       CAST(sum(d) AS BIGINT) AS debt_dtokens FROM net GROUP BY 1, 2""", "actions", more=f"net AS ({_NET})"))
def net_position(t: Tables):
    return explore.net_positions(t.actions()).select("user_address", "pool_id", *[
        F.col(c).cast("bigint").alias(c) for c in ("supply_btokens", "collateral_btokens", "debt_dtokens")])


@query(with_tables("""
SELECT user_address, asset_address, round(supply_balance, 6) AS supply_balance, round(collateral_balance, 6) AS collateral_balance,
       round(debt_balance, 6) AS debt_balance, round(supply_balance + collateral_balance - debt_balance, 6) AS net_balance
FROM bal""", "actions", "snapshots", more=_RATED))
def rate_weighted_balance(t: Tables):
    from ..plans.views import daily_rates

    out = explore.rated_balances(t.actions(), daily_rates(t.snapshots()), ["user_address", "asset_address"])
    return out.select("user_address", "asset_address",
                      *r6("supply_balance", "collateral_balance", "debt_balance", "net_balance"))


@query(with_tables("""
SELECT b.user_address, round(b.supply_balance, 6) AS supply_balance, round(b.collateral_balance, 6) AS collateral_balance,
       round(b.debt_balance, 6) AS debt_balance,
       round(b.supply_balance + b.collateral_balance - b.debt_balance, 6) AS net_balance
FROM bal b WHERE b.asset_address = 'A2' AND b.user_address IN (
  SELECT user_address FROM bal WHERE asset_address = 'A2' AND supply_balance + collateral_balance - debt_balance >= -50
    AND supply_balance + collateral_balance > 0
  INTERSECT
  SELECT user_address FROM bal WHERE asset_address = 'A7' AND supply_balance + collateral_balance - debt_balance >= -80 / 2.0
    AND supply_balance + collateral_balance > 0)
AND EXISTS (SELECT 1 FROM backstop s WHERE s.user_address = b.user_address)""", "actions", "snapshots", "backstop", more=_RATED))
def token_intersect_filter(t: Tables):
    from ..plans.views import daily_rates

    out = explore.accounts_by_balance(
        t.actions(), daily_rates(t.snapshots()),
        [explore.TokenFilter("A2", "S2", -50.0), explore.TokenFilter("A7", "S7", -80.0)], prices={"S7": 2.0},
        in_usd=True, backstop_events=t.backstop(), limit=None, has_deposits=True, has_backstop=True)
    return out.select("user_address", *r6("supply_balance", "collateral_balance", "debt_balance", "net_balance"))


@query(with_tables("""
SELECT user_address FROM bal WHERE asset_address = 'A1' AND supply_balance > 0 INTERSECT
SELECT user_address FROM bal WHERE asset_address = 'A4' AND collateral_balance > 0 INTERSECT
SELECT user_address FROM bal WHERE asset_address = 'A6' AND debt_balance <= 0""", "actions", "snapshots", more=_RATED))
def nway_user_intersect(t: Tables):
    from ..plans.views import daily_rates

    bal = explore.rated_balances(t.actions(), daily_rates(t.snapshots()), ["user_address", "asset_address"])
    picks = [bal.filter((F.col("asset_address") == a) & c).select("user_address") for a, c in (
        ("A1", F.col("supply_balance") > 0), ("A4", F.col("collateral_balance") > 0), ("A6", F.col("debt_balance") <= 0))]
    return explore.matching_users(picks)


@query(with_tables("""
SELECT user_address, pool_id, pool_name, asset_symbol, round(total, 6) AS total_deposited,
       row_number() OVER (ORDER BY total DESC, user_address, asset_symbol) AS rank,
       round(total * coalesce(price, 0), 6) AS total_deposited_usd
FROM (SELECT user_address, pool_id, pool_name, asset_symbol, CAST(sum(amount_underlying) AS DOUBLE) / 1e7 AS total
      FROM history WHERE pool_id = 'P2' AND action_type IN ('supply', 'supply_collateral') GROUP BY 1, 2, 3, 4) d
LEFT JOIN symbol_prices s ON s.symbol = upper(d.asset_symbol) ORDER BY rank LIMIT 25""", "history", "symbol_prices"))
def top_depositors_ranked(t: Tables):
    prices = explore.latest_symbol_prices(t.prices(), t.tokens())
    out = explore.top_depositors(t.actions(), t.pools(), t.tokens(), "P2", 25, prices=prices)
    return out.select("user_address", "pool_id", "pool_name", "asset_symbol", *r6("total_deposited"), "rank",
                      *r6("total_deposited_usd"))


@query(with_tables("""
SELECT p.pool_id, p.name AS pool_name, p.short_name AS pool_short_name, coalesce(s.n, 0) AS event_count,
       coalesce(s.types, '') AS unique_event_types, coalesce(s.k, 0) AS unique_event_type_count, s.lo AS first_event_date,
       s.hi AS last_event_date
FROM pools p LEFT JOIN (
  SELECT pool_id, count(*) AS n, string_agg(DISTINCT action_type, ',' ORDER BY action_type) AS types,
         count(DISTINCT action_type) AS k, strftime(min(ledger_closed_at), '%Y-%m-%dT%H:%M:%SZ') AS lo,
         strftime(max(ledger_closed_at), '%Y-%m-%dT%H:%M:%SZ') AS hi FROM actions GROUP BY 1) s USING (pool_id)
WHERE p.is_active""", "actions", "pools"))
def pool_stats_arrays(t: Tables):
    out = explore.pool_statistics(t.pools(), t.actions(), limit=None)
    return out.select("pool_id", "pool_name", "pool_short_name", "event_count",
                      F.array_join("unique_event_types", ",").alias("unique_event_types"), "unique_event_type_count",
                      "first_event_date", "last_event_date")


@query(with_tables("""SELECT id, pool_name, asset_symbol, asset_name, amount_underlying FROM history""", "history"))
def action_history_view(t: Tables):
    return t.history().select("id", "pool_name", "asset_symbol", "asset_name",
                              F.col("amount_underlying").cast("bigint").alias("amount_underlying"))


@query(with_tables("SELECT pool_id, name, short_name, version FROM pools WHERE is_active", "pools"))
def pool_list(t: Tables):
    return explore.pool_list(t.pools()).select("pool_id", "name", "short_name", "version")


@query(with_tables("SELECT asset_address, symbol, name, decimals, coingecko_id, is_native FROM tokens", "tokens"))
def token_list(t: Tables):
    return explore.token_list(t.tokens()).drop("icon_url")


@query("""SELECT o_orderkey, round(o_totalprice, 2) AS o_totalprice, (SELECT count(*) FROM orders) AS total_count
FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 50 OFFSET 100""")
def paged_with_total(t: Tables):
    rows = t.raw("orders").select("o_orderkey", "o_totalprice")
    out = page_with_total(rows, ordering("o_totalprice", "desc", ["o_orderkey"]), 50, 100)
    return out.select("o_orderkey", F.round("o_totalprice", 2).alias("o_totalprice"), "total_count")


_LARGE = "SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_orderpriority = '1-URGENT'"


def _urgent_customers(t: Tables):
    return t.raw("orders").filter(F.col("o_orderpriority") == "1-URGENT").select(F.col("o_custkey").alias("c_custkey"))


@query(f"SELECT c_custkey, c_name FROM customer c WHERE EXISTS ({_LARGE})")
def semi_has_activity(t: Tables):
    return t.raw("customer").join(_urgent_customers(t), "c_custkey", "left_semi").select("c_custkey", "c_name")


@query(f"SELECT c_custkey, c_name FROM customer c WHERE NOT EXISTS ({_LARGE})")
def anti_no_activity(t: Tables):
    return t.raw("customer").join(_urgent_customers(t), "c_custkey", "left_anti").select("c_custkey", "c_name")
