"""Prices, yields and dimension sync."""

from pyspark.sql import functions as F

from ..operators.paging import page
from ..plans import prices, refdata, yields
from ..sources import files
from .adapters import Tables, _text
from .explore_queries import day, r6
from .registry import ORACLES, query
from .sqltables import with_tables

# --- statistics ---------------------------------------------------------------


@query(with_tables("""
SELECT t.asset_address, t.symbol, t.name, coalesce(s.n, 0) AS total_records, coalesce(s.src, '') AS source_counts,
       CAST(s.lo AS VARCHAR) AS earliest_date, CAST(s.hi AS VARCHAR) AS latest_date, round(s.first, 6) AS earliest_price,
       round(s.last, 6) AS latest_price
FROM tokens t LEFT JOIN (
  SELECT token_address, CAST(sum(n) AS BIGINT) AS n, string_agg(source || ':' || n, ',' ORDER BY source) AS src, min(lo) AS lo, max(hi) AS hi,
         arg_min(first, lo) AS first, arg_max(last, hi) AS last
  FROM (SELECT token_address, source, count(*) AS n, min(price_date) AS lo, max(price_date) AS hi,
               arg_min(usd_price, price_date) AS first, arg_max(usd_price, price_date) AS last FROM prices GROUP BY 1, 2)
  GROUP BY 1) s ON s.token_address = t.asset_address""", "tokens", "prices"))
def token_price_stats(t: Tables):
    out = prices.token_price_statistics(t.tokens(), t.prices())
    pairs = F.array_sort(F.transform(F.map_entries("source_counts"), lambda e: F.concat_ws(":", e["key"], e["value"])))
    return out.select("asset_address", "symbol", "name", "total_records", F.array_join(pairs, ",").alias("source_counts"),
                      day("earliest_date"), day("latest_date"), *r6("earliest_price", "latest_price"))


@query(with_tables("SELECT DISTINCT source FROM prices", "prices"))
def price_sources(t: Tables):
    return prices.price_sources(t.prices())


@query(with_tables("""SELECT token_address, count(*) FILTER (source = 'A') AS A, count(*) FILTER (source = 'N') AS N,
  count(*) FILTER (source = 'R') AS R FROM prices GROUP BY 1""", "prices"))
def source_pivot_counts(t: Tables):
    return prices.source_count_table(t.prices(), ["A", "N", "R"])


@query(with_tables("""SELECT t.symbol, p.token_address, CAST(p.price_date AS VARCHAR) AS price_date, round(p.usd_price, 6) AS usd_price, p.source
FROM prices p JOIN tokens t ON t.asset_address = p.token_address WHERE p.price_date = (SELECT max(price_date) FROM prices)""",
    "prices", "tokens"))
def latest_prices(t: Tables):
    return prices.latest_prices(t.prices(), t.tokens()).select(
        "symbol", "token_address", day("price_date"), *r6("usd_price"), "source")


@query(with_tables("""SELECT t.symbol, CAST(min(p.price_date) AS VARCHAR) AS earliest, CAST(max(p.price_date) AS VARCHAR) AS latest,
  count(*) AS days FROM tokens t LEFT JOIN prices p ON t.asset_address = p.token_address GROUP BY 1""", "prices", "tokens"))
def price_coverage(t: Tables):
    return prices.price_coverage(t.tokens(), t.prices()).select("symbol", day("earliest"), day("latest"), "days")


@query(with_tables("""SELECT CAST(price_date AS VARCHAR) AS price_date, round(usd_price, 6) AS lp_token_price, source FROM prices
WHERE token_address = 'A5' ORDER BY price_date DESC LIMIT 10 OFFSET 3""", "prices"))
def lp_price_page(t: Tables):
    return prices.lp_price_page(t.prices(), "A5", 10, 3).select(day("price_date"), *r6("lp_token_price"), "source")


# --- builders -----------------------------------------------------------------

def _rows(df):
    return df.select("token_address", day("price_date"), *r6("usd_price"), "source")


def _series_payload(t: Tables):
    """Market series JSON of 500 points each, written from all events."""
    ev = t.ev().withColumn("ms", F.unix_millis(F.col("ts").cast("timestamp")))
    return ev.groupBy(F.floor(F.col("event_id") / 500).alias("g")).agg(F.collect_list(F.array(
        F.col("ms").cast("double"), F.col("cents") / 100.0)).alias("prices")).select(F.to_json(F.struct("prices")).alias("j"))


@query(with_tables("""SELECT 'A9' AS token_address, CAST(day AS VARCHAR) AS price_date,
  round(arg_max(cents / 100.0::DOUBLE, event_id), 6) AS usd_price, 'coingecko' AS source
FROM ev WHERE CAST(day AS VARCHAR) NOT IN (SELECT CAST(price_date AS VARCHAR) FROM day_prices WHERE token_address = 'A9')
GROUP BY day""".replace("token_address = 'A9')", "token_address = 'A9' AND usd_price > 500)"), "ev", "day_prices"))
def price_from_series(t: Tables):
    payload = _series_payload(t).select(F.from_json("j", "prices array<array<double>>").alias("p")).select("p.prices")
    existing = t.day_prices().filter(F.col("usd_price") > 500)
    return _rows(prices.from_series(files.series_points(payload), "A9", existing))


@query(with_tables("""SELECT asset_address AS token_address, CAST(CAST(d AS DATE) AS VARCHAR) AS price_date, 1.0::DOUBLE AS usd_price, 'pegged' AS source
FROM tokens, generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-31', INTERVAL 1 DAY) s(d) WHERE pegged_currency = 'USD'""", "tokens"))
def price_pegged_usd(t: Tables):
    return _rows(prices.pegged_usd_days(t.tokens(), "2024-01-01", "2024-01-31"))


@query(with_tables("""SELECT t.asset_address AS token_address, price_date, round(1.0::DOUBLE / p, 6) AS usd_price, 'pegged' AS source
FROM tokens t JOIN (SELECT CASE event_type WHEN 'view' THEN 'EUR' ELSE 'GBP' END AS currency, CAST(day AS VARCHAR) AS price_date,
                      arg_max(cents / 100.0::DOUBLE, event_id) AS p FROM ev WHERE event_type IN ('view', 'click') AND cents > 0 GROUP BY 1, 2) d
ON upper(t.pegged_currency) = d.currency""", "tokens", "ev"))
def price_pegged_fx(t: Tables):
    kind = F.col("event_type")
    fx = t.ev().filter(kind.isin("view", "click")).select(
        F.when(kind == "view", "EUR").otherwise("GBP").alias("currency"), F.col("ts").alias("at"),
        F.to_date("ts").alias("price_date"), (F.col("cents") / 100.0).alias("price"))
    return _rows(prices.pegged_fx_days(t.tokens(), fx))


@query(with_tables("""SELECT 'BOND' AS token_address, CAST(day AS VARCHAR) AS price_date,
  round(arg_max(cents / 100.0::DOUBLE / (k + 1), event_id), 6) AS usd_price, 'etherfuse' AS source
FROM ev WHERE day >= DATE '2024-01-04' AND day <= DATE '2024-01-25' GROUP BY day""", "ev"))
def price_from_bond_history(t: Tables):
    points = t.ev().select(F.col("event_id").alias("position"), F.to_date("ts").alias("price_date"),
                           (F.col("cents") / 100.0).alias("token_price"), (F.col("k") + 1).cast("double").alias("fx_rate"))
    return _rows(prices.from_bond_history(points, "BOND", "2024-01-04", "2024-01-25"))


@query(with_tables("""SELECT 'RWD' AS token_address, CAST(day AS VARCHAR) AS price_date,
  round((sum(cents) / 0.2::DOUBLE) / ((sum(cents) * 3 + sum(k)) / 0.8::DOUBLE), 6) AS usd_price, 'sdk_backstop' AS source FROM ev GROUP BY day""", "ev"))
def price_from_pool_ratio(t: Tables):
    daily = t.ev().groupBy(F.to_date("ts").alias("price_date")).agg(
        F.sum("cents").alias("quote"), (F.sum("cents") * 3 + F.sum("k")).alias("base"))
    return _rows(prices.from_pool_ratio(daily, "RWD"))


_FX_SQL = """SELECT CASE event_type WHEN 'view' THEN 'USD' ELSE upper(event_type) END AS currency, sum(cents) / 100.0::DOUBLE AS v,
  CASE event_type WHEN 'error' THEN 'crypto' ELSE 'fiat' END AS type FROM ev GROUP BY ALL"""


@query(with_tables(f"""SELECT currency, round(CASE WHEN currency = 'USD' THEN 1.0 ELSE (SELECT v FROM fx WHERE currency = 'USD') / v END, 6) AS usd_value
FROM fx WHERE type = 'fiat'""", "ev", more=f"fx AS ({_FX_SQL})"))
def usd_cross_rates(t: Tables):
    kind = F.col("event_type")
    fx = t.ev().groupBy("event_type").agg((F.sum("cents") / 100.0).alias("value")).select(
        F.when(kind == "view", "USD").otherwise(F.upper(kind)).alias("currency"), "value",
        F.when(kind == "error", "crypto").otherwise("fiat").alias("type"))
    return prices.usd_rates(fx).select("currency", *r6("usd_value"))


@query(with_tables("""SELECT asset_id AS token_address, '2024-02-01' AS price_date, round(oracle_price, 6) AS usd_price, 'sdk_oracle' AS source
FROM (SELECT * FROM reserve_state QUALIFY row_number() OVER (PARTITION BY asset_id ORDER BY pool_id DESC) = 1)
WHERE oracle_price > 0 AND asset_id NOT IN (SELECT asset_address FROM tokens WHERE pegged_currency IS NOT NULL)""", "reserve_state", "tokens"))
def oracle_price_capture(t: Tables):
    order = t.pools().select("pool_id", (-F.substring("pool_id", 2, 9).cast("int")).alias("pool_rank"))
    return _rows(prices.oracle_prices(t.reserve_state(), order, t.tokens(), "2024-02-01"))


@query(with_tables("""SELECT CAST(e.day AS VARCHAR) AS price_date, e.asset_address, count(*) AS n, round(max(a.usd_price), 6) AS asset_price,
  round(max(r.usd_price), 6) AS reward_price
FROM ev e LEFT JOIN day_prices a ON a.price_date = e.day AND a.token_address = e.asset_address
LEFT JOIN day_prices r ON r.price_date = e.day AND r.token_address = 'RWD' GROUP BY 1, 2""", "ev", "day_prices"))
def double_price_lookup(t: Tables):
    p = t.day_prices()
    own = p.select("price_date", F.col("token_address").alias("asset_address"), F.col("usd_price").alias("a"))
    reward = p.filter(F.col("token_address") == "RWD").select("price_date", F.col("usd_price").alias("r"))
    rows = t.ev().withColumn("price_date", F.to_date("ts")).groupBy("price_date", "asset_address").agg(F.count("*").alias("n"))
    out = rows.join(own, ["price_date", "asset_address"], "left").join(reward, "price_date", "left")
    return out.select(day("price_date"), "asset_address", "n", F.round("a", 6).alias("asset_price"),
                      F.round("r", 6).alias("reward_price"))


# --- yields -------------------------------------------------------------------

def _apy(df):
    return df.select(day("rate_date"), "apy_type", "pool_address", "asset_address", F.col("eps").cast("bigint").alias("eps"),
                     *r6("total_supply", "reward_price_usd", "asset_price_usd", "emissions_per_year_per_token", "emission_apy"),
                     "source")


_PER = "(eps / 1e14::DOUBLE * 31536000 / ({s}))"


@query(with_tables(f"""
SELECT CAST(d AS VARCHAR) AS rate_date, 'backstop' AS apy_type, pool_address, NULL::VARCHAR AS asset_address, eps,
       CAST(total AS DOUBLE) AS total_supply, round(r.usd_price, 6) AS reward_price_usd, round(l.usd_price, 6) AS asset_price_usd,
       round({_PER.format(s="total / 1e7::DOUBLE")}, 6) AS emissions_per_year_per_token,
       CASE WHEN l.usd_price > 0 THEN round({_PER.format(s="total / 1e7::DOUBLE")} * r.usd_price / l.usd_price * 100, 6) END AS emission_apy,
       'backstop_events' AS source
FROM (SELECT d, pool_address, eps, (
        SELECT sum(CASE action_type WHEN 'deposit' THEN lp_tokens WHEN 'donate' THEN lp_tokens WHEN 'withdraw' THEN -lp_tokens ELSE 0 END)
        FROM backstop b WHERE b.pool_address = c.pool_address AND CAST(b.ledger_closed_at AS DATE) <= g.d) AS total
      FROM (SELECT CAST(x AS DATE) AS d FROM generate_series(TIMESTAMP '2024-01-05', TIMESTAMP '2024-02-03', INTERVAL 1 DAY) s(x)) g,
           (SELECT pool_address, eps FROM configs WHERE config_type = 'backstop') c) t
LEFT JOIN day_prices r ON r.price_date = d AND r.token_address = 'RWD'
LEFT JOIN day_prices l ON l.price_date = d AND l.token_address = 'LP' WHERE total > 0""", "backstop", "configs", "day_prices"))
def emission_apy_backstop(t: Tables):
    return _apy(yields.backstop_apy(t.backstop(), t.emission_configs(), t.day_prices(), "RWD", "LP", "2024-02-03", "2024-01-05"))


def _lending_sql(side: str, supply: str) -> str:
    return with_tables(f"""
SELECT CAST(s.snapshot_date AS VARCHAR) AS rate_date, 'lending_{side}' AS apy_type, s.pool_id AS pool_address, s.asset_address, c.eps,
       {supply} AS total_supply, round(r.usd_price, 6) AS reward_price_usd, round(a.usd_price, 6) AS asset_price_usd,
       round({_PER.format(s=supply)}, 6) AS emissions_per_year_per_token,
       CASE WHEN a.usd_price > 0 THEN round({_PER.format(s=supply)} * r.usd_price / a.usd_price * 100, 6) END AS emission_apy, 'bigquery' AS source
FROM snapshots s JOIN configs c ON c.pool_address = s.pool_id AND c.asset_address = s.asset_address AND c.config_type = 'lending_{side}'
  AND (c.expiration IS NULL OR epoch(CAST(s.snapshot_date AS TIMESTAMP)) < c.expiration)
LEFT JOIN day_prices r ON r.price_date = s.snapshot_date AND r.token_address = 'RWD'
LEFT JOIN day_prices a ON a.price_date = s.snapshot_date AND a.token_address = s.asset_address
WHERE {supply} > 0 AND s.snapshot_date >= DATE '2024-01-03'""", "snapshots", "configs", "day_prices")


@query(_lending_sql("supply", "b_supply"))
def emission_apy_lending_supply(t: Tables):
    return _apy(yields.lending_apy(t.snapshots(), t.emission_configs(), t.day_prices(), "RWD", "supply", "2024-01-03"))


@query(_lending_sql("borrow", "d_supply"))
def emission_apy_lending_borrow(t: Tables):
    return _apy(yields.lending_apy(t.snapshots(), t.emission_configs(), t.day_prices(), "RWD", "borrow", "2024-01-03"))


@query(with_tables(f"""
SELECT '2024-01-20' AS rate_date, apy_type, x.pool_id AS pool_address, x.asset AS asset_address, eps, s AS total_supply,
       round(r.usd_price, 6) AS reward_price_usd, round(a.usd_price, 6) AS asset_price_usd,
       round(CASE WHEN toks > 0 THEN {_PER.format(s="toks")} ELSE 0 END, 6) AS emissions_per_year_per_token,
       CASE WHEN a.usd_price > 0 THEN round(CASE WHEN toks > 0 THEN {_PER.format(s="toks")} ELSE 0 END * r.usd_price / a.usd_price * 100, 6) END AS emission_apy,
       'sdk' AS source
FROM (SELECT 'backstop' AS apy_type, pool_id, NULL::VARCHAR AS asset, 'LP' AS priced, eps, CAST(tokens AS DOUBLE) AS s, tokens / 1e7::DOUBLE AS toks FROM backstop_state
      UNION ALL SELECT 'lending_supply', pool_id, asset_id, asset_id, supply_eps, total_supply / 1e7::DOUBLE, total_supply / 1e7::DOUBLE FROM reserve_state WHERE supply_eps > 0
      UNION ALL SELECT 'lending_borrow', pool_id, asset_id, asset_id, borrow_eps, total_liabilities / 1e7::DOUBLE, total_liabilities / 1e7::DOUBLE FROM reserve_state WHERE borrow_eps > 0) x
LEFT JOIN (SELECT * FROM day_prices WHERE price_date = DATE '2024-01-20') a ON a.token_address = x.priced
LEFT JOIN (SELECT * FROM day_prices WHERE price_date = DATE '2024-01-20' AND token_address = 'RWD') r ON true""",
    "reserve_state", "backstop_state", "day_prices"))
def emission_apy_today(t: Tables):
    return _apy(yields.todays_apy(t.reserve_state(), t.backstop_state(), t.day_prices(), "RWD", "LP", "2024-01-20"))


_CONFIG_ROWS = """rows_ AS (
  SELECT 'lending_supply' AS config_type, pool_id AS pool_address, asset_id AS asset_address, supply_eps AS eps, CAST(nullif(supply_expiration, 0) AS BIGINT) AS expiration
  FROM reserve_state WHERE supply_eps > 0
  UNION ALL SELECT 'lending_borrow', pool_id, asset_id, borrow_eps, CAST(nullif(borrow_expiration, 0) AS BIGINT) FROM reserve_state WHERE borrow_eps > 0
  UNION ALL SELECT 'backstop', pool_id, NULL, eps, CAST(nullif(expiration, 0) AS BIGINT) FROM backstop_state)"""


@query(with_tables("SELECT config_type, pool_address, asset_address, eps, 14 AS eps_decimals, CAST(expiration AS DOUBLE) AS expiration FROM rows_",
                   "reserve_state", "backstop_state", more=_CONFIG_ROWS))
def emission_configs(t: Tables):
    out = yields.emission_configs(t.reserve_state(), t.backstop_state())
    return out.withColumns({"eps": F.col("eps").cast("bigint"), "expiration": F.col("expiration").cast("double")})


_YEARLY = "sum(CASE WHEN config_type = '{}' THEN eps / 1e14::DOUBLE * 31536000 ELSE 0 END)"


@query(with_tables(f"""SELECT pool_address, round({_YEARLY.format('lending_supply')}, 6) AS supply, round({_YEARLY.format('lending_borrow')}, 6) AS borrow,
  round({_YEARLY.format('backstop')}, 6) AS backstop FROM rows_ GROUP BY 1""", "reserve_state", "backstop_state", more=_CONFIG_ROWS))
def annual_emissions(t: Tables):
    out = yields.annual_emissions(yields.emission_configs(t.reserve_state(), t.backstop_state()))
    return out.select("pool_address", *r6("supply", "borrow", "backstop"))


_KINDS = ("emission_apy_backstop", "emission_apy_lending_supply", "emission_apy_lending_borrow")


@query("""SELECT apy_type, count(*) AS n, round(min(emission_apy), 4) AS min_apy, round(max(emission_apy), 4) AS max_apy,
  round(avg(emission_apy), 4) AS avg_apy FROM (""" + " UNION ALL ".join(f"SELECT * FROM ({ORACLES[k]})" for k in _KINDS) + """) GROUP BY apy_type""")
def apy_summary(t: Tables):
    """All three kinds of yield, rounded as in their own queries."""
    backstop, supply, borrow = emission_apy_backstop(t), emission_apy_lending_supply(t), emission_apy_lending_borrow(t)
    out = yields.apy_summary(backstop.unionByName(supply).unionByName(borrow))
    return out.select("apy_type", "n", *[F.round(c, 4).alias(c) for c in ("min_apy", "max_apy", "avg_apy")])


# --- dimensions ---------------------------------------------------------------

_ASSETS = """assets AS (
  SELECT DISTINCT asset_address FROM actions UNION SELECT token_address FROM prices)"""


@query(with_tables("SELECT asset_address FROM assets", "actions", "prices", more=_ASSETS))
def discovered_assets(t: Tables):
    return refdata.discovered_assets([t.actions(), t.prices().withColumnRenamed("token_address", "asset_address")])


_META = """meta AS (SELECT 'A' || p_partkey AS asset_address, CASE WHEN p_size > 10 THEN 'N' || p_partkey END AS symbol,
  CASE WHEN p_size > 25 THEN p_brand END AS name, CASE WHEN p_size > 40 THEN p_size END AS decimals FROM part)"""


@query(with_tables("""
SELECT a.asset_address, CASE WHEN a.asset_address = 'A0' THEN 'NAT' ELSE coalesce(m.symbol, t.symbol, 'UNKNOWN') END AS symbol,
  CASE WHEN a.asset_address = 'A0' THEN 'Native' ELSE coalesce(m.name, m.symbol, t.name, substr(a.asset_address, 1, 8)) END AS name,
  CASE WHEN a.asset_address = 'A0' THEN 7 ELSE coalesce(m.decimals, 7) END AS decimals, a.asset_address = 'A0' AS is_native
FROM (SELECT asset_address FROM assets UNION SELECT asset_address FROM tokens WHERE pegged_currency IS NOT NULL) a
LEFT JOIN (SELECT m.* FROM meta m SEMI JOIN assets USING (asset_address)) m USING (asset_address)
LEFT JOIN (SELECT * FROM tokens WHERE pegged_currency IS NOT NULL) t USING (asset_address)""",
    "actions", "prices", "tokens", more=f"{_ASSETS}, {_META}"))
def conditional_merge_tokens(t: Tables):
    assets = refdata.discovered_assets([t.actions(), t.prices().withColumnRenamed("token_address", "asset_address")])
    size = F.col("p_size")
    meta = t.raw("part").select(
        _text("A", F.col("p_partkey")).alias("asset_address"), F.when(size > 10, _text("N", F.col("p_partkey"))).alias("symbol"),
        F.when(size > 25, F.col("p_brand")).alias("name"), F.when(size > 40, size).alias("decimals"))
    existing = t.tokens().filter(F.col("pegged_currency").isNotNull()).select(
        "asset_address", "symbol", "name", "decimals", F.lit(False).alias("is_native"))
    # Known tokens that no fact mentions any more keep their row as it is.
    out = refdata.merge_tokens(existing, refdata.token_rows(assets, meta, ("A0", "NAT", "Native")))
    return out


@query(with_tables("""SELECT count(*) FILTER (t.asset_address IS NULL) AS inserted, count(*) FILTER (t.asset_address IS NOT NULL) AS updated
FROM assets a LEFT JOIN (SELECT asset_address FROM tokens WHERE pegged_currency IS NOT NULL) t USING (asset_address)""",
    "actions", "prices", "tokens", more=_ASSETS))
def new_and_known_assets(t: Tables):
    assets = refdata.discovered_assets([t.actions(), t.prices().withColumnRenamed("token_address", "asset_address")])
    return refdata.new_and_known(t.tokens().filter(F.col("pegged_currency").isNotNull()), assets)


@query(with_tables("""SELECT 'P' || n_nationkey AS pool_id, 'Pool with a long name ' || n_name AS name, 'Pool with a long nam' AS short_name,
  CASE WHEN n_regionkey = 2 THEN 'v1' ELSE 'v2' END AS version, CASE WHEN n_regionkey = 1 THEN false ELSE true END AS is_active FROM nation""", "pools"))
def merge_pools(t: Tables):
    tracked = t.raw("nation").select(
        _text("P", F.col("n_nationkey")).alias("pool_id"), F.concat(F.lit("Pool with a long name "), "n_name").alias("name"),
        F.when(F.col("n_regionkey") == 2, "V1").otherwise("V2").alias("version"))
    existing = t.pools().filter(F.col("name") > "NATION_2").unionByName(t.pools().filter(F.col("name") <= "NATION_2").filter(
        ~F.col("is_active")))
    return refdata.merge_pools(existing, tracked).select("pool_id", "name", "short_name", "version", "is_active")


@query("SELECT p_partkey, round(p_retailprice, 2) AS p_retailprice FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT 100")
def preview_rows(t: Tables):
    return page(t.raw("part").select("p_partkey", F.round("p_retailprice", 2).alias("p_retailprice")),
                [F.col("p_retailprice").desc(), F.col("p_partkey")], 100)
