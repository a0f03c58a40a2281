"""Landed payloads, state feeds and the remaining small operators."""

from pyspark.sql import functions as F

from ..functions import iso_z, parse_day, parse_instant, scaled_amount, scaled_rate
from ..functions.numbers import inverse_rate
from ..operators.upsert import insert_missing, upsert
from ..plans import snapshots, views
from ..session import scratch_path
from ..sources import files, ledger
from .. import schemas
from .adapters import Tables
from .explore_queries import day, r6
from .registry import query
from .sqltables import with_tables
from .stream_queries import _run_state


@query(with_tables("""SELECT upper(event_type) AS currency, pool_id, CAST(sum(cents) AS DOUBLE) AS value, 'fiat' AS type FROM ev GROUP BY ALL""", "ev"))
def exchange_rate_payload(t: Tables):
    """One payload ``{rates: {code: {value, type}}}`` per pool, read back to rows."""
    per = t.ev().groupBy("pool_id", "event_type").agg(F.sum("cents").cast("double").alias("value"))
    entry = F.struct(F.col("event_type"), F.struct("value", F.lit("fiat").alias("type")))
    payload = per.groupBy("pool_id").agg(F.map_from_entries(F.collect_list(entry)).alias("rates"))
    text = payload.select("pool_id", F.to_json(F.struct("rates")).alias("j"))
    parsed = text.select("pool_id", F.from_json("j", schemas.EXCHANGE_RATES)["rates"].alias("rates"))
    rows = parsed.select("pool_id", F.explode("rates").alias("code", "info"))
    return rows.select(F.upper("code").alias("currency"), "pool_id", F.col("info")["value"].alias("value"), F.col("info")["type"].alias("type"))


@query(with_tables("""SELECT CAST(day AS VARCHAR) AS price_date, round(cents / 100.0::DOUBLE, 6) AS token_price, CAST(k + 1 AS DOUBLE) AS fx_rate, count(*) AS n
FROM ev GROUP BY ALL""", "ev"))
def bond_history_payload(t: Tables):
    """Bond history payloads of 500 events each, as JSON lines, read back to points."""
    path = scratch_path(t.spark, "bond")
    point = F.struct(iso_z(F.col("ts")).alias("date"), (F.col("cents") / 100.0).cast("string").alias("tokenPrice"),
                     (F.col("k") + 1).cast("string").alias("usdExchangeRate"), F.lit("ok").alias("statusType"))
    t.ev().groupBy(F.floor(F.col("event_id") / 500).alias("g")).agg(F.collect_list(point).alias("historyRange")).select(
        "historyRange").write.json(path)
    points = files.bond_points(t.spark.read.schema(schemas.BOND_HISTORY).json(path))
    return points.groupBy(day("price_date"), F.round("token_price", 6).alias("token_price"), "fx_rate").agg(F.count("*").alias("n"))


@query(with_tables("""SELECT id, pool_address, ledger_sequence, action_type, CAST(lp_tokens AS DOUBLE) AS lp_tokens, 'csv' AS src FROM backstop""", "backstop"))
def csv_import_backstop(t: Tables):
    path = scratch_path(t.spark, "csv-backstop")
    t.backstop().select("id", F.col("pool_address").alias("POOL_ADDRESS"), "ledger_sequence", "action_type",
                        F.col("ledger_closed_at").cast("string").alias("ledger_closed_at"), "lp_tokens").write.option("header", True).csv(path)
    valid, _ = files.read_csv_backstop(t.spark, path)
    return valid.select("id", "pool_address", "ledger_sequence", "action_type", F.col("lp_tokens").cast("double").alias("lp_tokens"), "src")


@query(with_tables("""SELECT pool_id, asset_address, max(event_id) AS ledger_sequence, round((arg_max(cents, event_id) * 1000000 + 1000000000000) / 1e12::DOUBLE, 9) AS b_rate,
  CAST(arg_max(cents, event_id) AS DOUBLE) AS b_supply, CAST(arg_max(k, event_id) AS DOUBLE) AS d_supply, '2024-02-01' AS snapshot_date FROM ev GROUP BY 1, 2""", "ev"))
def snapshots_from_state_feed(t: Tables):
    out = snapshots.snapshots_from_state(t.reserve_state(), "2024-02-01", "2024-02-01 06:00:00")
    return out.select("pool_id", "asset_address", "ledger_sequence", F.round(F.col("b_rate").cast("double"), 9).alias("b_rate"),
                      *[F.col(c).cast("double").alias(c) for c in ("b_supply", "d_supply")], day("snapshot_date"))


@query(with_tables("""SELECT pool_id AS pool_address, shares, tokens, q4w, round(q4w * 100.0::DOUBLE / shares, 4) AS q4w_pct, 'sdk' AS src FROM backstop_state""", "backstop_state"))
def balances_from_state_feed(t: Tables):
    out = snapshots.balances_from_state(t.backstop_state(), "2024-02-01", "2024-02-01 06:00:00")
    return out.select("pool_address", *[F.col(c).cast("bigint").alias(c) for c in ("shares", "tokens", "q4w")], "q4w_pct", "src")


@query(with_tables("SELECT pool_id, CAST(rn - 1 AS BIGINT) AS reserve_index, asset_address FROM (SELECT pool_id, asset_address, row_number() OVER (PARTITION BY pool_id ORDER BY asset_address) AS rn FROM (SELECT DISTINCT pool_id, asset_address FROM ev))", "ev"))
def discovery_pairs(t: Tables):
    pools = t.ev().groupBy("pool_id").agg(F.sort_array(F.collect_set("asset_address")).alias("assets"))
    return ledger.flatten_discovery(pools).withColumn("reserve_index", F.col("reserve_index").cast("bigint"))


@query(with_tables("SELECT event_id FROM ev WHERE pool_id IN (SELECT pool_id FROM pools WHERE is_active)", "ev", "pools"))
def tracked_pool_rows(t: Tables):
    ev = t.ev().withColumnRenamed("pool_id", "contract_id")
    return ledger.tracked(ev, t.pools().filter("is_active")).select("event_id")


@query(with_tables("""SELECT event_id, CASE WHEN k % 4 <> 0 THEN cents / 1e7::DOUBLE ELSE 0 END AS amount, CASE WHEN k % 4 <> 0 THEN cents / 1e12::DOUBLE END AS rate,
  CASE WHEN k % 4 <> 0 THEN cents / 1e12::DOUBLE ELSE 0 END AS feed_rate, CASE WHEN cents > 0 THEN round(1.0::DOUBLE / cents, 9) END AS inverse FROM ev""", "ev"))
def fixed_point_scaling(t: Tables):
    raw = F.when(F.col("k") % 4 != 0, F.col("cents").cast("string"))
    return t.ev().select(
        "event_id", scaled_amount(raw).cast("double").alias("amount"), scaled_rate(raw).cast("double").alias("rate"),
        scaled_rate(raw, null_as_zero=True).cast("double").alias("feed_rate"), F.round(inverse_rate(F.col("cents")), 9).alias("inverse"))


@query("""SELECT event_id, strftime(date_trunc('second', ts), '%Y-%m-%dT%H:%M:%SZ') AS at, CAST(CAST(ts AS DATE) AS VARCHAR) AS day FROM events""")
def normalised_times(t: Tables):
    """Close times given as epoch seconds, epoch milliseconds, ISO or SQL text."""
    ts, e = F.col("ts").cast("timestamp"), F.col("event_id")
    text = (F.when(e % 4 == 0, F.unix_seconds(ts).cast("string")).when(e % 4 == 1, F.unix_millis(ts).cast("string"))
            .when(e % 4 == 2, iso_z(ts)).otherwise(F.col("ts").cast("string")))
    return t.raw("events").select("event_id", iso_z(parse_instant(text)).alias("at"), parse_day(F.col("ts")).cast("string").alias("day"))


@query(with_tables("SELECT id, ledger_sequence, action_type FROM actions WHERE user_address = 'U3' ORDER BY ledger_sequence DESC, id LIMIT 50", "actions"))
def user_action_log(t: Tables):
    return views.user_action_log(t.actions(), "U3").select("id", "ledger_sequence", "action_type")


_PRICE = schemas.DAILY_TOKEN_PRICES


@query(with_tables("""SELECT token_address, CAST(price_date AS VARCHAR) AS price_date, round(CASE WHEN source = 'R' THEN usd_price ELSE usd_price * 2 END, 6) AS usd_price FROM prices""", "prices"))
def insert_missing_prices(t: Tables):
    """Prices stored first, then all days offered again at twice the price: stored days stay."""
    path, keys = scratch_path(t.spark, "prices"), ["token_address", "price_date"]
    p = t.prices()
    upsert(t.spark, path, p.filter(F.col("source") == "R"), _PRICE, keys, ["usd_price"])
    insert_missing(t.spark, path, p.withColumn("usd_price", F.col("usd_price") * 2), _PRICE, keys, ["usd_price"])
    return t.spark.read.schema(_PRICE).parquet(path).select("token_address", day("price_date"), *r6("usd_price"))


@query(with_tables("""SELECT count(*) AS events_received, count(*) FILTER (event_type = 'error') AS configs_processed,
  count(*) FILTER (event_type = 'view') AS pools_processed, count(*) FILTER (event_type IN ('signup', 'click', 'purchase')) AS positions_processed FROM ev""", "ev"))
def stream_state_metrics(t: Tables):
    m = _run_state(t).read_batches("state_metrics")
    return m.agg(*[F.sum(c).alias(c) for c in ("events_received", "configs_processed", "pools_processed", "positions_processed")])


@query(with_tables("""SELECT 'no asset mapping for reserve index ' || reserve_index AS reject_reason, pool_id, count(*) AS n
FROM held h WHERE NOT EXISTS (SELECT 1 FROM live l WHERE l.pool_id = h.pool_id AND l.reserve_index = h.reserve_index) GROUP BY ALL""",
    "held_by_key", more="""live AS (SELECT pool_id, idx AS reserve_index FROM ev WHERE event_type = 'error' GROUP BY ALL
  HAVING max(CASE WHEN event_id % 17 <> 0 THEN event_id END) > coalesce(max(CASE WHEN event_id % 17 = 0 THEN event_id END), -1))"""))
def stream_state_rejects(t: Tables):
    return _run_state(t).read_batches("state_rejects").groupBy("reject_reason", "pool_id").agg(F.count("*").alias("n"))
