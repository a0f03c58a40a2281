"""Backfill jobs, each run over the first half of January and then resumed, and their tables read back."""

from pyspark.sql import functions as F

from ..constants import SRC_BACKFILL, SRC_STREAM
from ..operators.coverage import gaps
from ..plans import events, jobs, prices, snapshots, yields
from ..session import scratch_path
from ..streaming.tables import TableStore
from .adapters import Tables
from .explore_queries import day, r6
from .ledger_queries import _BACK, _LENDING, _POS_AMOUNTS, _position_columns, _rates
from .price_queries import _apy
from .registry import ORACLES, query
from .sqltables import with_tables

_FIRST, _HALF = "2024-01-01", "2024-01-15"


def _store(t: Tables) -> TableStore:
    return TableStore(t.spark, scratch_path(t.spark, "jobs"))


def _resumed(job, store: TableStore, *args, **options) -> TableStore:
    """The job over the first half, then from where it stopped; a third run must find nothing new."""
    job(store, *args, start_date=_FIRST, end_date=_HALF, **options)
    job(store, *args, resume=True, **options)
    again = job(store, *args, resume=True, **options)
    if again["inserted"]:
        raise ValueError(f"a repeated backfill inserted rows: {again}")
    return store


def _integers(*columns: str):
    return [F.col(c).cast("bigint").alias(c) for c in columns]


_STREAMED = "event_id % 2 = 0 AND a = '{}'"


@query(with_tables(f"""
SELECT 'T' || event_id AS transaction_hash, event_id AS ledger_sequence, pool_id, a AS action_type, asset AS asset_address,
       under AS amount_underlying, toks AS amount_tokens, CASE WHEN {_STREAMED.format('borrow')} THEN '{SRC_STREAM}' ELSE '{SRC_BACKFILL}' END AS src
FROM lend""", "ev", more=_LENDING))
def job_lending_events(t: Tables):
    """Some rows are stored by the stream before; they stay and are not stored twice."""
    store = _store(t)
    # Ledger and action belong to an event's identity, so that what the stream has not seen need not be decoded for it.
    seen = t.raw_lending().filter((F.col("ledger_sequence") % 2 == 0) & (F.col("action_type") == "borrow"))
    streamed, _ = events.typed_actions(events.lending_table(seen), SRC_STREAM)
    store.upsert("parsed_events", streamed.withColumn("id", F.concat(F.lit("stream-"), "id")))
    out = _resumed(jobs.backfill_lending_events, store, t.raw_lending()).read("parsed_events")
    return out.select("transaction_hash", "ledger_sequence", "pool_id", "action_type", "asset_address",
                      *_integers("amount_underlying", "amount_tokens"), "src")


@query(with_tables(f"""
SELECT event_id AS ledger_sequence, a AS action_type, pool AS pool_address, u_addr AS user_address, lp AS lp_tokens, shares,
       exp AS q4w_exp, em AS emissions_amount, CASE WHEN {_STREAMED.format('deposit')} THEN '{SRC_STREAM}' ELSE '{SRC_BACKFILL}' END AS src
FROM back""", "ev", more=_BACK))
def job_backstop_events(t: Tables):
    store = _store(t)
    rows, _ = events.typed_backstop(events.backstop_table(t.raw_backstop(), "BACKSTOP"), SRC_STREAM)
    streamed = rows.filter((F.col("ledger_sequence") % 2 == 0) & (F.col("action_type") == "deposit"))
    store.upsert("backstop_events", streamed.withColumn("id", F.concat(F.lit("stream-"), "id")))
    out = _resumed(jobs.backfill_backstop_events, store, t.raw_backstop(), "BACKSTOP").read("backstop_events")
    return out.select("ledger_sequence", "action_type", "pool_address", "user_address",
                      *_integers("lp_tokens", "shares", "q4w_exp", "emissions_amount"), "src")


@query(with_tables("""
SELECT pool_id, asset_address, CAST(day AS VARCHAR) AS snapshot_date, max(event_id) AS ledger_sequence,
       round(arg_max(b_rate, event_id), 9) AS b_rate, round(arg_max(d_rate, event_id), 9) AS d_rate,
       round(arg_max(cents, event_id) * 1000 / 1e7::DOUBLE, 7) AS b_supply
FROM reserves GROUP BY pool_id, asset_address, day""", "reserves"))
def job_pool_snapshots(t: Tables):
    out = _resumed(jobs.backfill_pool_snapshots, _store(t), t.state(), now="2024-03-01").read("pool_snapshots")
    return out.select("pool_id", "asset_address", day("snapshot_date"), "ledger_sequence", *_rates(),
                      F.round(F.col("b_supply").cast("double"), 7).alias("b_supply"))


@query(with_tables(f"""
SELECT h.pool_id, h.user_address, h.asset_address, h.event_id AS ledger_sequence, CAST(h.day AS VARCHAR) AS snapshot_date,
       {_POS_AMOUNTS}, round(r.b_rate, 9) AS b_rate, round(r.d_rate, 9) AS d_rate
FROM (SELECT * FROM held JOIN mapping USING (pool_id, reserve_index)) h
ASOF LEFT JOIN reserves r ON h.pool_id = r.pool_id AND h.asset_address = r.asset_address AND h.event_id >= r.event_id""",
    "held_by_key", "mapping", "reserves"))
def job_positions(t: Tables):
    """Two overlapping windows that both begin with the log, so that every position finds its rate."""
    store = _store(t)
    jobs.backfill_positions(store, t.state(), start_date=_FIRST, end_date=_HALF)
    jobs.backfill_positions(store, t.state(), start_date=_FIRST)
    return _position_columns(store.read("user_positions"), *_rates())


@query(with_tables("""
SELECT pool_id AS pool_address, CAST(day AS VARCHAR) AS snapshot_date, max(event_id) AS ledger_sequence, arg_max(cents, event_id) AS q4w,
       arg_max(cents * 110, event_id) AS tokens FROM ev GROUP BY pool_id, day""", "ev"))
def job_q4w(t: Tables):
    out = _resumed(jobs.backfill_backstop_balances, _store(t), t.lp_state(), "BACKSTOP").read("backstop_pool_snapshots")
    return out.select("pool_address", day("snapshot_date"), "ledger_sequence", *_integers("q4w", "tokens"))


@query(with_tables("""
SELECT 'LP' AS token_address, CAST(day AS VARCHAR) AS price_date,
       round(arg_max(5.0::DOUBLE * (cents * 7) / (cents * 11 + k + 1), event_id), 6) AS usd_price FROM ev GROUP BY day""", "ev"))
def job_lp_prices(t: Tables):
    out = _resumed(jobs.backfill_lp_prices, _store(t), t.lp_state(), "LP", "LPTOKEN").read("daily_token_prices")
    return out.select("token_address", day("price_date"), *r6("usd_price"))


@query()
def job_emission_apy(t: Tables):
    """All three kinds of yield, written twice."""
    store, given = _store(t), (t.emission_configs(), t.day_prices(), "RWD")
    kinds = [yields.backstop_apy(t.backstop(), *given, "LP", "2024-02-03", "2024-01-05")] + [
        yields.lending_apy(t.snapshots(), *given, side, "2024-01-03") for side in ("supply", "borrow")]
    jobs.write_emission_apy(store, *kinds)
    jobs.write_emission_apy(store, *kinds)
    return _apy(store.read("daily_emission_apy"))


ORACLES["job_emission_apy"] = " UNION ALL ".join(f"SELECT * FROM ({ORACLES[q]})" for q in (
    "emission_apy_backstop", "emission_apy_lending_supply", "emission_apy_lending_borrow"))


# --- resuming, previews and the daily capture ---------------------------------

_LENDING_COUNTS = """SELECT pool_id, CAST(day AS VARCHAR) AS event_date, '{src}' AS src, count(*) AS n, max(event_id) AS last_ledger
FROM lend JOIN ev USING (event_id, pool_id) GROUP BY 1, 2"""


@query(with_tables(_LENDING_COUNTS.format(src=SRC_BACKFILL) + f"""
UNION ALL SELECT 'P1', '2024-06-01', '{SRC_STREAM}', CAST(1 AS BIGINT), CAST(999999999 AS BIGINT)""", "ev", more=_LENDING))
def job_resume_gaps(t: Tables):
    """A hole in the middle, pools that come in late and a streamed row far ahead: a resumed run fills exactly the rest."""
    store, raw = _store(t), t.raw_lending()
    ahead = [("s", "P1", "T", 999999999, "2024-06-01 10:00:00", "borrow", SRC_STREAM)]
    streamed = t.spark.createDataFrame(ahead, "id string, pool_id string, transaction_hash string, ledger_sequence bigint, at string, action_type string, src string")
    store.upsert("parsed_events", streamed.withColumn("ledger_closed_at", F.col("at").cast("timestamp")).drop("at"))
    early, late = ["P0", "P1"], ["P0", "P1", "P2"]
    jobs.backfill_lending_events(store, raw, early, "2024-01-02", "2024-01-08")
    jobs.backfill_lending_events(store, raw, ["P0"], "2024-01-12", "2024-01-15")
    jobs.backfill_lending_events(store, raw, late, resume=True)
    jobs.backfill_lending_events(store, raw, resume=True)  # every pool, those not named so far as well
    again = jobs.backfill_lending_events(store, raw, late, resume=True)
    if again["inserted"]:
        raise ValueError(f"a resumed backfill found rows again: {again}")
    return store.read("parsed_events").groupBy("pool_id", day("event_date"), "src").agg(
        F.count("*").alias("n"), F.max("ledger_sequence").alias("last_ledger"))


@query(with_tables("""
SELECT scope, CAST(min(d) AS VARCHAR) AS first_day, CAST(max(d) AS VARCHAR) AS last_day FROM (
  SELECT scope, d, d - CAST(row_number() OVER (PARTITION BY scope ORDER BY d) AS INTEGER) AS island FROM (
    SELECT u.scope, CAST(g.d AS DATE) AS d FROM (SELECT DISTINCT user_address AS scope FROM ev) u,
      generate_series(TIMESTAMP '2024-01-03', TIMESTAMP '2024-02-10', INTERVAL 1 DAY) g(d)) w
  WHERE NOT EXISTS (SELECT 1 FROM ev e WHERE e.user_address = w.scope AND event_type = 'signup' AND w.d BETWEEN e.day AND e.day + CAST(k % 4 AS INTEGER))
    AND NOT EXISTS (SELECT 1 FROM ev e WHERE event_type = 'error' AND k % 50 = 7 AND w.d = e.day AND event_id % 9 = 0))
GROUP BY scope, island""", "ev"))
def coverage_gaps(t: Tables):
    """Uncovered days of each user; a signup covers up to four days, some errors cover their day for all."""
    ev = t.ev().withColumn("first_day", F.to_date("ts"))
    own = ev.filter(F.col("event_type") == "signup").select(
        F.col("user_address").alias("scope"), "first_day", F.expr("date_add(first_day, CAST(k % 4 AS INT))").alias("last_day"))
    common = ev.filter("event_type = 'error' AND k % 50 = 7 AND event_id % 9 = 0").select(
        F.lit("*").alias("scope"), "first_day", F.col("first_day").alias("last_day"))
    found = gaps(own.unionByName(common), ev.select(F.col("user_address").alias("scope")), "2024-01-03", "2024-02-10")
    return found.select("scope", day("first_day"), day("last_day"))


@query(with_tables("""
SELECT ledger_sequence, op, amount_tokens FROM (
  SELECT event_id AS ledger_sequence, CASE WHEN day < DATE '2024-01-11' THEN 'update' ELSE 'insert' END AS op, toks AS amount_tokens
  FROM lend JOIN ev USING (event_id, pool_id) WHERE day BETWEEN DATE '2024-01-06' AND DATE '2024-01-20'
  UNION ALL
  SELECT CAST(-1 AS BIGINT), 'counts', CAST(count(*) FILTER (day >= DATE '2024-01-11') * 1000000 + count(*) FILTER (day < DATE '2024-01-11') AS BIGINT)
  FROM lend JOIN ev USING (event_id, pool_id) WHERE day BETWEEN DATE '2024-01-06' AND DATE '2024-01-20')""", "ev", more=_LENDING))
def job_preview(t: Tables):
    """What a backfill of two weeks would do to a table that holds the first ten days; the table stays as it is."""
    store, raw = _store(t), t.raw_lending()
    jobs.backfill_lending_events(store, raw, start_date=_FIRST, end_date="2024-01-10")
    before = store.read("parsed_events").count()
    planned = jobs.plan_lending_events(store, raw, start_date="2024-01-06", end_date="2024-01-20")
    counts, rows = jobs.preview(store, planned, limit=10**9)
    if store.read("parsed_events").count() != before or counts["rejected"]:
        raise ValueError(f"a preview wrote or rejected rows: {counts}")
    summary = t.spark.range(1).select(F.lit(-1).cast("bigint").alias("ledger_sequence"), F.lit("counts").alias("op"),
                                      F.lit(counts["inserted"] * 1000000 + counts["updated"]).cast("bigint").alias("amount_tokens"))
    return rows.select("ledger_sequence", "op", *_integers("amount_tokens")).unionByName(summary)


_CAPTURE_DAY = "2024-02-01"


@query(with_tables(f"""
SELECT token_address, '{_CAPTURE_DAY}' AS price_date, round(usd_price, 6) AS usd_price, source FROM (
  SELECT 'LP' AS token_address, 5.0::DOUBLE * (cents * 7) / (cents * 11 + k + 1) AS usd_price, 'sdk_backstop' AS source, 1 AS rank
  FROM (SELECT * FROM ev WHERE day = (SELECT max(day) FROM ev) ORDER BY event_id DESC LIMIT 1)
  UNION ALL SELECT 'RWD', (sum(cents) / 0.2::DOUBLE) / ((sum(cents) * 3 + sum(k)) / 0.8::DOUBLE), 'sdk_backstop', 2
  FROM ev WHERE day = (SELECT max(day) FROM ev)
  UNION ALL SELECT asset_address, CASE WHEN pegged_currency = 'USD' THEN 1.0 ELSE (SELECT v FROM fx WHERE currency = 'USD') / v END, 'pegged', 3
  FROM tokens JOIN fx ON fx.currency = upper(pegged_currency)
  UNION ALL SELECT 'A4', arg_max(cents / 100.0::DOUBLE / (k + 1), event_id), 'etherfuse', 4 FROM ev
  UNION ALL SELECT asset_id, oracle_price, 'sdk_oracle', 5
  FROM (SELECT * FROM reserve_state QUALIFY row_number() OVER (PARTITION BY asset_id ORDER BY pool_id DESC) = 1)
  WHERE oracle_price > 0 AND asset_id NOT IN (SELECT asset_address FROM tokens WHERE pegged_currency IS NOT NULL))
WHERE usd_price > 0 QUALIFY row_number() OVER (PARTITION BY token_address ORDER BY rank DESC) = 1""", "ev", "tokens", "reserve_state", more="""
  fx AS (SELECT CASE event_type WHEN 'view' THEN 'USD' WHEN 'click' THEN 'EUR' ELSE 'GBP' END AS currency, sum(cents) / 100.0::DOUBLE AS v
         FROM ev WHERE event_type IN ('view', 'click', 'purchase') GROUP BY 1)"""))
def job_daily_prices(t: Tables):
    """Five sources in one write. First with two that fail, which leave the others stored, then whole, then once more."""
    store, kind = _store(t), F.col("event_type")
    daily = t.ev().groupBy(F.to_date("ts").alias("price_date")).agg(
        F.sum("cents").alias("quote"), (F.sum("cents") * 3 + F.sum("k")).alias("base"))
    fx = t.ev().filter(kind.isin("view", "click", "purchase")).groupBy(
        F.when(kind == "view", "USD").when(kind == "click", "EUR").otherwise("GBP").alias("currency")).agg(
        (F.sum("cents") / 100.0).alias("value")).withColumn("type", F.lit("fiat"))
    bond = t.ev().select(F.col("event_id").alias("position"), (F.col("cents") / 100.0).alias("token_price"),
                         (F.col("k") + 1).cast("double").alias("fx_rate"))
    order = t.pools().select("pool_id", (-F.substring("pool_id", 2, 9).cast("int")).alias("pool_rank"))
    sources = jobs.price_sources(_CAPTURE_DAY, t.tokens(), snapshots.lp_prices(t.lp_state(), "LPTOKEN"), "LP", daily, "RWD", fx,
                                 bond, "A4", t.reserve_state(), order)

    def unreachable():
        raise ConnectionError("no answer")

    def broken():  # fails only while it is computed
        return prices.oracle_prices(t.reserve_state().withColumn("oracle_price", F.raise_error(F.lit("no oracle")).cast("double")),
                                    order, t.tokens(), _CAPTURE_DAY)

    part = jobs.capture_daily_prices(store, sources | {"bond": unreachable, "oracle": broken})
    if set(part.errors) != {"bond", "oracle"} or set(part.by_source) != {"lp token", "pool ratio", "pegs"}:
        raise ValueError(f"sources were not kept apart: {part}")
    whole, again = (jobs.capture_daily_prices(store, sources) for _ in range(2))
    if whole.errors or again.counts["inserted"]:
        raise ValueError(f"a repeated capture is not the same: {whole}, {again}")
    return store.read("daily_token_prices").select("token_address", day("price_date"), *r6("usd_price"), "source")
