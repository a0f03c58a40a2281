"""Streams and file imports, run to completion over data derived from the tables."""

from pyspark.sql import functions as F

from .. import schemas
from ..functions import iso_z
from ..operators.upsert import upsert
from ..plans import feed, views
from ..session import scratch_path
from ..sources import files, ledger
from ..streaming import events as event_stream
from ..streaming import state as state_stream
from ..streaming.tables import TableStore
from .adapters import Tables
from .explore_queries import day
from .ledger_queries import _BACK, _LENDING, _POS_AMOUNTS, _hash, _LENDING_FIELDS, _BACKSTOP_FIELDS
from .registry import query
from .sqltables import with_tables


def _event_file_stream(t: Tables):
    """The events table as a file stream, its close time as TIMESTAMP."""
    schema = t.raw("events").schema
    stream = t.spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(t.dir)
    return stream.withColumn("ledger_closed_at", F.col("ts").cast("timestamp"))


_COUNTS = schemas._struct(day_start=schemas._TS, action_type=schemas._S, n=schemas._L)


@query("SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, event_type AS action_type, count(*) AS n FROM events GROUP BY 1, 2")
def stream_daily_counts(t: Tables):
    path, checkpoint = scratch_path(t.spark, "counts"), scratch_path(t.spark, "counts-checkpoint")
    counts = event_stream.daily_action_counts(_event_file_stream(t).withColumnRenamed("event_type", "action_type"))

    def handle(batch, batch_id):
        upsert(t.spark, path, batch, _COUNTS, ["day_start", "action_type"], ["n"])

    writer = counts.writeStream.outputMode("update").foreachBatch(handle).option("checkpointLocation", checkpoint)
    writer.trigger(availableNow=True).start().awaitTermination()
    out = t.spark.read.schema(_COUNTS).parquet(path)
    return out.select(F.to_date("day_start").cast("string").alias("day"), "action_type", "n")


def _landed_events(t: Tables) -> str:
    """Both raw event logs as landed Parquet files of the stream's shape."""
    path = scratch_path(t.spark, "landed-events")
    raw = t.raw_lending().unionByName(t.raw_backstop())
    raw.filter(F.col("operation_id").isNotNull()).select(
        F.concat_ws("-", "contract_id", F.col("ledger_sequence").cast("string")).alias("id"), F.lit("contract").alias("type"), "transaction_hash", "ledger_sequence",
        F.col("closed_at").cast("timestamp").alias("ledger_closed_at"), "contract_id", "in_successful_contract_call",
        F.col("topics_decoded").alias("topics"), F.col("data_decoded").alias("data")).write.parquet(path)
    return path


def _run_events(t: Tables) -> TableStore:
    store = TableStore(t.spark, scratch_path(t.spark, "stream-tables"))
    stream = ledger.stream_events(t.spark, _landed_events(t))
    pools = [r.pool_id for r in t.pools().filter("name <= 'NATION_4'").select("pool_id").collect()]
    event_stream.run_event_stream(stream, store, scratch_path(t.spark, "checkpoint"), pools, "BACKSTOP",
                                  available_now=True).awaitTermination()
    return store


@query(with_tables(f"""SELECT {_hash(*_LENDING_FIELDS)} AS id, CAST(CAST(ts AS DATE) AS VARCHAR) AS event_date, a AS action_type,
  CAST(under AS DOUBLE) AS amount_underlying, 'gs' AS src FROM lend WHERE pool_id IN (SELECT pool_id FROM pools WHERE name <= 'NATION_4')""",
    "ev", "pools", more=_LENDING))
def stream_lending_events(t: Tables):
    out = _run_events(t).read("parsed_events")
    return out.select("id", day("event_date"), "action_type", F.col("amount_underlying").cast("double").alias("amount_underlying"), "src")


@query(with_tables(f"""SELECT {_hash(*_BACKSTOP_FIELDS)} AS id, a AS action_type, pool AS pool_address, CAST(lp AS DOUBLE) AS lp_tokens, CAST(exp AS DOUBLE) AS q4w_exp FROM back""",
    "ev", more=_BACK))
def stream_backstop_events(t: Tables):
    out = _run_events(t).read("backstop_events")
    return out.select("id", "action_type", "pool_address", *[F.col(c).cast("double").alias(c) for c in ("lp_tokens", "q4w_exp")])


def _run_derived(t: Tables) -> TableStore:
    """Both event tables, the feed and the views' partials, kept over several micro-batches."""
    store = TableStore(t.spark, scratch_path(t.spark, "derived-tables"), derived=True)
    stream = ledger.stream_events(t.spark, _landed_events(t), max_files=12)
    pools = [r.pool_id for r in t.pools().select("pool_id").collect()]
    event_stream.run_event_stream(stream, store, scratch_path(t.spark, "checkpoint"), pools, "BACKSTOP",
                                  available_now=True).awaitTermination()
    return store


@query(with_tables(f"""SELECT * FROM (SELECT id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS time, action_type, source, user_address, amount, asset_address, ledger_sequence
  FROM (WITH {_LENDING} SELECT {_hash(*_LENDING_FIELDS)} AS id, ts, a AS action_type, 'pool' AS source, u_addr AS user_address,
    CAST(under AS DOUBLE) AS amount, asset AS asset_address, event_id AS ledger_sequence FROM lend WHERE pool_id = 'P1') ORDER BY ts DESC, id LIMIT 50)
UNION ALL SELECT * FROM (SELECT id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ'), action_type, source, user_address, amount, NULL, ledger_sequence
  FROM (WITH {_BACK} SELECT {_hash(*_BACKSTOP_FIELDS)} AS id, ts, a AS action_type, 'backstop' AS source, u_addr AS user_address,
    CAST(lp AS DOUBLE) AS amount, event_id AS ledger_sequence FROM back WHERE pool = 'P1') ORDER BY ts DESC, id LIMIT 50)""", "ev"))
def stream_live_feed(t: Tables):
    out = feed.feed_of_pool(_run_derived(t).read("live_feed"), "P1", 50)
    return out.drop("transaction_hash").withColumns({"time": iso_z(F.col("time")), "amount": F.col("amount").cast("double")})


@query(with_tables("""SELECT u_addr AS user_address, pool_id, asset AS asset_address,
  CAST(sum(CASE a WHEN 'supply' THEN coalesce(toks, 0) WHEN 'withdraw' THEN -coalesce(toks, 0) ELSE 0 END) AS BIGINT) AS supply_btokens,
  CAST(sum(CASE a WHEN 'supply_collateral' THEN coalesce(toks, 0) WHEN 'withdraw_collateral' THEN -coalesce(toks, 0) ELSE 0 END) AS BIGINT) AS collateral_btokens,
  CAST(sum(CASE a WHEN 'borrow' THEN coalesce(toks, 0) WHEN 'repay' THEN -coalesce(toks, 0) ELSE 0 END) AS BIGINT) AS debt_dtokens,
  count(*) AS action_count, strftime(max(ts), '%Y-%m-%dT%H:%M:%SZ') AS last_action_time
FROM lend WHERE NOT a IN ('claim', 'new_auction', 'fill_auction') GROUP BY 1, 2, 3""", "ev", more=_LENDING))
def stream_view_positions(t: Tables):
    out = views.user_positions_from_partials(_run_derived(t).read("positions_by_day"))
    return out.withColumns({**{c: F.col(c).cast("bigint") for c in ("supply_btokens", "collateral_btokens", "debt_dtokens")},
                            "last_action_time": iso_z(F.col("last_action_time"))})


@query(with_tables("""SELECT u_addr AS user_address, CAST(sum(under) AS BIGINT) AS total_claimed, count(*) AS claim_count,
  strftime(min(ts), '%Y-%m-%dT%H:%M:%SZ') AS first_claim, strftime(max(ts), '%Y-%m-%dT%H:%M:%SZ') AS last_claim
FROM lend WHERE a = 'claim' GROUP BY 1""", "ev", more=_LENDING))
def stream_view_claims(t: Tables):
    out = views.user_total_claims_from_partials(_run_derived(t).read("claims_by_day"))
    return out.withColumns({"total_claimed": F.col("total_claimed").cast("bigint"),
                            "first_claim": iso_z(F.col("first_claim")), "last_claim": iso_z(F.col("last_claim"))})


@query("SELECT event_id FROM events")
def stream_dedup(t: Tables):
    """The events landed twice; each id passes once."""
    landed, out, checkpoint = (scratch_path(t.spark, n) for n in ("landed-twice", "deduplicated", "dedup-checkpoint"))
    ev = t.raw("events").select(F.col("event_id").cast("string").alias("id"), "event_id",
                                F.col("ts").cast("timestamp").alias("ledger_closed_at"))
    ev.unionByName(ev).write.parquet(landed)
    stream = event_stream.deduplicated(t.spark.readStream.schema(t.spark.read.parquet(landed).schema).parquet(landed), lateness="60 days")
    (stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
     .trigger(availableNow=True).start().awaitTermination())
    return t.spark.read.parquet(out).select("event_id")


def _run_state(t: Tables) -> TableStore:
    """The pools' state log as JSON payloads of a bounded number of entries each."""
    landed, store = scratch_path(t.spark, "landed-state"), TableStore(t.spark, scratch_path(t.spark, "state-tables"))
    entry = F.struct(
        "ledger_sequence", iso_z(F.col("closed_at")).alias("closed_at"), "contract_id",
        F.col("ledger_key_hash_base_64").alias("ledger_key_hash"), F.col("ledger_entry_change").cast("int").alias("ledger_entry_change"),
        "deleted", "key_decoded", "val_decoded")
    payloads = t.state().groupBy(F.floor(F.col("ledger_sequence") / 200).alias("g")).agg(F.collect_list(entry).alias("events"))
    payloads.select("events", F.lit("2024-02-01T00:00:00Z").alias("timestamp"), F.lit("pubnet").alias("network")).write.json(landed)
    stream = ledger.stream_state_batches(t.spark, landed)
    state_stream.run_state_stream(stream, store, scratch_path(t.spark, "state-checkpoint"), available_now=True).awaitTermination()
    return store


_STREAM_SNAPSHOTS = """snaps AS (
  SELECT pool_id, asset_address, day, max(event_id) AS event_id, arg_max(b_rate, event_id) AS b_rate, arg_max(d_rate, event_id) AS d_rate,
         arg_max(cents, event_id) * 1000 / 1e7::DOUBLE AS b_supply FROM reserves GROUP BY 1, 2, 3)"""
_STREAM_MAPPING = """live AS (
  SELECT pool_id, idx AS reserve_index, 'R' || pool_id || '_' || idx AS asset_address FROM ev WHERE event_type = 'error' GROUP BY ALL
  HAVING max(CASE WHEN event_id % 17 <> 0 THEN event_id END) > coalesce(max(CASE WHEN event_id % 17 = 0 THEN event_id END), -1))"""


@query(with_tables("""SELECT pool_id, asset_address, CAST(day AS VARCHAR) AS snapshot_date, event_id AS ledger_sequence, round(b_rate, 9) AS b_rate,
  round(d_rate, 9) AS d_rate, round(b_supply, 7) AS b_supply FROM snaps""", "reserves", more=_STREAM_SNAPSHOTS))
def stream_pool_snapshots(t: Tables):
    out = _run_state(t).read("pool_snapshots")
    return out.select("pool_id", "asset_address", day("snapshot_date"), "ledger_sequence",
                      *[F.round(F.col(c).cast("double"), 9).alias(c) for c in ("b_rate", "d_rate")],
                      F.round(F.col("b_supply").cast("double"), 7).alias("b_supply"))


@query(with_tables(f"""SELECT h.pool_id, h.user_address, h.asset_address, h.event_id AS ledger_sequence, {_POS_AMOUNTS},
  round(r.b_rate, 9) AS b_rate, round(r.d_rate, 9) AS d_rate
FROM (SELECT * FROM held JOIN live USING (pool_id, reserve_index)) h
ASOF LEFT JOIN snaps r ON h.pool_id = r.pool_id AND h.asset_address = r.asset_address AND h.event_id >= r.event_id""",
    "held_by_key", "reserves", more=f"{_STREAM_SNAPSHOTS}, {_STREAM_MAPPING}"))
def stream_user_positions(t: Tables):
    out = _run_state(t).read("user_positions")
    return out.select("pool_id", "user_address", "asset_address", "ledger_sequence", *[
        F.round(F.col(c).cast("double"), 7).alias(c) for c in ("supply_btokens", "collateral_btokens", "liabilities_dtokens")],
        *[F.round(F.col(c).cast("double"), 9).alias(c) for c in ("b_rate", "d_rate")])


@query(with_tables("""SELECT id, pool_id, ledger_sequence, action_type, strftime(ledger_closed_at, '%Y-%m-%dT%H:%M:%SZ') AS ledger_closed_at, amount_underlying, 'csv' AS src FROM actions""", "actions"))
def csv_import_actions(t: Tables):
    """Action rows written as CSV and read back through the importer."""
    path = scratch_path(t.spark, "csv")
    t.actions().select(
        F.col("id").alias(" ID "), F.col("pool_id").alias("Pool_Id"), "ledger_sequence", "action_type",
        F.col("ledger_closed_at").cast("string").alias("ledger_closed_at"), "amount_underlying").write.option("header", True).csv(path)
    valid, _ = files.read_csv_actions(t.spark, path)
    return valid.select("id", "pool_id", "ledger_sequence", "action_type", iso_z(F.col("ledger_closed_at")).alias("ledger_closed_at"),
                        F.col("amount_underlying").cast("bigint").alias("amount_underlying"), "src")


@query(with_tables("""SELECT 'LP' AS token_address, CAST(day AS VARCHAR) AS price_date, round(max(cents) / 100.0::DOUBLE, 6) AS usd_price FROM ev
WHERE cents > 0 GROUP BY day HAVING max(cents) > 0""", "ev"))
def json_import_prices(t: Tables):
    """Daily prices written as NDJSON and read back through the importer."""
    path = scratch_path(t.spark, "prices") + ".ndjson"
    daily = t.ev().groupBy(F.to_date("ts").alias("d")).agg((F.max("cents") / 100.0).alias("lp_token_price"))
    good = daily.select(F.concat(F.col("d").cast("string"), F.lit("T00:00:00")).alias("price_date"), "lp_token_price")
    bad = daily.select(F.lit("yesterday").alias("price_date"), "lp_token_price").unionByName(
        daily.select(F.col("d").cast("string").alias("price_date"), (-F.col("lp_token_price")).alias("lp_token_price")))
    good.unionByName(bad).write.json(path)
    valid, _ = files.validate_prices(files.read_price_json(t.spark, path), "LP")
    return valid.select("token_address", day("price_date"), F.round("usd_price", 6).alias("usd_price"))
