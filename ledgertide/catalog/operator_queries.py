"""The row-set operators on their own, over the whole tables."""

from datetime import datetime

from pyspark.sql import functions as F

from .. import schemas
from ..functions import content_id, iso_z, is_address, is_iso_day
from ..functions.timewindow import date_window, optional_window, preset_window
from ..operators import (
    Rule, action_counts, asof_join, breakdown, day_coverage, dedup_first, dedup_last, duplicate_keys, earliest_per,
    forward_fill, latest_per, missing_rows, running_total, table_stats, upsert, validate, watermark,
)
from ..operators.validate import required
from ..plans import feed, search
from ..session import scratch_path
from ..sources import ledger
from .adapters import Tables, _text
from .explore_queries import day
from .registry import query
from .sqltables import with_tables

_HASHED = "event_id || '-' || substr(sha256(event_type || CAST(user_id AS VARCHAR) || coalesce(props, '')), 1, 16)"


@query(f"SELECT event_id, {_HASHED} AS id FROM events")
def content_hash_id(t: Tables):
    return t.raw("events").select("event_id", content_id("event_id", ["event_type", "user_id", "props"]).alias("id"))


@query(f"SELECT {_HASHED} AS id, 1 AS copy, event_type FROM events")
def dedup_first_by_hash(t: Tables):
    ev = t.raw("events").withColumn("id", content_id("event_id", ["event_type", "user_id", "props"]))
    twice = ev.withColumn("copy", F.lit(1)).unionByName(ev.withColumn("copy", F.lit(2)))
    return dedup_first(twice, ["id"], ["copy"]).select("id", "copy", "event_type")


@query("""SELECT user_id, event_type, max(event_id) AS event_id, arg_max(round(value, 2), event_id) AS value FROM events GROUP BY 1, 2""")
def dedup_last_by_key(t: Tables):
    out = dedup_last(t.raw("events"), ["user_id", "event_type"], ["event_id"])
    return out.select("user_id", "event_type", "event_id", F.round("value", 2).alias("value"))


@query("""SELECT l_orderkey, count(*) AS occurrences FROM lineitem GROUP BY 1 HAVING count(*) > 1 ORDER BY 2 DESC, 1 LIMIT 5""")
def duplicate_report(t: Tables):
    return duplicate_keys(t.raw("lineitem"), "l_orderkey")


@query("SELECT event_id FROM events WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-21'")
def date_window_inclusive(t: Tables):
    return date_window(t.raw("events"), "ts", "2024-01-05", "2024-01-20").select("event_id")


@query("SELECT event_id FROM events WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-21'")
def date_window_lookback(t: Tables):
    return date_window(t.raw("events"), "ts", None, "2024-01-20", days_back=10).select("event_id")


@query("SELECT event_id FROM events WHERE ts < TIMESTAMP '2024-01-21'")
def date_window_end_only(t: Tables):
    return date_window(t.raw("events"), "ts", None, "2024-01-20", lookback_from_end=False).select("event_id")


@query("SELECT event_id FROM events WHERE ts >= TIMESTAMP '2024-01-25 12:00:00'")
def date_window_default(t: Tables):
    return date_window(t.raw("events"), "ts", days_back=5, now=datetime(2024, 1, 30, 12)).select("event_id")


@query("SELECT event_id FROM events WHERE ts >= TIMESTAMP '2023-12-25'")
def date_window_widened(t: Tables):
    return date_window(t.raw("events"), "ts", "2024-01-24", widen_days=30).select("event_id")


@query("SELECT o_orderkey FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1997-01-01'")
def half_open_window(t: Tables):
    return optional_window(t.raw("orders"), "o_orderdate", "1996-01-01", "1997-01-01").select("o_orderkey")


@query("SELECT event_id FROM events WHERE ts >= TIMESTAMP '2024-01-23' AND ts < TIMESTAMP '2024-01-30'")
def preset_range(t: Tables):
    lo, hi = preset_window("7d", now="2024-01-30")
    return optional_window(t.raw("events"), "ts", lo, hi).select("event_id")


@query(with_tables("SELECT event_id AS ledger_sequence, pool_id AS contract_id FROM ev WHERE event_id BETWEEN 300 AND 6000", "ev"))
def ledger_range_inclusive(t: Tables):
    """A range of ledgers of the stored log, which becomes a range of its days."""
    return ledger.scan_events(t.spark, t.log_path("raw_lending"), first_ledger=300, last_ledger=6000).select(
        "ledger_sequence", "contract_id")


@query(with_tables("""SELECT event_id AS ledger_sequence, pool_id AS contract_id, CAST(day AS VARCHAR) AS date FROM ev
WHERE pool_id IN ('P1', 'P3') AND day BETWEEN DATE '2024-01-05' AND DATE '2024-01-12' AND event_id <= 5000""", "ev"))
def state_scan_bounded(t: Tables):
    """Contract, day and ledger bounds of one scan of the state log."""
    rows = ledger.scan_state(t.spark, t.log_path("state"), ["P1", "P3"], "2024-01-05", "2024-01-12", last_ledger=5000)
    return rows.select("ledger_sequence", "contract_id", day("date"))


@query("""SELECT l_orderkey, l_linenumber, measure, round(amount, 2) AS amount FROM (
  SELECT l_orderkey, l_linenumber, l_quantity AS quantity, l_discount AS discount, l_tax AS tax FROM lineitem)
UNPIVOT (amount FOR measure IN (quantity, discount, tax)) WHERE amount <> 0""")
def any_nonzero_unpivot(t: Tables):
    wide = t.raw("lineitem").select("l_orderkey", "l_linenumber", F.col("l_quantity").alias("quantity"),
                                    F.col("l_discount").alias("discount"), F.col("l_tax").alias("tax"))
    long = wide.unpivot(["l_orderkey", "l_linenumber"], ["quantity", "discount", "tax"], "measure", "amount")
    return long.filter(F.coalesce("amount", F.lit(0.0)) != 0).withColumn("amount", F.round("amount", 2))


@query(with_tables("""SELECT user_id, CAST(day AS VARCHAR) AS day, CAST(arg_max_null(CASE WHEN k % 3 <> 0 THEN cents END, event_id) AS DOUBLE) AS cents,
  max(event_id) AS last_id FROM ev GROUP BY 1, day""", "ev"))
def latest_per_day_maxby(t: Tables):
    ev = t.ev().withColumn("d", F.to_date("ts"))
    out = ev.groupBy("user_id", "d").agg(
        F.max_by(F.struct(F.when(F.col("k") % 3 != 0, F.col("cents")).alias("c")), "event_id").alias("v"),
        F.max("event_id").alias("last_id"))
    return out.select("user_id", F.col("d").cast("string").alias("day"), F.col("v.c").cast("double").alias("cents"), "last_id")


@query("SELECT DISTINCT ON (o_custkey) o_custkey, o_orderkey, o_orderpriority FROM orders ORDER BY o_custkey, o_orderdate DESC, o_orderkey DESC")
def latest_per_key(t: Tables):
    return latest_per(t.raw("orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"], ["o_orderkey", "o_orderpriority"])


@query("SELECT DISTINCT ON (o_custkey) o_custkey, o_orderkey, o_orderpriority FROM orders ORDER BY o_custkey, o_orderdate, o_orderkey")
def earliest_per_key(t: Tables):
    return earliest_per(t.raw("orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"], ["o_orderkey", "o_orderpriority"])


@query(with_tables("""SELECT p.event_id, p.user_id, CAST(v.event_id AS DOUBLE) AS view_id, CAST(v.cents AS DOUBLE) AS view_cents
FROM (SELECT * FROM ev WHERE event_type = 'purchase') p ASOF LEFT JOIN (SELECT * FROM ev WHERE event_type = 'view') v
  ON p.user_id = v.user_id AND p.event_id >= v.event_id""", "ev"))
def asof_join_keys(t: Tables):
    return _asof(t, ["user_id"], "event_id")


@query(with_tables("""SELECT p.event_id, p.user_id, CAST(v.event_id AS DOUBLE) AS view_id, CAST(v.cents AS DOUBLE) AS view_cents
FROM (SELECT * FROM ev WHERE event_type = 'purchase') p ASOF LEFT JOIN (SELECT * FROM ev WHERE event_type = 'view') v
  ON p.event_id >= v.event_id""", "ev"))
def asof_join_range_only(t: Tables):
    return _asof(t, [], "event_id")


@query(with_tables("""SELECT p.event_id, p.user_id, CAST(v.event_id AS DOUBLE) AS view_id, CAST(v.cents AS DOUBLE) AS view_cents
FROM (SELECT * FROM ev WHERE event_type = 'purchase') p ASOF LEFT JOIN (SELECT * FROM ev WHERE event_type = 'view') v
  ON p.pool_id = v.pool_id AND p.ts >= v.ts""", "ev"))
def asof_join_timestamps(t: Tables):
    return _asof(t, ["pool_id"], "ts")


def _asof(t: Tables, on, ts):
    ev = t.ev()
    views = ev.filter(F.col("event_type") == "view").select(
        *on, F.col(ts).alias("at"), F.col("event_id").alias("view_id"), F.col("cents").alias("view_cents"))
    left = ev.filter(F.col("event_type") == "purchase").select(
        *dict.fromkeys(["event_id", "user_id", *on, ts]))
    return asof_join(left, views, on, ts, "at", ["view_id", "view_cents"]).select(
        "event_id", "user_id", *[F.col(c).cast("double").alias(c) for c in ("view_id", "view_cents")])


@query(with_tables("""SELECT g.pool_id, g.asset_address, CAST(g.d AS VARCHAR) AS day, CAST(p.cents AS DOUBLE) AS cents
FROM (SELECT pool_id, asset_address, CAST(d AS DATE) AS d FROM (SELECT DISTINCT pool_id, asset_address FROM ev) x,
      generate_series(TIMESTAMP '2023-12-28', TIMESTAMP '2024-02-05', INTERVAL 1 DAY) s(d)) g
ASOF LEFT JOIN (SELECT pool_id, asset_address, day, arg_max(cents, event_id) AS cents FROM ev GROUP BY 1, 2, 3) p
  ON g.pool_id = p.pool_id AND g.asset_address = p.asset_address AND g.d >= p.day""", "ev"))
def forward_fill_daily(t: Tables):
    facts = t.ev().withColumn("d", F.to_date("ts"))
    out = forward_fill(facts, ["pool_id", "asset_address"], "d", ["cents"], "2023-12-28", "2024-02-05", order_cols=["event_id"],
                       leading_nulls=True)
    return out.select("pool_id", "asset_address", day("day"), F.col("cents").cast("double").alias("cents"))


@query(with_tables("""SELECT pool_id, CAST(day AS VARCHAR) AS day, CAST(sum(s) OVER (PARTITION BY pool_id ORDER BY day ROWS UNBOUNDED PRECEDING) AS BIGINT) AS total
FROM (SELECT pool_id, day, sum(CASE event_type WHEN 'signup' THEN cents WHEN 'click' THEN -cents ELSE 0 END) AS s FROM ev GROUP BY 1, 2)""", "ev"))
def running_total_daily(t: Tables):
    delta = F.when(F.col("event_type") == "signup", F.col("cents")).when(
        F.col("event_type") == "click", -F.col("cents")).otherwise(0)
    out = running_total(t.ev().withColumn("d", F.to_date("ts")), ["pool_id"], "d", delta, "total")
    return out.select("pool_id", F.col("d").cast("string").alias("day"), F.col("total").cast("bigint").alias("total"))


@query("""SELECT a.event_id FROM events a WHERE NOT EXISTS (
  SELECT 1 FROM events b WHERE b.event_id = a.event_id AND b.event_type IN ('view', 'error')
   AND (CASE WHEN b.user_id > 50 THEN b.user_id END) IS NOT DISTINCT FROM (CASE WHEN a.user_id > 40 THEN a.user_id END))""")
def null_safe_anti_match(t: Tables):
    from ..plans.events import without_streamed

    ev = t.raw("events")
    left = ev.select("event_id", F.when(F.col("user_id") > 40, F.col("user_id")).alias("u"))
    right = ev.filter(F.col("event_type").isin("view", "error")).select(
        "event_id", F.when(F.col("user_id") > 50, F.col("user_id")).alias("u"), F.lit("gs").alias("src"))
    return without_streamed(left, right, ["event_id"], ["u"]).select("event_id")


@query("""SELECT o_orderkey, count(*) AS n FROM orders JOIN lineitem ON o_orderkey = l_orderkey
  AND (o_orderstatus = 'O' OR l_shipdate < o_orderdate + INTERVAL 100 DAY) GROUP BY 1""")
def range_residual_join(t: Tables):
    o, li = t.raw("orders"), t.raw("lineitem")
    cond = (o.o_orderkey == li.l_orderkey) & (
        (o.o_orderstatus == "O") | (li.l_shipdate < o.o_orderdate + F.expr("INTERVAL 100 DAY")))
    return o.join(li, cond).groupBy("o_orderkey").agg(F.count("*").alias("n"))


@query("""SELECT 'A' || p_partkey AS asset_address FROM part UNION SELECT 'A' || l_partkey FROM lineitem
UNION SELECT 'S' || l_suppkey FROM lineitem UNION SELECT 'S' || s_suppkey FROM supplier""")
def union_assets_distinct(t: Tables):
    from ..plans.refdata import discovered_assets

    li = t.raw("lineitem")
    return discovered_assets([
        t.raw("part").select(_text("A", F.col("p_partkey")).alias("asset_address")),
        li.select(_text("A", F.col("l_partkey")).alias("asset_address")),
        li.select(_text("S", F.col("l_suppkey")).alias("asset_address")),
        t.raw("supplier").select(_text("S", F.col("s_suppkey")).alias("asset_address"))])


@query(with_tables("""SELECT f.*, t.symbol AS asset_symbol FROM (
  SELECT * FROM (SELECT id, strftime(ledger_closed_at, '%Y-%m-%dT%H:%M:%SZ') AS time, action_type, 'pool' AS source, user_address, CAST(amount_underlying AS DOUBLE) AS amount,
   asset_address, ledger_sequence FROM actions WHERE pool_id = 'P1' ORDER BY ledger_closed_at DESC, id LIMIT 50)
  UNION ALL SELECT * FROM (SELECT id, strftime(ledger_closed_at, '%Y-%m-%dT%H:%M:%SZ'), action_type, 'backstop', user_address, CAST(lp_tokens AS DOUBLE), NULL, ledger_sequence
   FROM backstop WHERE pool_address = 'P1' ORDER BY ledger_closed_at DESC, id LIMIT 50)) f
LEFT JOIN tokens t USING (asset_address)""", "actions", "backstop", "tokens"))
def live_feed_union(t: Tables):
    out = feed.live_feed(t.actions(), t.backstop(), "P1", 50, t.tokens())
    return out.drop("transaction_hash").withColumns({
        "time": iso_z(F.col("time")), "amount": F.col("amount").cast("double")})


@query("""SELECT count(*) AS total_rows, CAST(CAST(min(ts) AS DATE) AS VARCHAR) AS earliest, CAST(CAST(max(ts) AS DATE) AS VARCHAR) AS latest,
  count(DISTINCT user_id) AS users, count(DISTINCT event_type) AS types FROM events""")
def table_statistics(t: Tables):
    out = table_stats(t.raw("events"), "ts", {"users": "user_id", "types": "event_type"})
    return out.withColumns({c: F.to_date(c).cast("string") for c in ("earliest", "latest")})


@query("SELECT event_type AS action_type, count(*) AS n FROM events GROUP BY 1")
def action_type_counts(t: Tables):
    return action_counts(t.raw("events").withColumnRenamed("event_type", "action_type"))


@query("SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY 1, 2")
def breakdown_counts(t: Tables):
    return breakdown(t.raw("lineitem"), "l_returnflag", "l_linestatus")


@query("""SELECT CAST(min(d) AS VARCHAR) AS earliest, CAST(max(d) AS VARCHAR) AS latest, count(DISTINCT d) AS days_present, date_diff('day', min(d), max(d)) + 1 AS days_covered,
  date_diff('day', DATE '2024-01-01', DATE '2024-02-15') AS expected_days, min(d) <= DATE '2024-01-01' AND max(d) >= DATE '2024-02-15' AS complete
FROM (SELECT CAST(ts AS DATE) AS d FROM events)""")
def coverage_days(t: Tables):
    out = day_coverage(t.raw("events"), "ts", "2024-01-01", "2024-02-15")
    return out.withColumns({c: F.col(c).cast("string") for c in ("earliest", "latest")})


@query("SELECT max(event_id) AS last_ledger, CAST(CAST(max(ts) AS DATE) AS VARCHAR) AS last_date FROM events")
def table_watermark(t: Tables):
    out = watermark(t.raw("events"), "event_id", "ts")
    return out.withColumn("last_date", F.to_date("last_date").cast("string"))


_BAD = """CASE WHEN user_id < 10 THEN 'missing user' WHEN value <= 5 THEN 'invalid price' WHEN event_type = 'error' THEN 'unknown action' END"""


@query(f"SELECT event_id, {_BAD} AS reject_reason FROM events WHERE {_BAD} IS NOT NULL")
def validate_rejects(t: Tables):
    ev = t.raw("events").withColumn("user", F.when(F.col("user_id") >= 10, F.col("user_id").cast("string")))
    _, rejects = validate(ev, [
        required("user", reason="missing user"), Rule("invalid price", F.col("value") <= 5),
        Rule("unknown action", ~F.col("event_type").isin("signup", "purchase", "view", "click"))])
    return rejects.select("event_id", "reject_reason")


@query(f"SELECT count(*) AS n FROM events WHERE {_BAD} IS NULL")
def validate_accepts(t: Tables):
    valid, _ = validate(t.raw("events"), [
        Rule("missing user", F.col("user_id") < 10), Rule("invalid price", F.col("value") <= 5),
        Rule("unknown action", F.col("event_type") == "error")])
    return valid.agg(F.count("*").alias("n"))


@query(r"""SELECT doc_id, regexp_matches(w, '^[GCM][A-Z2-7]{55}$') AS address, try_cast(d AS DATE) IS NOT NULL AND regexp_matches(d, '^\d{4}-\d{2}-\d{2}$') AS iso_day
FROM (SELECT doc_id, 'G' || right(CASE WHEN n_chars % 2 = 0 THEN translate(upper(sha256(text)), '0189', 'WXYZ') ELSE upper(sha256(text)) END, 55) AS w,
             '2024-' || lpad(CAST(n_chars % 15 AS VARCHAR), 2, '0') || '-' || lpad(CAST(doc_id % 33 AS VARCHAR), 2, '0') AS d FROM documents)""")
def wellformed_texts(t: Tables):
    """Address and date predicates on texts that are partly well-formed."""
    pad = lambda c: F.lpad(c.cast("string"), 2, "0")
    d = F.concat(F.lit("2024-"), pad(F.col("n_chars") % 15), F.lit("-"), pad(F.col("doc_id") % 33))
    digest = F.upper(F.sha2("text", 256))
    letters = F.when(F.col("n_chars") % 2 == 0, F.translate(digest, "0189", "WXYZ")).otherwise(digest)
    address = F.concat(F.lit("G"), F.right(letters, F.lit(55)))
    return t.raw("documents").select("doc_id", is_address(address).alias("address"), is_iso_day(d).alias("iso_day"))


# --- writes -------------------------------------------------------------------

_UPSERT_SCHEMA = schemas._struct(
    user_id=schemas._L, event_type=schemas._S, event_date=schemas._D, event_id=schemas._L, cents=schemas._L)


def _keyed_rows(t: Tables):
    return t.ev().select("user_id", "event_type", F.to_date("ts").alias("event_date"), "event_id", "cents")


_HALVES = """halves AS (SELECT *, CASE WHEN event_type IN ('view', 'click', 'error') THEN 1 ELSE 2 END AS half FROM ev)"""


@query(with_tables("""SELECT user_id, CAST(day AS VARCHAR) AS event_date, arg_max(event_id, half * 1000000000000 + event_id) AS event_id,
  arg_max(cents, half * 1000000000000 + event_id) AS cents FROM halves GROUP BY user_id, day""", "ev", more=_HALVES))
def upsert_result(t: Tables):
    """Two batches written one after the other into a partitioned table."""
    path, keys = scratch_path(t.spark, "upsert"), ["user_id", "event_date"]
    first = F.col("event_type").isin("view", "click", "error")
    for part in (_keyed_rows(t).filter(first), _keyed_rows(t).filter(~first)):
        upsert(t.spark, path, part, _UPSERT_SCHEMA, keys, ["event_id"], "event_date")
    return t.spark.read.schema(_UPSERT_SCHEMA).parquet(path).select("user_id", day("event_date"), "event_id", "cents")


@query(with_tables("""SELECT a.new - b.hit AS inserted, b.hit AS updated FROM
 (SELECT count(*) AS new FROM (SELECT DISTINCT user_id, day FROM halves WHERE half = 2)) a,
 (SELECT count(*) AS hit FROM (SELECT user_id, day FROM halves WHERE half = 2 INTERSECT SELECT user_id, day FROM halves WHERE half = 1)) b""",
    "ev", more=_HALVES))
def upsert_counts(t: Tables):
    """How many keys of a batch are new and how many replace a stored row."""
    from ..operators.upsert import merged_rows

    first = F.col("event_type").isin("view", "click", "error")
    keys = ["user_id", "event_date"]
    old = dedup_last(_keyed_rows(t).filter(first), keys, ["event_id"])
    new = dedup_last(_keyed_rows(t).filter(~first), keys, ["event_id"])
    merged = merged_rows(old, new, keys)
    return merged.agg(F.count_if(F.col("_op") == "insert").alias("inserted"), F.count_if(F.col("_op") == "update").alias("updated"))


@query(with_tables("""SELECT p.token_address, CAST(p.price_date AS VARCHAR) AS price_date FROM prices p
WHERE NOT EXISTS (SELECT 1 FROM prices q WHERE q.token_address = p.token_address AND q.price_date = p.price_date AND q.source = 'R')""", "prices"))
def insert_missing_dates(t: Tables):
    stored = t.prices().filter(F.col("source") == "R")
    return missing_rows(stored, t.prices(), ["token_address", "price_date"]).select("token_address", day("price_date"))


# --- searches -----------------------------------------------------------------

@query(with_tables("""SELECT event_id AS ledger_sequence, 'fill_auction' AS action_type FROM ev
WHERE event_type = 'error' AND event_id % 3 = 2 AND event_id >= (SELECT max(event_id) FROM ev) - 4000""", "ev"))
def topic_window_search(t: Tables):
    out = search.search_log(t.spark, t.log_path("raw_lending"), "fill_auction", 4000)
    return out.select("ledger_sequence", "action_type")


@query(with_tables("""SELECT event_id AS ledger_sequence, CASE event_id % 3 WHEN 1 THEN 'new_auction' ELSE 'fill_auction' END AS action_type FROM ev
WHERE event_type = 'error' AND event_id % 3 <> 0 AND event_id >= (SELECT max(event_id) FROM ev) - 17280""", "ev"))
def topic_window_fallback(t: Tables):
    return search.search_log(t.spark, t.log_path("raw_lending"), "bad_debt").select("ledger_sequence", "action_type")


@query("""SELECT doc_id, contains(text, 'the of') AS in_envelope, contains(source, 'src1') AS in_meta FROM documents
WHERE contains(text, 'the of') OR contains(source, 'src1')""")
def byte_scan(t: Tables):
    tx = t.raw("documents").select("doc_id", F.base64(F.col("text").cast("binary")).alias("envelope"),
                                   F.base64(F.col("source").cast("binary")).alias("meta"))
    flagged = tx.withColumns({"in_envelope": search.contains_bytes(F.col("envelope"), b"the of"),
                              "in_meta": search.contains_bytes(F.col("meta"), b"src1")})
    return flagged.filter("in_envelope OR in_meta").select("doc_id", "in_envelope", "in_meta")
