import json
from datetime import timedelta

from pyspark.sql import functions as F

from ledgertide import schemas
from ledgertide.plans import events as batch_events
from ledgertide.plans import feed, views
from ledgertide.sources import ledger
from ledgertide.streaming import events as event_stream
from ledgertide.streaming import state as state_stream
from ledgertide.streaming import tables
from ledgertide.streaming.tables import TableStore
from tests import samples as s


def stream_rows(spark, raw):
    df = spark.createDataFrame(raw, schemas.CONTRACT_EVENTS)
    return df.select("id", "type", "transaction_hash", "ledger_sequence", F.col("closed_at").alias("ledger_closed_at"), "contract_id",
                     "in_successful_contract_call", F.col("topics_decoded").alias("topics"), F.col("data_decoded").alias("data"))


def raw_rows():
    lending = [s.event(100 + i, t, d) for i, (t, d, _) in enumerate(s.lending_cases(s.flat).values())]
    lending += [s.event(130 + i, t, d) for i, (t, d, _) in enumerate(s.lending_cases(s.split).values())]
    back = [s.event(200 + i, [s.sym(a), *t], d, contract=s.BACKSTOP) for i, (a, (t, d, _)) in enumerate(s.backstop_cases(s.flat).items())]
    other = [s.event(300, *list(s.lending_cases(s.flat).values())[0][:2], contract="COTHER")]
    return lending, back, other


def run(spark, path, store, checkpoint, **kw):
    stream = ledger.stream_events(spark, path, **kw)
    event_stream.run_event_stream(stream, store, checkpoint, [s.POOL], s.BACKSTOP, available_now=True).awaitTermination()


def ids(store, name):
    return sorted(r["id"] for r in store.read(name).collect())


def test_stream_equals_batch_and_survives_replay(spark, tmp_path):
    lending, back, other = raw_rows()
    landed, store = str(tmp_path / "in"), TableStore(spark, str(tmp_path / "tables"))
    stream_rows(spark, lending[:9]).coalesce(1).write.mode("append").parquet(landed)
    run(spark, landed, store, str(tmp_path / "cp"))
    # More files, with repeated rows, picked up by a restarted query.
    stream_rows(spark, lending + back + other).coalesce(1).write.mode("append").parquet(landed)
    run(spark, landed, store, str(tmp_path / "cp"))
    raw = spark.createDataFrame(lending + back + other, schemas.CONTRACT_EVENTS)
    expected = sorted(r["id"] for r in batch_events.lending_table(raw, [s.POOL]).collect())
    assert ids(store, "parsed_events") == expected
    assert len(ids(store, "backstop_events")) == 8
    assert {r["src"] for r in store.read("parsed_events").collect()} == {"gs"}
    # The same files once more from the very beginning change nothing.
    run(spark, landed, store, str(tmp_path / "cp2"))
    assert ids(store, "parsed_events") == expected
    metrics = store.read_batches("metrics").agg(F.max("events_received").alias("n")).collect()[0]
    assert metrics["n"] == len(lending + back + other) + 9


def shown(df):
    return sorted(str(r) for r in df.select(*sorted(df.columns)).collect())


def test_feed_and_views_follow_the_events(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "FEED_ROWS", 4)
    lending, back, _ = raw_rows()
    days = [s.event(400 + i, t, d, at=s.AT + timedelta(days=i % 3)) for i, (t, d, _) in enumerate(list(s.lending_cases(s.flat).values()) * 2)]
    landed, store = str(tmp_path / "in"), TableStore(spark, str(tmp_path / "tables"), derived=True)

    def agree():
        events, backstop = store.read("parsed_events"), store.read("backstop_events")
        assert store.read("live_feed").groupBy("pool_id", "source").count().agg(F.max("count")).first()[0] <= 4
        for n in (2, 4):
            assert shown(feed.feed_of_pool(store.read("live_feed"), s.POOL, n)) == shown(feed.live_feed(events, backstop, s.POOL, n))
        assert shown(views.user_positions_from_partials(store.read("positions_by_day"))) == shown(views.user_positions(events))
        assert shown(views.user_total_claims_from_partials(store.read("claims_by_day"))) == shown(views.user_total_claims(events))
        nine = lambda df: df.withColumn("avg_rate", F.round(F.col("avg_rate").cast("double"), 9))
        assert shown(nine(views.daily_rate_stats_from_partials(store.read("rates_by_day")))) == shown(nine(views.daily_rate_stats(events)))

    stream_rows(spark, days[:7] + back[:3]).coalesce(1).write.parquet(landed)
    run(spark, landed, store, str(tmp_path / "cp"))
    agree()
    # Older events, newer ones and repeated ones of touched and of new days; a later writer needs no flag.
    stream_rows(spark, lending + days + back).coalesce(1).write.mode("append").parquet(landed)
    later = TableStore(spark, store.root)
    run(spark, landed, later, str(tmp_path / "cp"))
    agree()
    before = {n: shown(store.read(n)) for n in ("live_feed", *views.PARTIALS)}
    run(spark, landed, later, str(tmp_path / "cp-again"))  # everything once more
    assert {n: shown(store.read(n)) for n in before} == before


def test_derived_tables_start_from_what_is_stored(spark, tmp_path):
    lending, back, _ = raw_rows()
    landed, store = str(tmp_path / "in"), TableStore(spark, str(tmp_path / "tables"))
    stream_rows(spark, lending[:9] + back).coalesce(1).write.parquet(landed)
    run(spark, landed, store, str(tmp_path / "cp"))
    assert not store.exists("live_feed") and not store.exists("claims_by_day")
    stream_rows(spark, lending[9:]).coalesce(1).write.mode("append").parquet(landed)
    run(spark, landed, TableStore(spark, store.root, derived=True), str(tmp_path / "cp"))
    events, backstop = store.read("parsed_events"), store.read("backstop_events")
    assert shown(feed.feed_of_pool(store.read("live_feed"), s.POOL)) == shown(feed.live_feed(events, backstop, s.POOL))
    assert shown(views.user_positions_from_partials(store.read("positions_by_day"))) == shown(views.user_positions(events))


def test_too_wide_numbers_go_to_the_rejects(spark, tmp_path):
    rows = [s.event(1, [s.sym("supply"), s.adr(s.ASSET), s.adr(s.USER)], {"vec": [s.flat(s.BIG), s.flat(1)]})]
    landed, store = str(tmp_path / "in"), TableStore(spark, str(tmp_path / "tables"))
    stream_rows(spark, rows).write.parquet(landed)
    run(spark, landed, store, str(tmp_path / "cp"))
    assert store.read("parsed_events").count() == 0
    assert [r["table"] for r in store.read_batches("rejects").collect()] == ["parsed_events"]


def test_start_at_a_ledger_and_at_the_end(spark, tmp_path):
    lending, _, _ = raw_rows()
    landed = str(tmp_path / "in")
    stream_rows(spark, lending).write.parquet(landed)
    for start_at, expected in ((130, 9), ("latest", 0)):
        store = TableStore(spark, str(tmp_path / f"tables-{start_at}"))
        run(spark, landed, store, str(tmp_path / f"cp-{start_at}"), start_at=start_at)
        assert store.read("parsed_events").count() == expected


def test_epoch_millisecond_close_times(spark):
    df = spark.createDataFrame([(1746100800000,)], "ledger_closed_at long")
    assert str(ledger.normalise_close_time(df).collect()[0][0]) == "2025-05-01 12:00:00"


# --- state pipeline -----------------------------------------------------------

def change(kind, address, val, number, deleted=False, at="2025-05-01T12:00:00Z"):
    key = {"vec": [s.sym(kind)] + ([s.adr(address)] if address else [])}
    return {"ledger_sequence": number, "closed_at": at, "contract_id": s.POOL, "ledger_key_hash": f"h{number}",
            "ledger_entry_change": 1, "deleted": deleted, "key_decoded": key, "val_decoded": val}


def post(path, name, changes):
    path.mkdir(exist_ok=True)
    payload = {"events": changes, "timestamp": "2025-05-01T12:00:00Z", "network": "test"} if changes is not None else {"timestamp": "x"}
    (path / f"{name}.json").write_text(json.dumps(payload))


def run_state(spark, tmp_path, store, max_files=None):
    stream = ledger.stream_state_batches(spark, str(tmp_path / "posts"), max_files)
    state_stream.run_state_stream(stream, store, str(tmp_path / "cp-state"), available_now=True).awaitTermination()


def test_phases_rates_and_rejects(spark, tmp_path):
    posts, store = tmp_path / "posts", TableStore(spark, str(tmp_path / "tables"))
    # Out of order inside the batch: the position comes before its configuration and rates.
    post(posts, "a", [
        change("Positions", s.USER, s.positions({0: 70_000_000}, {}, {2: 10_000_000}), 12),
        change("ResData", s.ASSET, s.reserve(11 * 10**11, 12 * 10**11), 11), change("ResConfig", s.ASSET, s.config(0), 10),
        change("Positions", "GGONE", s.positions({0: 1}, {}, {}), 13, deleted=True), change("Admin", None, None, 1)])
    post(posts, "b", None)
    run_state(spark, tmp_path, store)
    rows = store.read("user_positions").collect()
    assert [(r["asset_address"], float(r["collateral_btokens"]), float(r["b_rate"]), float(r["d_rate"])) for r in rows] == [
        (s.ASSET, 7.0, 1.1, 1.2)]
    reasons = sorted(r["reject_reason"] for r in store.read_batches("state_rejects").collect())
    assert reasons == ["no asset mapping for reserve index 2", "payload without events array"]
    m = store.read_batches("state_metrics").collect()[0]
    assert (m["events_received"], m["configs_processed"], m["pools_processed"], m["positions_processed"]) == (5, 1, 1, 2)


def test_late_snapshot_does_not_replace_a_newer_one(spark, tmp_path):
    posts, store = tmp_path / "posts", TableStore(spark, str(tmp_path / "tables"))
    post(posts, "a", [change("ResData", s.ASSET, s.reserve(2 * 10**12, 10**12), 20)])
    run_state(spark, tmp_path, store)
    post(posts, "b", [change("ResData", s.ASSET, s.reserve(10**12, 10**12), 15)])
    run_state(spark, tmp_path, store)
    assert [(float(r["b_rate"]), r["ledger_sequence"]) for r in store.read("pool_snapshots").collect()] == [(2.0, 20)]


def test_mapping_follows_repointing_and_deletion(spark, tmp_path):
    posts, store = tmp_path / "posts", TableStore(spark, str(tmp_path / "tables"))
    post(posts, "a", [change("ResConfig", "CA", s.config(0), 1), change("ResConfig", "CB", s.config(1), 2)])
    run_state(spark, tmp_path, store)
    post(posts, "b", [change("ResConfig", "CC", s.config(0), 3), change("ResConfig", "CB", None, 4, deleted=True)])
    run_state(spark, tmp_path, store)
    mapping = state_stream.current_mapping(store.read("reserve_config_state")).collect()
    assert [(r["reserve_index"], r["asset_address"]) for r in mapping] == [(0, "CC")]


def test_position_before_any_rate_has_none(spark, tmp_path):
    posts, store = tmp_path / "posts", TableStore(spark, str(tmp_path / "tables"))
    post(posts, "a", [change("ResConfig", s.ASSET, s.config(0), 1), change("Positions", s.USER, s.positions({}, {0: 5}, {}), 2),
                      change("ResData", s.ASSET, s.reserve(10**12, 10**12), 3)])
    run_state(spark, tmp_path, store)
    row = store.read("user_positions").collect()[0]
    assert row["b_rate"] is None and float(row["liabilities_dtokens"]) == 5e-7


def test_all_reserves_of_a_position_are_kept(spark, tmp_path):
    posts, store = tmp_path / "posts", TableStore(spark, str(tmp_path / "tables"))
    post(posts, "a", [change("ResConfig", f"C{i}", s.config(i), i + 1) for i in range(3)] + [
        change("Positions", s.USER, s.positions({0: 1}, {1: 2}, {2: 3}), 9)])
    run_state(spark, tmp_path, store)
    assert sorted(r["asset_address"] for r in store.read("user_positions").collect()) == ["C0", "C1", "C2"]


def held(store):
    return {(r["asset_address"], r["ledger_sequence"]): (r["b_rate"] and float(r["b_rate"]), float(r["collateral_btokens"]))
            for r in store.read("user_positions").collect()}


def test_a_position_waits_for_its_mapping(spark, tmp_path):
    posts, store = tmp_path / "posts", TableStore(spark, str(tmp_path / "tables"))
    post(posts, "a", [change("ResData", "CA", s.reserve(11 * 10**11, 10**12), 5), change("ResConfig", "CA", s.config(0), 6),
                      change("Positions", s.USER, s.positions({0: 10_000_000, 1: 20_000_000}, {}, {}), 12)])
    run_state(spark, tmp_path, store)
    assert held(store) == {("CA", 12): (1.1, 1.0)}
    assert [(r.reserve_index, r.resolved) for r in store.read("pending_positions").collect()] == [(1, False)]
    # The mapping lands a batch later, with a rate before the position and one after it.
    post(posts, "b", [change("ResConfig", "CB", s.config(1), 30), change("ResData", "CB", s.reserve(13 * 10**11, 10**12), 9, at="2025-04-20T01:00:00Z"),
                      change("ResData", "CB", s.reserve(15 * 10**11, 10**12), 31, at="2025-05-03T01:00:00Z")])
    run_state(spark, tmp_path, store)
    assert held(store) == {("CA", 12): (1.1, 1.0), ("CB", 12): (1.3, 2.0)}
    assert [r.resolved for r in store.read("pending_positions").collect()] == [True]


def test_a_replay_keeps_counters_and_tables(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "tables"))
    post(tmp_path / "posts", "a", [change("ResConfig", "CA", s.config(0), 1), change("ResData", "CA", s.reserve(10**12, 10**12), 2),
                                   change("Positions", s.USER, s.positions({0: 5}, {}, {3: 1}), 3)])
    run_state(spark, tmp_path, store)
    tables = ("state_metrics", "state_rejects")
    before = [sorted(map(str, store.read_batches(t).collect())) for t in tables], held(store), store.read("pending_positions").collect()
    payloads = spark.read.schema(schemas.STATE_BATCH).option("multiLine", False).json(str(tmp_path / "posts"))
    state_stream.state_batch_handler(store)(payloads, 0)
    assert ([sorted(map(str, store.read_batches(t).collect())) for t in tables], held(store), store.read("pending_positions").collect()) == before
    assert store.read_batches("state_metrics").first()["positions_inserted"] == 1


def test_a_batch_decodes_its_positions_once(spark, tmp_path, monkeypatch):
    """Waiting positions, rejects and stored ones come from one decoding."""
    decoded, decode_positions = spark.sparkContext.accumulator(0), state_stream.decode.decode_positions

    @F.udf("string")
    def noted(text):
        decoded.add(1)
        return text

    monkeypatch.setattr(state_stream.decode, "decode_positions", lambda entries, mode: decode_positions(
        entries, mode=mode).withColumn("user_address", noted("user_address")))
    post(tmp_path / "posts", "a", [change("ResConfig", "CA", s.config(0), 1), change("ResData", "CA", s.reserve(10**12, 10**12), 2),
                                   change("Positions", "U1", s.positions({0: 5}, {}, {}), 3), change("Positions", "U2", s.positions({7: 5}, {}, {}), 4)])
    payloads = spark.read.schema(schemas.STATE_BATCH).json(str(tmp_path / "posts"))
    store = TableStore(spark, str(tmp_path / "tables"))
    state_stream.state_batch_handler(store)(payloads, 0)
    assert store.read("user_positions").count() == 1 and store.read("pending_positions").count() == 1
    assert decoded.value == 2


def test_on_time_positions_read_no_history(spark, tmp_path, monkeypatch):
    posts, store = tmp_path / "posts", TableStore(spark, str(tmp_path / "tables"))
    post(posts, "a", [change("ResConfig", "CA", s.config(0), 1)] + [
        change("ResData", "CA", s.reserve((10 + i) * 10**11, 10**12), 100 * i, at=f"2025-04-{i:02d}T12:00:00Z") for i in range(1, 20)])
    run_state(spark, tmp_path, store)
    read, whole = [], TableStore.read

    def spy(self, name):
        read.append(name)
        return whole(self, name)

    monkeypatch.setattr(TableStore, "read", spy)
    post(posts, "b", [change("Positions", s.USER, s.positions({0: 10_000_000}, {}, {}), 1950, at="2025-04-19T13:00:00Z")])
    run_state(spark, tmp_path, store)
    assert "pool_snapshots" not in read and held(store) == {("CA", 1950): (2.9, 1.0)}
    # Late ones: inside a day, before the first rate, and long after a rate with nothing in between.
    post(posts, "c", [change("Positions", s.USER, s.positions({0: 10_000_000}, {}, {}), n, at=at) for n, at in (
        (850, "2025-04-08T20:00:00Z"), (50, "2025-03-01T00:00:00Z"), (899, "2025-04-09T01:00:00Z"))])
    run_state(spark, tmp_path, store)
    assert held(store) == {("CA", 1950): (2.9, 1.0), ("CA", 850): (1.8, 1.0), ("CA", 50): (None, 1.0), ("CA", 899): (1.8, 1.0)}


def test_indices_beyond_int_are_kept_apart(spark, tmp_path):
    posts, store = tmp_path / "posts", TableStore(spark, str(tmp_path / "tables"))
    post(posts, "a", [change("ResConfig", "CA", s.config(2**31 + 5), 1), change("ResConfig", "CB", s.config(2**31 + 6), 2)])
    run_state(spark, tmp_path, store)
    mapping = state_stream.current_mapping(store.read("reserve_config_state")).collect()
    assert sorted((r["reserve_index"], r["asset_address"]) for r in mapping) == [(2**31 + 5, "CA"), (2**31 + 6, "CB")]


def test_a_start_at_the_end_is_remembered_over_a_restart(spark, tmp_path):
    lending, _, _ = raw_rows()
    landed, store, cp = str(tmp_path / "in"), TableStore(spark, str(tmp_path / "tables")), str(tmp_path / "cp")
    options = {"start_at": "latest", "remember": str(tmp_path / "first-ledger")}
    stream_rows(spark, lending[:3]).coalesce(1).write.parquet(landed)
    run(spark, landed, store, cp, **options)
    assert ids(store, "parsed_events") == []
    stream_rows(spark, lending[3:9]).coalesce(1).write.mode("append").parquet(landed)
    run(spark, landed, store, cp, **options)  # a restart: what landed in between is not passed over
    assert len(ids(store, "parsed_events")) == 6
