"""Backfill jobs: rejects are kept out, coverage tells what is missing, previews write nothing, captures keep sources apart."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from ledgertide.operators.coverage import COVERAGE, gaps, islands
from ledgertide.operators.validate import SNAPSHOT_RULES
from ledgertide.plans import jobs
from ledgertide.session import scratch_path
from ledgertide.sources import bronze
from ledgertide.streaming.tables import TableStore

D = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(40)]


@pytest.fixture
def store(spark):
    return TableStore(spark, scratch_path(spark, "jobs"))


def snapshot_rows(spark):
    return spark.createDataFrame(
        [("P1", "A1", "2024-01-01", 1, 1.0, 1.0), ("P1", "A2", "2024-01-02", 2, None, 1.0), ("", "A3", "2024-01-03", 3, 1.0, 1.0)],
        "pool_id string, asset_address string, snapshot_date string, ledger_sequence long, b_rate double, d_rate double",
    ).withColumn("snapshot_date", F.col("snapshot_date").cast("date"))


def test_rejected_snapshots_are_counted_and_not_stored(spark, store):
    done = jobs._write(store, jobs._checked("pool_snapshots", snapshot_rows(spark), SNAPSHOT_RULES()))
    assert done == {"inserted": 1, "updated": 0, "stale": 0, "rejected": 2}
    assert [r.asset_address for r in store.read("pool_snapshots").collect()] == ["A1"]


def test_gaps_and_islands_equal_a_set_of_days(spark):
    rng = random.Random(5)
    cover = [(rng.choice("abc*"), *sorted(rng.choices(range(40), k=2))) for _ in range(14)]
    cover = [(s, a, min(b, a + 5)) for s, a, b in cover]
    frame = spark.createDataFrame([("t", "bq", s, D[a], D[b]) for s, a, b in cover], COVERAGE)
    scopes = spark.createDataFrame([(s,) for s in "abcd"], "scope string")
    done = {s: {d for x, a, b in cover if x in (s, "*") for d in range(a, b + 1)} for s in "abcd"}
    found = {s: set() for s in "abcd"}
    for r in gaps(frame, scopes, D[3], D[30]).collect():
        days = set(range((r.first_day - D[0]).days, (r.last_day - D[0]).days + 1))
        assert days and not found[r.scope] & {min(days) - 1, max(days) + 1}  # as long as they can be
        found[r.scope] |= days
    assert found == {s: set(range(3, 31)) - done[s] for s in "abcd"}
    assert gaps(frame, scopes, D[9], D[8]).count() == 0
    every = {(r.scope, d) for r in islands(frame).collect() for d in range((r.first_day - D[0]).days, (r.last_day - D[0]).days + 1)}
    assert every == {(s, d) for s, a, b in cover for d in range(a, b + 1)}


def log(spark, rows):
    """``(contract, day)`` rows of a log in the stored layout."""
    return spark.createDataFrame([(c, D[d]) for c, d in rows], "contract_id string, date date")


def test_a_run_is_planned_over_what_is_missing(spark, store):
    raw = log(spark, [(c, d) for c in ("P0", "P1", "P2") for d in range(20)])
    assert jobs.todo(store, "pool_snapshots", raw, resume=True).intervals == [("*", D[0], D[18])]  # the newest day stays open
    for scope, first, last in (("P0", 2, 5), ("P0", 9, 18), ("P1", 0, 18)):
        store.append("coverage", spark.createDataFrame([("pool_snapshots", "bq", scope, D[first], D[last])], COVERAGE))
    # other tables and other sources are no progress
    store.append("coverage", spark.createDataFrame([("parsed_events", "bq", "*", D[0], D[18]), ("pool_snapshots", "sdk", "*", D[0], D[18])], COVERAGE))
    run = jobs.todo(store, "pool_snapshots", raw, ["P0", "P1", "P2"], resume=True)
    days = {}
    for r in run.log.collect():
        days.setdefault(r.contract_id, []).append((r.date - D[0]).days)
    assert {c: sorted(d) for c, d in days.items()} == {"P0": [0, 1, 6, 7, 8, 19], "P1": [19], "P2": list(range(20))}
    assert (run.start_date, run.end_date) == (D[0], D[19])
    inside = jobs.todo(store, "pool_snapshots", raw, ["P1"], D[3], D[7], resume=True)
    assert inside.nothing and not inside.intervals


def test_a_run_over_all_contracts_leaves_out_what_runs_of_some_have_covered(spark, store):
    raw = log(spark, [(c, d) for c in ("P0", "P1", None) for d in range(20)])
    for scope, first, last in (("P0", 2, 5), ("P0", 6, 18), ("P1", 0, 3), ("P9", 0, 18)):
        store.append("coverage", spark.createDataFrame([("parsed_events", "bq", scope, D[first], D[last])], COVERAGE))
    store.append("coverage", spark.createDataFrame([("parsed_events", "sdk", "P1", D[0], D[18])], COVERAGE))  # another source
    run = jobs.todo(store, "parsed_events", raw, resume=True, by_contract=True)
    days = {}
    for r in run.log.collect():
        days.setdefault(r.contract_id, []).append((r.date - D[0]).days)
    assert {c: sorted(d) for c, d in days.items()} == {"P0": [0, 1, 19], "P1": list(range(4, 20)), None: list(range(20))}
    assert run.intervals == [("*", D[0], D[18])]
    assert jobs.todo(store, "parsed_events", raw, resume=True).log.count() == 60  # rows of other tables may rest on several contracts
    assert jobs.todo(store, "parsed_events", raw, by_contract=True).log.count() == 60  # no resume


def test_an_empty_log_and_streamed_rows_leave_everything_to_do(spark, store):
    assert jobs.todo(store, "parsed_events", log(spark, []), resume=True).nothing
    rows = spark.createDataFrame([("b", "gs", "2024-01-09 10:00:00")], "id string, src string, at string")
    store.upsert("parsed_events", rows.select("id", "src", F.col("at").cast("timestamp").alias("ledger_closed_at"),
                                              F.lit(1).alias("ledger_sequence")))
    assert jobs.todo(store, "parsed_events", log(spark, [("P", 0), ("P", 3)]), resume=True).intervals == [("*", D[0], D[2])]


def test_a_resumed_scan_reads_the_missing_days_only(spark, store, tmp_path):
    path = str(tmp_path / "log")
    rows = spark.createDataFrame([(c, f"2024-01-{d:02d} 05:00:00", d) for c in ("P0", "P1") for d in range(1, 9)],
                                 "contract_id string, at string, ledger_sequence long")
    raw = rows.select("contract_id", F.col("at").cast("timestamp").alias("closed_at"), "ledger_sequence",
                      F.lit("{}").alias("topics_decoded"))
    bronze.land(bronze.with_event_layout(raw), path)
    store.append("coverage", spark.createDataFrame([("parsed_events", "bq", "*", D[0], D[3])], COVERAGE))
    run = jobs.todo(store, "parsed_events", spark.read.parquet(path), resume=True)
    assert {f.split("date=")[1][:10] for f in run.log.inputFiles()} >= {str(D[4])}
    plan = run.log._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "date" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert sorted(r.ledger_sequence for r in run.log.distinct().collect() if r.contract_id == "P0") == [5, 6, 7, 8]


def test_a_preview_counts_and_writes_nothing(spark, store):
    planned = jobs._checked("pool_snapshots", snapshot_rows(spark), SNAPSHOT_RULES())
    counts, rows = jobs.preview(store, planned, limit=5)
    assert counts == {"inserted": 1, "updated": 0, "rejected": 2} and [r.op for r in rows.collect()] == ["insert"]
    assert store.read("pool_snapshots").count() == 0
    jobs._write(store, planned)
    assert jobs.preview(store, planned)[0] == {"inserted": 0, "updated": 1, "rejected": 2}


def test_a_preview_keeps_no_room_for_a_limit_it_does_not_reach(spark, store, monkeypatch):
    keyed = spark.createDataFrame([(f"P{i:02d}", "A", "2024-01-01", i, 1.0, 1.0) for i in range(40)],
                                  "pool_id string, asset_address string, snapshot_date string, ledger_sequence long, b_rate double, d_rate double")
    planned = jobs._checked("pool_snapshots", keyed.withColumn("snapshot_date", F.col("snapshot_date").cast("date")), SNAPSHOT_RULES())
    counts, rows = jobs.preview(store, planned, limit=10**9)  # room for so many rows in each task ended in want of memory
    assert "TakeOrdered" not in rows._jdf.queryExecution().executedPlan().toString()
    assert counts["inserted"] == 40 and [r.ledger_sequence for r in rows.collect()] == list(range(40))
    monkeypatch.setattr(jobs, "_PICKED_IN_MEMORY", 3)
    for limit in (0, 2, 3, 4, 11, 39, 40):
        rows = jobs.preview(store, planned, limit=limit)[1]
        assert [r.ledger_sequence for r in rows.collect()] == list(range(limit))
        assert limit <= 3 or "TakeOrdered" not in rows._jdf.queryExecution().executedPlan().toString()
    assert rows.columns[0] == "op" and "_at" not in rows.columns


def price_rows(spark, rows):
    return lambda: spark.createDataFrame(rows, "token_address string, price_date string, usd_price double, source string")


def test_a_capture_merges_sources_and_keeps_failures_apart(spark, store):
    def fails():
        raise TimeoutError("no answer\nat all")

    day = "2024-01-01"
    sources = {"first": price_rows(spark, [("A", day, 1.0, "x"), ("B", day, 2.0, "x"), ("C", day, 4.0, "x")]),
               "none": fails,
               "second": price_rows(spark, [("B", day, 3.0, "y"), ("C", day, float("nan"), "y"), ("D", day, None, "y"), ("E", day, 0.0, "y"),
                                            (None, day, 1.0, "y")])}
    done = jobs.capture_daily_prices(store, sources)
    stored = {r.token_address: (r.usd_price, r.source) for r in store.read("daily_token_prices").collect()}
    assert stored == {"A": (1.0, "x"), "B": (3.0, "y"), "C": (4.0, "x")}
    assert done.errors == {"none": "no answer"} and done.by_source == {"first": 2, "second": 1}
    assert done.counts == {"inserted": 3, "updated": 0, "stale": 0, "rejected": 4}
    turned = jobs.capture_daily_prices(store, sources, first_wins=True)
    assert turned.by_source == {"first": 3} and turned.counts["updated"] == 3
    assert jobs.capture_daily_prices(store, {"none": fails}).counts["inserted"] == 0
