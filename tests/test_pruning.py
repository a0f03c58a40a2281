"""Scans of the raw logs: ledgers become days, a user's address reaches the row groups."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgertide.catalog import load_queries
from ledgertide.plans import positions, search
from ledgertide.sources import bronze, ledger
from tests.conftest import SF


def state_rows(spark, days, users=400):
    return spark.range(users * days).selectExpr(
        "concat('P', id % 3) AS contract_id", f"timestamp'2024-01-01' + make_interval(0, 0, 0, CAST(id DIV {users} AS INT), 1) AS closed_at",
        "id AS ledger_sequence", "concat('h', id) AS ledger_key_hash_base_64", "1L AS ledger_entry_change", "false AS deleted",
        f"""concat('{{"vec":[{{"symbol":"Positions"}},{{"address":"U', id % {users}, '"}}]}}') AS key_decoded""",
        """'{"map":[{"key":{"u32":0},"val":{"map":[]}},{"key":{"u32":1},"val":{"map":[{"key":{"u32":0},"val":{"i128":"5"}}]}}]}' AS val_decoded""")


def event_rows(spark, first, n):
    return spark.range(first, first + n).selectExpr(
        "concat('e', id) AS id", "'contract' AS type", "concat('t', id) AS transaction_hash", "id AS ledger_sequence",
        "timestamp'2024-01-01' + make_interval(0, 0, 0, CAST(id DIV 100 AS INT)) AS closed_at", "'P' AS contract_id",
        "true AS in_successful_contract_call", "1L AS operation_id",
        """CASE WHEN id % 50 = 0 THEN '[{"symbol":"bad_debt"}]' ELSE '[{"symbol":"supply"}]' END AS topics_decoded""", "'{}' AS data_decoded")


def plan_of(df):
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "5000")
    return df._jdf.queryExecution().executedPlan().toString()


def scan_metric(df, name):
    """A metric of the only scan of a query that has run."""
    found = []

    def walk(node):
        if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if node.getClass().getSimpleName() == "FileSourceScanExec":
            found.append(node.metrics().apply(name).value())
        for i in range(node.children().size()):
            walk(node.children().apply(i))
        if hasattr(node, "plan") and node.getClass().getSimpleName().endswith("QueryStageExec"):
            walk(node.plan())

    walk(df._jdf.queryExecution().executedPlan())
    return found


def test_a_ledger_range_reads_its_days_only(spark, tmp_path):
    path = str(tmp_path / "log")
    bronze.land(bronze.with_event_layout(event_rows(spark, 0, 500)), path)
    bronze.land(bronze.with_event_layout(event_rows(spark, 500, 450)), path, mode="append")
    days = {r.date.day: (r.first_ledger, r.last_ledger) for r in bronze.ledger_days(spark, path).collect()}
    assert days == {i + 1: (100 * i, min(100 * i + 99, 949)) for i in range(10)}
    rows = ledger.scan_events(spark, path, first_ledger=250, last_ledger=420)
    assert sorted(r.ledger_sequence for r in rows.collect()) == list(range(250, 421))
    assert "date" in plan_of(rows).split("PartitionFilters: [")[1].split("]")[0]
    assert scan_metric(rows, "numPartitions") == [3]
    assert ledger.scan_events(spark, path, first_ledger=5000).count() == 0
    newest = ledger.scan_events(spark, path, newest=10)
    assert sorted(r.ledger_sequence for r in newest.collect()) == list(range(939, 950)) and scan_metric(newest, "numPartitions") == [1]
    hits = search.search_log(spark, path, n_ledgers=120)
    assert sorted(r.ledger_sequence for r in hits.collect()) == [850, 900]


def test_a_log_without_the_table_or_without_rows_is_scanned_whole(spark, tmp_path):
    path = str(tmp_path / "log")
    bronze.with_event_layout(event_rows(spark, 0, 300)).write.partitionBy("date").parquet(path)
    assert bronze.ledger_days(spark, path) is None
    assert ledger.scan_events(spark, path, first_ledger=250).count() == 50 and ledger.scan_events(spark, path, newest=9).count() == 10
    none = str(tmp_path / "none")
    bronze.land(bronze.with_event_layout(event_rows(spark, 0, 0)), none)
    assert bronze.newest_ledger(spark, none) is None


def test_a_user_reaches_the_row_groups(spark, tmp_path):
    path = str(tmp_path / "state")
    bronze.land(bronze.with_state_layout(state_rows(spark, 2, 6000)), path, addresses=500, **{"parquet.block.size": "16384"})
    state = ledger.scan_state(spark, path)
    rows = positions.user_position_changes(state, "U77", pool_id="P2", start_date="2024-01-01")
    assert "EqualTo(key_address,U77)" in plan_of(rows)
    one = state.filter(F.col("key_address") == "U77").select("contract_id", "key_address")
    assert one.count() == 2
    got = one.collect()
    read = sum(scan_metric(one, "numOutputRows"))
    assert len(got) == 2 and read < state.count() / 3
    lacking = state.filter(F.col("key_address") == "U77x").select("contract_id")  # lies between two addresses
    assert lacking.collect() == [] and sum(scan_metric(lacking, "numOutputRows")) < read


@pytest.mark.parametrize("name", ["ledger_range_inclusive", "topic_window_search", "topic_window_fallback", "state_scan_bounded"])
def test_registered_scans_are_pruned_by_day(spark, name):
    plan = plan_of(load_queries()[0][name](spark, SF))
    filters = [part.split("]")[0] for part in plan.split("PartitionFilters: [")[1:]]
    assert filters and all("date" in f for f in filters)


def test_the_map_spans_days_noted_twice(spark, tmp_path):
    path = str(tmp_path / "log")
    for first in (0, 50, 30):
        bronze.land(bronze.with_event_layout(event_rows(spark, first, 40)), path, mode="append")
    assert [tuple(r) for r in bronze.ledger_days(spark, path).collect()] == [(dt.date(2024, 1, 1), 0, 89)]
