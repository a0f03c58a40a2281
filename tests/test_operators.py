import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from ledgertide.functions import timewindow
from ledgertide.operators import (
    Rule, asof_join, dedup_first, dedup_last, forward_fill, latest_per, page_with_total, running_total, top_k_ranked, validate,
)
from ledgertide.operators.validate import required


def brute_asof(left, right):
    out = []
    for lid, key, tick in left:
        best = [r for r in right if r[0] == key and r[1] <= tick] if key is not None else []
        out.append((lid, max(best, key=lambda r: (r[1], r[2]))[2] if best else None))
    return sorted(out)


@pytest.mark.parametrize("seed,bucket", [(1, 1), (2, 3), (3, 7), (4, 64), (5, None)])
def test_asof_join_equals_brute_force(spark, seed, bucket):
    rnd = random.Random(seed)
    keys = ["a"] * 6 + ["b", "c", None]  # one hot key, one without a value
    left = [(i, rnd.choice(keys), rnd.randint(0, 60)) for i in range(120)]
    right = [(rnd.choice(["a", "a", "b"]), rnd.randint(0, 60), v) for v in range(60)]
    got = asof_join(
        spark.createDataFrame(left, "id int, k string, t long"), spark.createDataFrame(right, "k string, at long, v int"),
        ["k"], "t", "at", ["v"], bucket_ticks=bucket)
    assert got.columns == ["id", "k", "t", "v"]
    assert sorted((r["id"], r["v"]) for r in got.collect()) == brute_asof(left, right)


def test_asof_join_keeps_nulls_of_the_match_and_repeated_left_rows(spark):
    left = spark.createDataFrame([(5, "x"), (5, "x"), (1, "y")], "t long, n string")
    right = spark.createDataFrame([(2, None, 1.0), (0, 9.0, 9.0)], "at long, b double, d double").filter("at > 0")
    rows = sorted((r["t"], r["b"], r["d"]) for r in asof_join(left, right, [], "t", "at", ["b", "d"]).collect())
    assert rows == [(1, None, None), (5, None, 1.0), (5, None, 1.0)]


def test_asof_join_by_timestamp_and_date(spark):
    at = datetime(2024, 1, 1)
    left = spark.createDataFrame([(at + timedelta(minutes=m),) for m in (0, 30, 200)], "t timestamp")
    right = spark.createDataFrame([(at + timedelta(minutes=20), 1), (at + timedelta(minutes=190), 2)], "at timestamp, v int")
    assert [r["v"] for r in asof_join(left, right, [], "t", "at", ["v"]).orderBy("t").collect()] == [None, 1, 2]
    dl = spark.createDataFrame([(date(2024, 1, d),) for d in (1, 5)], "t date")
    dr = spark.createDataFrame([(date(2024, 1, 3), 7)], "at date, v int")
    assert [r["v"] for r in asof_join(dl, dr, [], "t", "at", ["v"]).orderBy("t").collect()] == [None, 7]


def test_asof_join_carries_facts_over_runs_of_buckets(spark):
    left = spark.createDataFrame([(0,), (9,), (50_000,), (90_000,)], "t long")
    right = spark.createDataFrame([(5, 1), (49_999, 2)], "at long, v int")
    got = asof_join(left, right, [], "t", "at", ["v"], bucket_ticks=2).orderBy("t")
    assert [r["v"] for r in got.collect()] == [None, 1, 2, 2]


def test_asof_window_groups_stay_bounded_for_a_hot_key(spark):
    """However many rows the hot key has, a window group holds one row per tick of a bucket."""
    left = spark.range(20_000).select(F.lit("hot").alias("k"), (F.col("id") % 1000).alias("t"))
    right = spark.range(50_000).select(F.lit("hot").alias("k"), (F.col("id") % 500).alias("at"), F.col("id").alias("v"))
    got = asof_join(left, right, ["k"], "t", "at", ["v"], bucket_ticks=50)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    agg = got.agg(F.count("*").alias("n"), F.count("v").alias("m"), F.max("v").alias("x")).collect()[0]
    assert (agg["n"], agg["m"], agg["x"]) == (20_000, 20_000, 49_999)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_forward_fill_equals_brute_force(spark, seed):
    rnd = random.Random(seed)
    d0 = date(2024, 1, 1)
    facts = [(rnd.choice("ab"), d0 + timedelta(days=rnd.randint(-10, 20)), i, rnd.choice([None, 1, 2])) for i in range(15)]
    lo, hi = d0, d0 + timedelta(days=14)
    got = forward_fill(spark.createDataFrame(facts, "k string, d date, o int, v int"), ["k"], "d", ["v"], lo, hi, order_cols=["o"])
    expected = []
    for k in {f[0] for f in facts}:
        for n in range(15):
            day = lo + timedelta(days=n)
            seen = [f for f in facts if f[0] == k and f[1] <= day]
            if seen:
                best = max(seen, key=lambda f: (f[1], f[2]))
                expected.append((k, day, best[1], best[3]))
    assert sorted(map(repr, expected)) == sorted(repr((r["k"], r["day"], r["fact_date"], r["v"])) for r in got.collect())


def test_forward_fill_with_leading_days(spark):
    df = spark.createDataFrame([("a", date(2024, 1, 3), 5)], "k string, d date, v int")
    rows = forward_fill(df, ["k"], "d", ["v"], "2024-01-01", "2024-01-04", leading_nulls=True).orderBy("day").collect()
    assert [r["v"] for r in rows] == [None, None, 5, 5]


def test_running_total_sums_per_day_first(spark):
    df = spark.createDataFrame([("p", date(2024, 1, 1), 1), ("p", date(2024, 1, 1), 2), ("p", date(2024, 1, 3), -1)], "k string, d date, x long")
    assert [r["t"] for r in running_total(df, ["k"], "d", F.col("x"), "t").orderBy("d").collect()] == [3, 2]


def test_dedup_does_not_depend_on_input_order(spark):
    rows = [("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z"), ("a", 3, None)]
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, "k string, o int, v string")
        assert {tuple(r) for r in dedup_first(df, ["k"], ["o"]).collect()} == {("a", 1, "x"), ("b", 1, "z")}
        assert {tuple(r) for r in dedup_last(df, ["k"], ["o"]).collect()} == {("a", 3, None), ("b", 1, "z")}
        assert {tuple(r) for r in latest_per(df, ["k"], ["o", "v"], ["v", "o"]).collect()} == {("a", None, 3), ("b", "z", 1)}


def test_dedup_limits_copies_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 2).alias("k"), F.col("id").alias("o"))
    plan = dedup_first(df, ["k"], ["o"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_top_k_ranks_only_k_rows(spark):
    df = spark.range(100).select(F.col("id"), (F.col("id") % 10).alias("v"))
    got = top_k_ranked(df, 3, [F.col("v").desc(), F.col("id")])
    assert [(r["rank"], r["id"]) for r in got.orderBy("rank").collect()] == [(1, 9), (2, 19), (3, 29)]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Window") < plan.index("TakeOrderedAndProject")


def test_page_knows_the_total(spark):
    rows = page_with_total(spark.range(30), [F.col("id").desc()], 5, 10).collect()
    assert [r["id"] for r in rows] == [19, 18, 17, 16, 15] and {r["total_count"] for r in rows} == {30}


def test_validation_names_the_first_broken_rule(spark):
    df = spark.createDataFrame([("", 1.0), ("a", -1.0), ("b", None), ("c", 2.0)], "id string, p double")
    valid, rejects = validate(df, [required("id"), Rule("bad price", F.col("p") <= 0)])
    assert {r["id"] for r in valid.collect()} == {"b", "c"}
    assert {(r["id"], r["reject_reason"]) for r in rejects.collect()} == {("", "missing id"), ("a", "bad price")}


NOW = datetime(2024, 3, 10, 15)


@pytest.mark.parametrize("args,bounds", [
    ((("2024-01-05", "2024-01-06"), {}), (datetime(2024, 1, 5), datetime(2024, 1, 7))),
    ((("2024-01-05", None), {}), (datetime(2024, 1, 5), None)),
    (((None, "2024-01-31"), {"days_back": 10}), (datetime(2024, 1, 21), datetime(2024, 2, 1))),
    (((None, "2024-01-31"), {"lookback_from_end": False}), (None, datetime(2024, 2, 1))),
    (((None, None), {"days_back": 5, "now": NOW}), (datetime(2024, 3, 5, 15), None)),
    (((None, None), {"days_back": 5, "now": NOW, "widen_days": 30}), (datetime(2024, 2, 4, 15), None)),
    ((("2024-01-05", "2024-01-06"), {"end_inclusive": False}), (datetime(2024, 1, 5), datetime(2024, 1, 6))),
])
def test_window_bounds(args, bounds):
    (start, end), options = args
    assert timewindow.window_bounds(start, end, **options) == bounds


def test_presets():
    assert timewindow.preset_window("30d", NOW) == (NOW - timedelta(days=30), NOW)
    assert timewindow.preset_window("all", NOW)[0] == datetime(2020, 1, 1)
    assert timewindow.preset_window("whatever", NOW)[0] == datetime(2020, 1, 1)


def test_window_reaches_the_scan_and_the_partitions(spark, tmp_path):
    path = str(tmp_path / "log")
    rows = spark.range(48).select((F.lit("2024-01-01 00:00:00").cast("timestamp") + F.expr("make_dt_interval(0, CAST(id AS INT))")).alias("closed_at"))
    rows.withColumn("date", F.to_date("closed_at")).write.partitionBy("date").parquet(path)
    got = timewindow.date_window(spark.read.parquet(path), "closed_at", "2024-01-02", "2024-01-02")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(closed_at" in plan and "PartitionFilters: [isnotnull(date" in plan
    assert got.count() == 24


def test_instants_in_many_forms(spark):
    texts = ["2024-01-31T10:00:00Z", "2024-01-31 10:00:00", "1706695200", "1706695200000", "nonsense", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    out = [r[0] for r in df.select(timewindow.iso_z(timewindow.parse_instant(F.col("t")))).collect()]
    assert out == ["2024-01-31T10:00:00Z"] * 4 + [None, None]
    days = df.select(timewindow.parse_day(F.col("t"))).collect()
    assert [str(r[0]) for r in days[:2]] == ["2024-01-31"] * 2
