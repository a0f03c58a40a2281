from datetime import date

import pytest

from ledgertide import schemas
from ledgertide.operators import conditional_merge, insert_missing, upsert
from ledgertide.operators.upsert import read_table, stored_buckets
from pyspark.sql import functions as F

SCHEMA = schemas._struct(id=schemas._S, d=schemas._D, v=schemas._L, o=schemas._L)
D1, D2, D3 = date(2024, 1, 1), date(2024, 1, 2), date(2024, 1, 3)


def rows(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def content(spark, path):
    return sorted((r["id"] or "", str(r["d"]), r["v"]) for r in read_table(spark, path, SCHEMA).collect())


@pytest.mark.parametrize("part", ["d", None])
def test_insert_then_update_and_repeat(spark, tmp_path, part):
    path = str(tmp_path / "t")
    first = upsert(spark, path, rows(spark, [("a", D1, 1, 1), ("a", D1, 2, 2), ("b", D2, 3, 1)]), SCHEMA, ["id"], ["o"], part)
    assert first == {"inserted": 2, "updated": 0, "stale": 0}
    second = rows(spark, [("b", D2, 9, 1), ("c", D3, 4, 1)])
    assert upsert(spark, path, second, SCHEMA, ["id"], ["o"], part) == {"inserted": 1, "updated": 1, "stale": 0}
    once = content(spark, path)
    assert once == [("a", str(D1), 2), ("b", str(D2), 9), ("c", str(D3), 4)]
    assert upsert(spark, path, second, SCHEMA, ["id"], ["o"], part) == {"inserted": 0, "updated": 2, "stale": 0}
    assert content(spark, path) == once
    assert not [p.name for p in (tmp_path / "t").iterdir() if p.name.startswith(("_stage", ".spark-staging"))]


def test_a_one_row_batch_rewrites_one_bucket(spark, tmp_path):
    path = tmp_path / "t"
    many = rows(spark, [(f"k{i}", d, i, 1) for i in range(200) for d in (D1, D2)])
    upsert(spark, str(path), many, SCHEMA, ["id", "d"], ["o"], "d", buckets=8)
    assert stored_buckets(spark, str(path)) == 8

    def files():
        return {p.parent.relative_to(path).as_posix(): p.name for p in path.rglob("*.parquet")}

    before = files()
    assert len(before) == 16
    # another number of buckets does not count once the table is there
    counts = upsert(spark, str(path), rows(spark, [("k7", D2, 99, 1)]), SCHEMA, ["id", "d"], ["o"], "d", buckets=3)
    assert counts == {"inserted": 0, "updated": 1, "stale": 0}
    assert sum(files()[place] != name for place, name in before.items()) == 1 and len(files()) == 16
    assert len(content(spark, str(path))) == 400 and ("k7", str(D2), 99) in content(spark, str(path))


def test_a_failed_write_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    upsert(spark, path, rows(spark, [("a", D1, 1, 1)]), SCHEMA, ["id"], ["o"])
    bad = rows(spark, [("b", D1, 2, 1)]).withColumn("v", F.raise_error(F.col("id")).cast("bigint"))
    with pytest.raises(Exception, match="b"):
        upsert(spark, path, bad, SCHEMA, ["id"], ["o"])
    assert content(spark, path) == [("a", str(D1), 1)]
    assert upsert(spark, path, rows(spark, []), SCHEMA, ["id"], ["o"]) == {"inserted": 0, "updated": 0, "stale": 0}


def test_many_touched_places_fall_back_to_their_days(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    data = [(f"k{i}", d, i, 1) for i in range(40) for d in (D1, D2, None)]
    upsert(spark, path, rows(spark, data), SCHEMA, ["id", "d"], ["o"], "d", buckets=4)
    monkeypatch.setitem(upsert.__globals__, "MOST_PAIRS", 1)
    change = rows(spark, [("k1", D1, 100, 1), ("k2", None, 101, 1), ("new", D3, 1, 1)])
    assert upsert(spark, path, change, SCHEMA, ["id", "d"], ["o"], "d") == {"inserted": 1, "updated": 2, "stale": 0}
    assert len(content(spark, path)) == 121


def test_only_touched_days_are_rewritten(spark, tmp_path):
    path = tmp_path / "t"
    upsert(spark, str(path), rows(spark, [("a", D1, 1, 1), ("b", D2, 2, 1)]), SCHEMA, ["id"], ["o"], "d")
    before = {p.name for p in (path / f"d={D1}").rglob("*.parquet")}
    upsert(spark, str(path), rows(spark, [("b", D2, 5, 1)]), SCHEMA, ["id"], ["o"], "d")
    assert {p.name for p in (path / f"d={D1}").rglob("*.parquet")} == before and before


def test_key_that_moves_to_another_day(spark, tmp_path):
    path = str(tmp_path / "t")
    upsert(spark, path, rows(spark, [("a", D1, 1, 1), ("b", D2, 2, 1)]), SCHEMA, ["id"], ["o"], "d")
    upsert(spark, path, rows(spark, [("a", D3, 7, 2)]), SCHEMA, ["id"], ["o"], "d", key_fixes_partition=False)
    assert content(spark, path) == [("a", str(D3), 7), ("b", str(D2), 2)]


def test_guard_keeps_the_newer_row(spark, tmp_path):
    path = str(tmp_path / "t")
    upsert(spark, path, rows(spark, [("a", D1, 1, 10)]), SCHEMA, ["id"], ["o"], "d")
    counts = upsert(spark, path, rows(spark, [("a", D1, 2, 5)]), SCHEMA, ["id"], ["o"], "d", guard="o")
    assert counts["stale"] == 1 and content(spark, path) == [("a", str(D1), 1)]


def test_null_keys_match_each_other(spark, tmp_path):
    path = str(tmp_path / "t")
    for v in (1, 2):
        upsert(spark, path, rows(spark, [(None, D1, v, v)]), SCHEMA, ["id", "d"], ["o"], "d")
    assert content(spark, path) == [("", str(D1), 2)]


def test_insert_missing_leaves_stored_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    upsert(spark, path, rows(spark, [("a", D1, 1, 1)]), SCHEMA, ["id", "d"], ["o"], "d")
    insert_missing(spark, path, rows(spark, [("a", D1, 8, 1), ("a", D2, 9, 1)]), SCHEMA, ["id", "d"], ["o"], "d")
    assert content(spark, path) == [("a", str(D1), 1), ("a", str(D2), 9)]


def test_conditional_merge_keeps_known_names(spark):
    old = spark.createDataFrame([("a", "AAA", "Alpha", "x"), ("c", "CCC", "Gamma", "y")], "k string, s string, n string, extra string")
    new = spark.createDataFrame([("a", "UNKNOWN", "a", "z"), ("b", "UNKNOWN", "b", "z")], "k string, s string, n string, extra string")
    out = conditional_merge(old, new, ["k"], {"s": F.col("new.s") != "UNKNOWN", "n": F.col("new.n") != F.col("new.k")})
    assert sorted(tuple(r) for r in out.collect()) == [
        ("a", "AAA", "Alpha", "x"), ("b", "UNKNOWN", "b", "z"), ("c", "CCC", "Gamma", "y")]
