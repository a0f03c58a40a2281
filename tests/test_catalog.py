"""Every registered query: same rows as its SQL twin, and no quadratic or single-task step."""

import duckdb
import pytest

from ledgertide.catalog import load_queries
from tests.conftest import SF
from tools.check_oracles import TABLES, rows_of

QUERIES, ORACLES = load_queries()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_twin(spark, duck, name):
    df = QUERIES[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    mine, names = rows_of(df.columns, df.collect())
    result = duck.execute(ORACLES[name])
    theirs, their_names = rows_of([d[0] for d in result.description], result.fetchall())
    assert names == their_names
    assert mine == theirs


def test_flagship_entry(spark):
    import __spark_entry__ as contract

    assert contract.entry(spark).count() == 1
    assert set(QUERIES) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())
