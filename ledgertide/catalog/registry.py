"""Registration of queries with their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .adapters import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    """Register ``fn(tables)`` under its name; ``sql`` is the twin DuckDB runs."""
    def register(fn: Callable[[Tables], DataFrame]):
        key = name or fn.__name__

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return fn(Tables(spark, sf_dir))

        QUERIES[key] = run
        if sql is not None:
            ORACLES[key] = sql
        return fn

    return register
