"""Pool and token dimensions derived from the facts."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.upsert import conditional_merge

UNKNOWN = "UNKNOWN"


def pool_rows(tracked: DataFrame) -> DataFrame:
    """Tracked pools → rows of the pool dimension."""
    return tracked.select(
        "pool_id", "name", F.substring("name", 1, 20).alias("short_name"),
        F.when(F.upper("version") == "V1", "v1").otherwise("v2").alias("version"), F.lit(True).alias("is_active"))


def merge_pools(existing: DataFrame, tracked: DataFrame) -> DataFrame:
    """New pools are added active; known ones get name, short name and version."""
    return conditional_merge(existing, pool_rows(tracked), ["pool_id"],
                             {"name": None, "short_name": None, "version": None})


def discovered_assets(tables: Sequence[DataFrame]) -> DataFrame:
    """Distinct asset addresses over several fact tables, each made distinct first."""
    parts = [
        t.select("asset_address").filter(F.col("asset_address").isNotNull()).distinct() for t in tables]
    return reduce(DataFrame.unionByName, parts).distinct()


def token_rows(assets: DataFrame, metadata: DataFrame, native: tuple[str, str, str] | None = None) -> DataFrame:
    """Assets with landed metadata ``(asset_address, symbol, name, decimals)`` or defaults.

    ``native``: (address, symbol, name) of the chain's own token.
    """
    m = metadata.select("asset_address", F.col("symbol").alias("m_symbol"), F.col("name").alias("m_name"),
                        F.col("decimals").alias("m_decimals"))

    def given(c: str):
        return F.when(F.col(c) != "", F.col(c))

    address, symbol, name = native or (None, None, None)
    is_native = F.coalesce(F.col("asset_address") == F.lit(address), F.lit(False))
    return assets.join(m, "asset_address", "left").select(
        "asset_address",
        F.when(is_native, F.lit(symbol)).otherwise(F.coalesce(given("m_symbol"), F.lit(UNKNOWN))).alias("symbol"),
        F.when(is_native, F.lit(name)).otherwise(
            F.coalesce(given("m_name"), given("m_symbol"), F.substring("asset_address", 1, 8))).alias("name"),
        F.when(is_native, F.lit(7)).otherwise(F.coalesce("m_decimals", F.lit(7))).cast("int").alias("decimals"),
        is_native.alias("is_native"))


def merge_tokens(existing: DataFrame, rows: DataFrame) -> DataFrame:
    """Placeholders never replace a known symbol or name."""
    return conditional_merge(existing, rows, ["asset_address"], {
        "symbol": F.col("new.symbol") != UNKNOWN,
        "name": F.col("new.name") != F.substring(F.col("new.asset_address"), 1, 8),
        "decimals": None, "is_native": None})


def new_and_known(existing: DataFrame, assets: DataFrame) -> DataFrame:
    """How many discovered assets are new and how many are known already."""
    known = assets.join(existing.select("asset_address").withColumn("_known", F.lit(True)), "asset_address", "left")
    return known.agg(
        F.count_if(F.col("_known").isNull()).alias("inserted"), F.count_if("_known").alias("updated"))
