"""User balances at a date and as gap-filled daily history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.fill import forward_fill

_HELD = ["snapshot_timestamp", "ledger_sequence", "supply_btokens", "collateral_btokens", "liabilities_dtokens",
         "entry_hash", "ledger_entry_change"]


def with_balances(df: DataFrame, b_rate: Column, d_rate: Column) -> DataFrame:
    """Token amounts at the given rates: supply, collateral, debt and their net."""
    s, c, d = (F.col(x).cast("double") for x in ("supply_btokens", "collateral_btokens", "liabilities_dtokens"))
    b, r = b_rate.cast("double"), d_rate.cast("double")
    return df.withColumns({
        "supply_balance": s * b, "collateral_balance": c * b, "debt_balance": d * r,
        "net_balance": (s + c) * b - d * r,
    })


def user_balance(positions: DataFrame, snapshots: DataFrame, user: str | None = None, asset: str | None = None,
                 date=None, global_latest: bool = True) -> DataFrame:
    """Balances on ``date`` at that day's pool rates, one row per pool.

    Without a date: on the latest day of the whole table (``global_latest``), or
    on the latest day of the selected rows.  Several changes of one day count by
    the last of them.
    """
    mine = positions
    if user is not None:
        mine = mine.filter(F.col("user_address") == user)
    if asset is not None:
        mine = mine.filter(F.col("asset_address") == asset)
    if date is not None:
        on_day = mine.filter(F.col("snapshot_date") == F.lit(date).cast("date"))
    else:
        newest = (positions if global_latest else mine).agg(F.max("snapshot_date").alias("d")).scalar()
        on_day = mine.filter(F.col("snapshot_date") == newest)
    keys = ["pool_id", "user_address", "asset_address", "snapshot_date"]
    order = F.struct("ledger_sequence", *[c for c in _HELD if c != "ledger_sequence"])
    last = on_day.groupBy(*keys).agg(F.max_by(F.struct(*_HELD), order).alias("_v")).select(*keys, "_v.*")
    rates = snapshots.select("pool_id", "asset_address", "snapshot_date", "b_rate", "d_rate")
    joined = last.join(rates, ["pool_id", "asset_address", "snapshot_date"])
    return with_balances(joined, F.col("b_rate"), F.col("d_rate"))


def balance_history(positions: DataFrame, snapshots: DataFrame, start, end, user: str | None = None,
                    asset: str | None = None) -> DataFrame:
    """Balance of every user, asset and pool on every day from its first position on.

    The position held on a day is the last one on or before it; its own rates
    count only on the very day of the change, otherwise the last pool rates on or
    before the day, otherwise 1.  Positions and rates are both filled to days
    independently and meet in one equi-join.
    """
    if user is not None:
        positions = positions.filter(F.col("user_address") == user)
    if asset is not None:
        positions = positions.filter(F.col("asset_address") == asset)
        snapshots = snapshots.filter(F.col("asset_address") == asset)
    values = [*_HELD, "b_rate", "d_rate"]
    held = forward_fill(
        positions, ["pool_id", "user_address", "asset_address"], "snapshot_date", values, start, end,
        order_cols=["ledger_sequence", *[v for v in values if v != "ledger_sequence"]],
    ).withColumnsRenamed({"b_rate": "position_b_rate", "d_rate": "position_d_rate", "fact_date": "position_date"})
    rates = forward_fill(
        snapshots, ["pool_id", "asset_address"], "snapshot_date", ["b_rate", "d_rate"], start, end,
        order_cols=["ledger_sequence", "b_rate", "d_rate"],
    ).drop("fact_date").withColumnsRenamed({"b_rate": "snapshot_b_rate", "d_rate": "snapshot_d_rate"})
    joined = held.join(rates, ["pool_id", "asset_address", "day"], "left")

    def chosen(side: str) -> Column:
        own, pool = F.col(f"position_{side}_rate").cast("double"), F.col(f"snapshot_{side}_rate").cast("double")
        same_day = F.col("position_date") == F.col("day")
        return F.when(same_day, F.coalesce(own, pool, F.lit(1.0))).otherwise(F.coalesce(pool, F.lit(1.0)))

    rated = joined.withColumns({"b_rate": chosen("b"), "d_rate": chosen("d")})
    return with_balances(rated, F.col("b_rate"), F.col("d_rate")).withColumnRenamed("day", "snapshot_date")
