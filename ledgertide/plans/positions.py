"""Position changes from the state log, with and without as-of rates.

The queries with rates decode the positions once into a scratch table, because
the as-of join reads its left side twice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import RESERVE_DATA
from ..functions.timewindow import date_window, ledger_range, window_bounds, between
from ..operators.asof import asof_join
from ..session import cut
from . import decode

_RATES = ["b_rate", "d_rate"]


def _window(state: DataFrame, opts: dict) -> DataFrame:
    state = date_window(
        state, "closed_at", opts.get("start_date"), opts.get("end_date"), days_back=opts.get("days_back", 90),
        now=opts.get("now"), lookback_from_end=opts.get("lookback_from_end", True))
    return state


def _changes(state: DataFrame, opts: dict, mode: str) -> DataFrame:
    rows = ledger_range(_window(state, opts), opts.get("start_ledger"), opts.get("end_ledger"))
    if opts.get("user") and "key_address" in rows.columns:
        rows = rows.filter(F.col("key_address") == opts["user"])  # a stored column, so it reaches the scan
    rows = decode.decode_positions(rows, mode)
    if opts.get("user"):
        rows = rows.filter(F.col("user_address") == opts["user"])
    return rows


def _finish(rows: DataFrame) -> DataFrame:
    return decode.with_position_amounts(rows).withColumn("snapshot_date", F.to_date("snapshot_timestamp"))


def rate_points(state: DataFrame, opts: dict, mode: str) -> DataFrame:
    return decode.decode_reserve_state(_window(state, opts), mode).select(
        "pool_id", "asset_address", F.col("ledger_sequence").alias("rate_ledger"), *_RATES)


def asset_position_changes(state: DataFrame, pool_id: str, asset_address: str, reserve_index: int,
                           mode: str = "key", **opts) -> DataFrame:
    """Changes of one reserve of one pool with the rates valid at each change.

    Empty unless the pool has reserve data of that asset in the window widened by
    30 days: an uncorrelated EXISTS, evaluated once.
    """
    pool = state.filter(F.col("contract_id") == pool_id)
    low, _ = window_bounds(opts.get("start_date"), opts.get("end_date"), days_back=opts.get("days_back", 90),
                           widen_days=30, now=opts.get("now"))
    verified = decode.entries_of(between(pool, "closed_at", low, None), RESERVE_DATA).filter(
        F.col("key_address") == asset_address)
    changes = _changes(pool, opts, mode).filter(F.col("reserve_index") == reserve_index).where(verified.exists())
    rates = rate_points(pool, opts, mode).filter(F.col("asset_address") == asset_address)
    rows = cut(_finish(changes.distinct().withColumn("asset_address", F.lit(asset_address))), "position-changes")
    return asof_join(rows, rates, [], "ledger_sequence", "rate_ledger", _RATES)


def pool_position_changes(state: DataFrame, pool_id: str, mode: str = "key", **opts) -> DataFrame:
    """Changes of all reserves of one pool that hold an amount (rates not looked up)."""
    return all_assets_changes(state.filter(F.col("contract_id") == pool_id), mode, **opts)


def with_asset_then(changes: DataFrame, spans: DataFrame) -> DataFrame:
    """Each change once, with the asset that held its reserve index at its ledger (NULL: none did).

    An as-of join on the spans' starts, then a look at the end: an index that
    changed hands any number of times neither repeats a change nor takes a later
    asset. ``changes`` is read twice.
    """
    found = asof_join(changes, spans, ["pool_id", "reserve_index"], "ledger_sequence", "from_ledger",
                      ["asset_address", "until_ledger"])
    ended = F.coalesce(F.col("until_ledger") <= F.col("ledger_sequence"), F.lit(False))
    return found.withColumn("asset_address", F.when(~ended, F.col("asset_address"))).drop("until_ledger")


def all_assets_changes(state: DataFrame, mode: str = "key", then_valid: bool = False, **opts) -> DataFrame:
    """Long form over the given pools; an index without a mapping keeps a NULL asset.

    The asset is the one that holds the index now, with ``then_valid`` the one
    that held it at the change's ledger.
    """
    changes = decode.has_amount(_changes(state, opts, mode))
    if then_valid:
        spans = cut(decode.reserve_validity(state, mode), "reserve-validity")
        return _finish(with_asset_then(cut(changes, "position-changes"), spans))
    mapping = decode.reserve_mapping(state, mode, latest_only=True)
    return _finish(changes.join(mapping, ["pool_id", "reserve_index"], "left"))


def position_changes_with_rates(state: DataFrame, pools: Sequence[str] | None = None, mode: str = "key",
                                then_valid: bool = False, **opts) -> DataFrame:
    """Changes of all reserves of all pools, each with the rates valid at its ledger.

    A change comes out for every asset that its index ever stood for, with
    ``then_valid`` only for the one that held the index at its ledger.
    """
    if pools is not None:
        state = state.filter(F.col("contract_id").isin(list(pools)))
    changes = _changes(state, opts, mode)
    if then_valid:
        spans = cut(decode.reserve_validity(state, mode), "reserve-validity")
        mapped = with_asset_then(cut(changes, "raw-changes"), spans).filter(F.col("asset_address").isNotNull())
    else:
        mapped = changes.join(decode.reserve_mapping(state, mode), ["pool_id", "reserve_index"])
    mapped = mapped.drop("reserve_index")
    rows = cut(_finish(mapped.distinct()), "position-changes")
    return asof_join(rows, rate_points(state, opts, mode), ["pool_id", "asset_address"], "ledger_sequence",
                     "rate_ledger", _RATES)


def user_position_changes(state: DataFrame, user: str, pool_id: str | None = None,
                          asset_address: str | None = None, mode: str = "key", **opts) -> DataFrame:
    """One user's changes over all (or one) of the assets, in a single scan."""
    if pool_id is not None:
        state = state.filter(F.col("contract_id") == pool_id)
    rows = all_assets_changes(state, mode, user=user, **opts)
    return rows.filter(F.col("asset_address") == asset_address) if asset_address is not None else rows
