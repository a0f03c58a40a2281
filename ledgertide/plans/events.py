"""Event tables from raw contract events (historical backfill)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..constants import SRC_BACKFILL, SRC_STREAM
from ..functions.timewindow import ledger_range, optional_window
from ..operators.dedup import dedup_first
from ..operators.validate import ACTION_RULES, BACKSTOP_RULES, numeric_text, typed_text, validate
from . import decode

_ACTION_NUMBERS = ("amount_underlying", "amount_tokens", "liquidation_percent", "bid_amount", "lot_amount")
_BACKSTOP_NUMBERS = ("lp_tokens", "shares", "emissions_amount", "emissions_shares")


def lending_table(
    raw: DataFrame, pools: Sequence[str] | None = None, start_date=None, end_date=None,
    start_ledger: int | None = None, end_ledger: int | None = None, limit: int | None = None,
) -> DataFrame:
    """Decoded lending events, one per content identity, oldest copy first.

    ``limit`` is the preview mode: the first rows in ledger order, nothing written.
    """
    raw = _window(raw, start_date, end_date, start_ledger, end_ledger)
    rows = dedup_first(decode.decode_actions(decode.lending_events(raw, pools)), ["id"], ["ledger_closed_at"])
    return _preview(rows, limit)


def backstop_table(
    raw: DataFrame, contract: str | None = None, start_date=None, end_date=None,
    start_ledger: int | None = None, end_ledger: int | None = None, limit: int | None = None,
) -> DataFrame:
    raw = _window(raw, start_date, end_date, start_ledger, end_ledger)
    rows = dedup_first(decode.decode_backstop(decode.backstop_events(raw, contract)), ["id"], ["ledger_closed_at"])
    return _preview(rows, limit)


def _window(raw, start_date, end_date, start_ledger, end_ledger) -> DataFrame:
    raw = optional_window(raw, "closed_at", start_date, end_date, end_inclusive=True)
    return ledger_range(raw, start_ledger, end_ledger)


def _preview(rows: DataFrame, limit: int | None) -> DataFrame:
    if limit is None:
        return rows
    return rows.orderBy("ledger_sequence", "transaction_hash", "id").limit(limit)


def typed_actions(rows: DataFrame, src: str = SRC_BACKFILL) -> tuple[DataFrame, DataFrame]:
    """Decoded texts → ``(rows of parsed_events, rejects)``; too wide numbers are rejected."""
    rules = ACTION_RULES() + [numeric_text(c) for c in _ACTION_NUMBERS] + [typed_text("auction_type", T.IntegerType())]
    valid, rejects = validate(rows, rules)
    return schemas.conform(valid.withColumn("src", F.lit(src)), schemas.PARSED_EVENTS), rejects


def typed_backstop(rows: DataFrame, src: str = SRC_BACKFILL) -> tuple[DataFrame, DataFrame]:
    rules = BACKSTOP_RULES() + [numeric_text(c) for c in _BACKSTOP_NUMBERS] + [typed_text("q4w_exp", T.LongType())]
    valid, rejects = validate(rows, rules)
    return schemas.conform(valid.withColumn("src", F.lit(src)), schemas.BACKSTOP_EVENTS), rejects


def without_streamed(backfill: DataFrame, existing: DataFrame, match_cols: Sequence[str],
                     null_safe_cols: Sequence[str]) -> DataFrame:
    """Backfill rows that no streamed row equals in content (streamed rows win).

    ``match_cols`` must be equal and not NULL, ``null_safe_cols`` equal or both
    NULL.  The key holds the transaction, so no key is hot.
    """
    streamed = existing.filter(F.col("src") == SRC_STREAM)
    b, s = backfill.alias("b"), streamed.select(*match_cols, *null_safe_cols).alias("s")
    cond = F.lit(True)
    for c in match_cols:
        cond = cond & (F.col(f"b.{c}") == F.col(f"s.{c}"))
    for c in null_safe_cols:
        cond = cond & F.col(f"b.{c}").eqNullSafe(F.col(f"s.{c}"))
    return b.join(s, cond, "left_anti")


def new_actions(backfill: DataFrame, existing: DataFrame) -> DataFrame:
    return without_streamed(
        backfill, existing, ["transaction_hash", "pool_id", "action_type", "ledger_sequence"],
        ["user_address", "amount_underlying", "amount_tokens"])


def new_backstop_events(backfill: DataFrame, existing: DataFrame) -> DataFrame:
    return without_streamed(
        backfill, existing, ["transaction_hash", "action_type", "ledger_sequence"],
        ["pool_address", "user_address", "lp_tokens", "shares"])


def action_history(events: DataFrame, pools: DataFrame, tokens: DataFrame) -> DataFrame:
    """Lending events with pool and token names (the frame the exploration queries use)."""
    return (
        events
        .join(pools.select("pool_id", F.col("name").alias("pool_name")), "pool_id", "left")
        .join(tokens.select("asset_address", F.col("symbol").alias("asset_symbol"),
                            F.col("name").alias("asset_name")), "asset_address", "left")
    )
