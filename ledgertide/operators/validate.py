"""Row validation with reject reasons."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.timewindow import parse_instant
from ..functions.wellformed import blank


@dataclass(frozen=True)
class Rule:
    """A row is rejected with ``reason`` where ``bad`` is true."""

    reason: str
    bad: Column


def tag(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Adds ``reject_reason``: the first rule a row breaks, NULL for a valid row."""
    reason = F.coalesce(*[F.when(F.coalesce(r.bad, F.lit(False)), F.lit(r.reason)) for r in rules])
    return df.withColumn("reject_reason", reason)


def validate(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """``(valid rows, rejects with reject_reason)``; both are lazy views of ``df``."""
    tagged = tag(df, rules)
    return (
        tagged.filter(F.col("reject_reason").isNull()).drop("reject_reason"),
        tagged.filter(F.col("reject_reason").isNotNull()),
    )


def required(*columns: str, reason: str | None = None) -> Rule:
    bad = blank(F.col(columns[0]))
    for c in columns[1:]:
        bad = bad | blank(F.col(c))
    return Rule(reason or f"missing {', '.join(columns)}", bad)


def numeric_text(column: str) -> Rule:
    """Text that is present but is no number, or needs more than 38 digits."""
    c = F.col(column)
    return Rule(f"{column} is not a 38-digit number", ~blank(c) & c.cast("string").try_cast("decimal(38,0)").isNull())


def typed_text(column: str, kind: T.DataType) -> Rule:
    """Text that is present but is no value of the column's type; a whole number may not lose a fraction."""
    c = F.col(column)
    if isinstance(kind, T.TimestampType):
        bad = parse_instant(c).isNull()
    else:
        bad = c.try_cast(kind).isNull()
        if isinstance(kind, T.IntegralType) or isinstance(kind, T.DecimalType) and kind.scale == 0:
            bad = bad | ~c.rlike(r"^[+-]?\d+$")
    return Rule(f"{column} is no {kind.simpleString()}", ~blank(c) & bad)


POSITION_RULES = lambda: [  # noqa: E731 - columns need a live session
    required("pool_id", "user_address", "asset_address"),
    required("snapshot_date"),
]
SNAPSHOT_RULES = lambda: [
    required("pool_id", "asset_address"),
    required("snapshot_date"),
    Rule("invalid rate values", F.col("b_rate").isNull() | F.col("d_rate").isNull()),
]
ACTION_RULES = lambda: [required("id", "pool_id", "action_type")]
BACKSTOP_RULES = lambda: [required("id", "action_type")]
BALANCE_RULES = lambda: [required("pool_address")]
