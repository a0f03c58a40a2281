"""Real-time event pipeline: one stream of contract events into both event tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import SRC_STREAM
from ..plans import decode
from ..plans.events import typed_actions, typed_backstop
from ..sources.ledger import normalise_close_time
from .tables import TableStore, fingerprint, start

_STREAM_COLUMNS = {"topics": "topics", "data": "data", "closed_at": "ledger_closed_at"}


def split_and_decode(batch: DataFrame, pools: Sequence[str] | None, backstop_contract: str | None):
    """One batch of raw events → (decoded lending rows, decoded backstop rows)."""
    batch = normalise_close_time(batch)
    lending = decode.lending_events(batch, pools, "topics")
    backstop = decode.backstop_events(batch, backstop_contract, "topics")
    return decode.decode_actions(lending, **_STREAM_COLUMNS), decode.decode_backstop(backstop, **_STREAM_COLUMNS)


def event_batch_handler(store: TableStore, pools: Sequence[str] | None, backstop_contract: str | None):
    """Decode, upsert by content identity, keep rejects and counters.

    Identity comes from the content, so replaying a batch changes nothing.
    """
    def handle(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        lending, backstop = (d.persist() for d in split_and_decode(batch, pools, backstop_contract))
        try:
            actions, bad_actions = typed_actions(lending, SRC_STREAM)
            events, bad_events = typed_backstop(backstop, SRC_STREAM)
            a = store.upsert("parsed_events", actions)
            b = store.upsert("backstop_events", events)
            rejects = bad_actions.select("id", "reject_reason", F.lit("parsed_events").alias("table")).unionByName(
                bad_events.select("id", "reject_reason", F.lit("backstop_events").alias("table")))
            store.write_batch("rejects", batch_id, rejects)
            content, received = fingerprint(batch, F.lit(True))
            counters = store.spark.range(1).select(
                F.lit(received).cast("bigint").alias("events_received"), F.lit(a["inserted"]).alias("actions_inserted"),
                F.lit(a["updated"]).alias("actions_updated"), F.lit(b["inserted"]).alias("backstop_inserted"),
                F.lit(b["updated"]).alias("backstop_updated"))
            store.write_batch("metrics", batch_id, counters, content)
        finally:
            for held in (lending, backstop, batch):
                held.unpersist()

    return handle


def run_event_stream(stream: DataFrame, store: TableStore, checkpoint: str, pools: Sequence[str] | None = None,
                     backstop_contract: str | None = None, available_now: bool = False,
                     processing_time: str | None = None):
    return start(stream, event_batch_handler(store, pools, backstop_contract), checkpoint, available_now,
                 processing_time)


def deduplicated(stream: DataFrame, time_col: str = "ledger_closed_at", lateness: str = "1 day") -> DataFrame:
    """Drop repeated ids within a lateness bound (state is dropped beyond it)."""
    return stream.withWatermark(time_col, lateness).dropDuplicatesWithinWatermark(["id"])


def daily_action_counts(stream: DataFrame, time_col: str = "ledger_closed_at", lateness: str = "1 day") -> DataFrame:
    """Events per action and day over a stream."""
    windowed = stream.withWatermark(time_col, lateness).groupBy(F.window(time_col, "1 day"), "action_type").agg(
        F.count("*").alias("n"))
    return windowed.select(F.col("window.start").alias("day_start"), "action_type", "n")
