"""Real-time state pipeline: configuration, then rates, then positions.

The three phases run in this order inside every micro-batch, because positions
need the mapping and the rates of the same batch.  Each phase is a keyed write,
so a replayed batch leaves the tables as they are, and its counters.

A position whose reserve has no mapping yet is kept (``pending_positions``) and
tried again in every later batch, until its configuration arrives.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.jsonvalues import scalar_text
from ..operators.asof import asof_join
from ..operators.dedup import dedup_last, latest_per
from ..plans import decode
from ..sources.ledger import split_state_batches
from .tables import TableStore, fingerprint, start


def current_mapping(config_state: DataFrame) -> DataFrame:
    """Pool, index → asset that is valid after all configuration entries seen.

    An entry counts unless its asset was deleted at a later ledger; of several
    assets at one index the latest counts.  The result does not depend on the
    order in which the entries arrived.
    """
    removed = config_state.filter("deleted").groupBy("pool_id", "asset_address").agg(
        F.max("ledger_sequence").alias("_removed_at"))
    live = config_state.filter("not deleted").join(removed, ["pool_id", "asset_address"], "left").filter(
        F.col("_removed_at").isNull() | (F.col("ledger_sequence") > F.col("_removed_at")))
    return latest_per(live, ["pool_id", "reserve_index"], ["ledger_sequence", "asset_address"], ["asset_address"])


def split_mapped(held: DataFrame, mapping: DataFrame, hold=lambda mapped: mapped) -> tuple[DataFrame, DataFrame]:
    """Decoded positions → ``(rows with their asset, rows whose index has none)``; ``hold`` may persist what both come from."""
    mapped = hold(held.join(mapping, ["pool_id", "reserve_index"], "left"))
    return mapped.filter(F.col("asset_address").isNotNull()), mapped.filter(F.col("asset_address").isNull()).drop("asset_address")


def unmapped_rejects(unmapped: DataFrame) -> DataFrame:
    return unmapped.select(
        F.concat(F.lit("no asset mapping for reserve index "), F.col("reserve_index").cast("string"))
        .alias("reject_reason"), "pool_id", "user_address", "ledger_sequence")


_RESERVE, _RATES = ["pool_id", "asset_address"], ["b_rate", "d_rate"]


def with_rates(store: TableStore, known: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(positions with the rates valid at their ledger, frame to unpersist)``.

    A position at or after its reserve's newest rate takes that rate, from a table
    of one row per reserve. Only for earlier ones are stored snapshots read: those
    of their days, then of ever more days before, until each has found a rate or
    no older day is left.
    """
    store.rebuild_current_rates()
    current = store.read("current_rates").select(*_RESERVE, F.col("ledger_sequence").alias("_newest"),
                                                 *[F.col(c).alias(f"_{c}") for c in _RATES])
    tagged = known.join(current, _RESERVE, "left").persist()
    is_late = F.coalesce(F.col("ledger_sequence") < F.col("_newest"), F.lit(False))
    fresh = tagged.filter(~is_late).select(*known.columns, *[F.col(f"_{c}").alias(c) for c in _RATES])
    late = tagged.filter(is_late).select(*known.columns)
    low, high = late.agg(F.min("snapshot_date"), F.max("snapshot_date")).first()
    if low is None:
        return fresh, tagged
    snapshots = store.read("pool_snapshots")
    oldest, back = snapshots.agg(F.min("snapshot_date")).first()[0], 1
    while True:
        rates = snapshots.filter(F.col("snapshot_date").between(F.lit(low), F.lit(high))).select(
            *_RESERVE, F.col("ledger_sequence").alias("_rate_ledger"), *_RATES, F.lit(True).alias("_found"))
        rated = asof_join(late, rates, _RESERVE, "ledger_sequence", "_rate_ledger", [*_RATES, "_found"])
        if oldest is None or low <= oldest or rated.filter(F.col("_found").isNull()).isEmpty():
            return fresh.unionByName(rated.drop("_found")), tagged
        low, back = max(oldest, low - dt.timedelta(days=back)), back * 4


def keyed(entries: DataFrame) -> DataFrame:
    """Entries with what their key says as columns, as stored logs have them, so that each key is parsed once."""
    found = entries.withColumns({"entry_type": F.get_json_object("key_decoded", "$.vec[0].symbol"),
                                 "_address": F.get_json_object("key_decoded", "$.vec[1].address")})
    return found.withColumns({"key_address": scalar_text(F.col("_address")), "_addressed": F.col("_address").isNotNull()}).drop("_address")


def unreadable(entries: DataFrame) -> DataFrame:
    """Entries of a known kind that lack an address, a value or a readable close time."""
    if "_addressed" not in entries.columns:
        entries = keyed(entries)
    has_map = F.get_json_object("val_decoded", "$.map").isNotNull()
    known = entries.filter(F.col("entry_type").isin(*decode.STATE_KINDS))
    bad = known.filter(~F.col("_addressed") | (~F.col("deleted") & ~F.coalesce(has_map, F.lit(False)))
                       | F.col("closed_at").isNull())
    return bad.select(
        F.concat(F.lit("unreadable entry of kind "), F.col("entry_type")).alias("reject_reason"),
        F.col("contract_id").alias("pool_id"), F.lit(None).cast("string").alias("user_address"), "ledger_sequence")


def state_batch_handler(store: TableStore):
    def handle(payloads: DataFrame, batch_id: int) -> None:
        held_frames = []

        def hold(frame: DataFrame) -> DataFrame:
            held_frames.append(frame.persist())
            return held_frames[-1]

        try:
            # What is decoded and read several times is held; the payloads are read twice, here and for the fingerprint.
            parts, malformed = split_state_batches(payloads)
            entries = hold(keyed(parts).drop("key_decoded"))
            readable = entries.filter(F.col("_addressed") & F.col("closed_at").isNotNull())

            config = hold(decode.decode_reserve_config(readable).filter(F.col("reserve_index").isNotNull()))
            configs = store.upsert("reserve_config_state", config, guard="ledger_sequence")

            rates = decode.decode_reserve_state(readable, mode="key", null_rate_as_zero=True)
            last = hold(dedup_last(rates, ["pool_id", "asset_address", "snapshot_date"],
                                   ["ledger_sequence", "snapshot_timestamp"]))
            pools = store.upsert("pool_snapshots", last, guard="ledger_sequence")

            mapping = current_mapping(store.read("reserve_config_state"))
            held = decode.decode_positions(readable, mode="key").withColumn("snapshot_date", F.to_date("snapshot_timestamp"))
            waiting = store.read("pending_positions").filter(~F.col("resolved")).drop("resolved")
            known, unmapped = split_mapped(held, mapping, hold)
            freed, _ = split_mapped(waiting, mapping)
            found = decode.with_position_amounts(known.unionByName(freed).drop("reserve_index"))
            positions, tagged = with_rates(store, found)
            held_frames.append(tagged)
            users = store.upsert("user_positions", positions, order_cols=("snapshot_timestamp", "entry_hash"))
            tagged.unpersist()
            # After the positions: a batch that stops in between tries the waiting ones again.
            store.upsert("pending_positions", unmapped.withColumn("resolved", F.lit(False)).unionByName(
                freed.drop("asset_address").withColumn("resolved", F.lit(True))), order_cols=("resolved",))

            content, without_events = fingerprint(payloads, F.col("events").isNull())
            rejects = unmapped_rejects(unmapped).unionByName(unreadable(entries))
            if without_events:
                rejects = rejects.unionByName(malformed.select("reject_reason"), allowMissingColumns=True)
            store.write_batch("state_rejects", batch_id, rejects)
            kind = F.col("entry_type")
            counters = entries.agg(
                F.count("*").alias("events_received"), F.count_if(kind == "ResConfig").alias("configs_processed"),
                F.count_if(kind == "ResData").alias("pools_processed"),
                F.count_if(kind == "Positions").alias("positions_processed"),
            ).withColumns({
                "configs_changed": F.lit(configs["inserted"] + configs["updated"]),
                "pools_inserted": F.lit(pools["inserted"]), "pools_updated": F.lit(pools["updated"]),
                "positions_inserted": F.lit(users["inserted"]), "positions_updated": F.lit(users["updated"]),
            })
            store.write_batch("state_metrics", batch_id, counters, content)
        finally:
            for frame in held_frames:
                frame.unpersist()

    return handle


def run_state_stream(payloads: DataFrame, store: TableStore, checkpoint: str, available_now: bool = False,
                     processing_time: str | None = None):
    return start(payloads, state_batch_handler(store), checkpoint, available_now, processing_time)
