"""Where a stream keeps its tables, and how one batch writes to them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..operators.coverage import COVERAGE
from ..operators.dedup import latest_per
from ..operators.upsert import keep_newest, overwrite_days, read_table, table_exists, upsert
from ..plans.feed import LIVE_FEED, feed_rows
from ..plans.views import PARTIALS

#: Events of a pool and source that a maintained feed holds: the most a poll can ask for.
FEED_ROWS = 500
_FEED_SOURCES = {"parsed_events": "pool", "backstop_events": "backstop"}


@dataclass(frozen=True)
class TableStore:
    """Curated tables below one root directory.

    ``buckets``: parts of a day that an upsert can rewrite alone; it counts for
    tables that are not written yet. ``derived``: start the tables that follow
    the events, a live feed and daily partials of the views; where they are
    there, every writer of the store keeps them up.
    """

    spark: SparkSession
    root: str
    buckets: int = 4
    derived: bool = False

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def schema(self, name: str) -> T.StructType:
        schema = _EXTRA.get(name) or getattr(schemas, name.upper())
        part = schemas.TABLE_PARTITIONS.get(name)
        if part and part not in schema.names:
            schema = T.StructType([*schema.fields, T.StructField(part, T.DateType())])
        return schema

    def read(self, name: str) -> DataFrame:
        return read_table(self.spark, self.path(name), self.schema(name))

    def upsert(self, name: str, rows: DataFrame, order_cols=("ledger_sequence",), guard: str | None = None,
               key_fixes_partition: bool = True) -> dict[str, int]:
        """Upsert by the table's key. Writing pool snapshots keeps the current rates up with them."""
        if name == "pool_snapshots":
            self.rebuild_current_rates()  # of a store that is older than that table
        part = schemas.TABLE_PARTITIONS.get(name)
        done = upsert(self.spark, self.path(name), self.prepared(name, rows), self.schema(name), self.keys(name), order_cols,
                      part, key_fixes_partition, guard, self.buckets if part else 1)
        if name == "pool_snapshots":
            self._raise_current_rates(rows)
        if name in _FEED_SOURCES:
            self._keep_feed(name, rows)
        if name == "parsed_events":
            self._recount_days(rows)
        return done

    def _keep_feed(self, name: str, rows: DataFrame) -> None:
        """Only what a batch brings goes into a feed that is there; a new one is made of all stored events."""
        there = self.exists("live_feed")
        if there:
            fresh = feed_rows(rows, _FEED_SOURCES[name])
        elif self.derived:
            fresh = feed_rows(self.read("parsed_events"), "pool").unionByName(feed_rows(self.read("backstop_events"), "backstop"))
        else:
            return
        keep_newest(self.spark, self.path("live_feed"), fresh, LIVE_FEED, ["source", "id"], ["pool_id", "source"],
                    [F.col("time").desc(), F.col("id")], FEED_ROWS, self.buckets)

    def _recount_days(self, rows: DataFrame) -> None:
        """Partials of the days that ``rows`` touch, from the stored events of these days alone.

        Counted anew, not added to, so that a replayed batch changes nothing. One
        value per touched day reaches the driver.
        """
        days = None
        for name, (schema, partials) in PARTIALS.items():
            events = self.read("parsed_events")
            if self.exists(name):
                if days is None:
                    days = [r[0] for r in rows.select(F.to_date("ledger_closed_at")).distinct().collect()]
                events = events.filter(F.col("event_date").isin([d for d in days if d is not None]))
            elif not self.derived:
                continue
            overwrite_days(self.spark, self.path(name), schemas.conform(partials(events), schema), "event_date")

    def rebuild_current_rates(self) -> None:
        """Derive the current rates from all snapshots, where there are snapshots but no such table."""
        if self.exists("pool_snapshots") and not self.exists("current_rates"):
            self._raise_current_rates(self.read("pool_snapshots"))

    def _raise_current_rates(self, snapshots: DataFrame) -> None:
        values = ["ledger_sequence", "b_rate", "d_rate"]
        newest = latest_per(snapshots, ["pool_id", "asset_address"], values, values)
        self.upsert("current_rates", newest, guard="ledger_sequence")

    def exists(self, name: str) -> bool:
        return table_exists(self.spark, self.path(name))

    def keys(self, name: str) -> list[str]:
        return _EXTRA_KEYS.get(name) or schemas.TABLE_KEYS[name]

    def prepared(self, name: str, rows: DataFrame) -> DataFrame:
        """Rows in the table's schema; an ``event_date`` partition comes from the close time."""
        if schemas.TABLE_PARTITIONS.get(name) == "event_date":
            rows = rows.withColumn("event_date", F.to_date("ledger_closed_at"))
        return schemas.conform(rows, self.schema(name))

    def append(self, name: str, rows: DataFrame) -> None:
        """Add rows to a table without a key."""
        schemas.conform(rows, self.schema(name)).write.mode("append").parquet(self.path(name))

    def write_batch(self, name: str, batch_id: int, rows: DataFrame, content: str | None = None) -> None:
        """Rows of one micro-batch in their own directory, which another batch of that number replaces.

        With ``content``, a fingerprint of the batch, a replay of the same batch
        leaves what is there: it would count its inserts as updates.
        """
        path = f"{self.path(name)}/batch_id={batch_id}"
        if content is not None:
            rows = rows.withColumn("batch_content", F.lit(content))
            if table_exists(self.spark, path):
                held = self.spark.read.schema("batch_content string").parquet(path).first()
                if held is not None and held.batch_content == content:
                    return
        rows.write.mode("overwrite").parquet(path)

    def read_batches(self, name: str) -> DataFrame:
        return self.spark.read.option("mergeSchema", True).parquet(self.path(name))


# Configuration entries seen so far; the index→asset mapping is derived from them.
RESERVE_CONFIG_STATE = T.StructType([
    T.StructField("pool_id", T.StringType()), T.StructField("asset_address", T.StringType()),
    T.StructField("reserve_index", T.LongType()), T.StructField("ledger_sequence", T.LongType()),
    T.StructField("deleted", T.BooleanType()),
])
# The newest rate of each reserve: all that a position of the newest ledgers needs.
CURRENT_RATES = schemas._struct(pool_id=schemas._S, asset_address=schemas._S, ledger_sequence=schemas._L,
                                b_rate=schemas.RATE, d_rate=schemas.RATE)
# Decoded positions whose reserve has no mapping yet; ``resolved`` once they are stored.
PENDING_POSITIONS = schemas._struct(
    pool_id=schemas._S, user_address=schemas._S, snapshot_timestamp=schemas._TS, ledger_sequence=schemas._L, entry_hash=schemas._S,
    ledger_entry_change=schemas._L, reserve_index=schemas._L, supply_raw=schemas._S, collateral_raw=schemas._S,
    liabilities_raw=schemas._S, snapshot_date=schemas._D, resolved=schemas._B)
_EXTRA = {"live_feed": LIVE_FEED, **{name: schema for name, (schema, _) in PARTIALS.items()}, "reserve_config_state": RESERVE_CONFIG_STATE, "coverage": COVERAGE, "current_rates": CURRENT_RATES,
          "pending_positions": PENDING_POSITIONS}
_EXTRA_KEYS = {"reserve_config_state": ["pool_id", "asset_address", "reserve_index"], "current_rates": ["pool_id", "asset_address"],
               "pending_positions": ["pool_id", "user_address", "reserve_index", "ledger_sequence"]}


def fingerprint(batch: DataFrame, counted: Column) -> tuple[str, int]:
    """What a micro-batch holds, whatever the order of its rows; and, from the same pass, in how many ``counted`` is true."""
    row = batch.agg(F.count("*").alias("n"), F.sum(F.xxhash64(*batch.columns).cast("decimal(38,0)")).alias("h"),
                    F.count_if(counted).alias("counted")).first()
    return f"{row.n}:{row.h}", row.counted


def start(stream: DataFrame, handler, checkpoint: str, available_now: bool, processing_time: str | None = None):
    """Start a query that hands each micro-batch to ``handler(batch, batch_id)``."""
    writer = stream.writeStream.foreachBatch(handler).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()
