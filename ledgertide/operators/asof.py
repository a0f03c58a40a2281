"""As-of join: for each left row the latest right row at or before it.

Shape of the plan, chosen so that one hot key cannot end up in one task:

* What has to be resolved is only the set of distinct ``(key, tick)`` points of
  the left side (a hash aggregation of the key alone), and of the right side only
  one row per ``(key, tick)``; both are combined on the map side.
* That timeline is shuffled once by ``(key, bucket)``, a bucket being a fixed run
  of ticks.  Each side holds a tick once, so a window group has at most
  ``2 * bucket_ticks`` rows however skewed the key is.
* A bucket without an earlier fact inside it takes the last fact of an earlier
  bucket: one summary row per ``(key, bucket)``, carried on within runs of
  buckets and then, one row per run, from run to run.
* The resolved points go back to the left rows by an equi-join on
  ``(key, tick)``, which adaptive execution may split or broadcast.

Nothing grows quadratically, and no side is broadcast by hint.  The left side is
read twice (its points, then its rows): where it is costly to compute, cut it
first (:func:`ledgertide.session.cut`).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULT_BUCKET_TICKS = 1 << 16
BUCKETS_PER_RUN = 4096


def _ticks(df: DataFrame, column: str) -> tuple[Column, int]:
    """Column as a whole number of ticks, and the ticks of one default bucket.

    Integers (ledgers) and dates are their own ticks.  A timestamp's ticks are
    microseconds; its bucket is one minute, so a group holds the distinct
    instants of one key in one minute.
    """
    kind = df.schema[column].dataType
    c = F.col(column)
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("long"), DEFAULT_BUCKET_TICKS
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(c.cast("timestamp")), 60 * 1_000_000
    return c.cast("long"), DEFAULT_BUCKET_TICKS


def _carried(summary: DataFrame, on: list[str]) -> DataFrame:
    """The last fact before each bucket that holds a point.

    A window group is one run of buckets of a key, or one row per run of a key:
    also without a key no task sees all buckets.
    """
    def before(keys: Sequence[str], by: str) -> Column:
        rows = Window.partitionBy(*keys).orderBy(by).rowsBetween(Window.unboundedPreceding, -1)
        return F.last("_closing", ignorenulls=True).over(rows)

    in_runs = summary.withColumn("_run", F.floor(F.col("_bucket") / BUCKETS_PER_RUN).cast("long")).repartition(*on, "_run")
    runs = in_runs.groupBy(*on, "_run").agg(
        F.max_by("_closing", F.when(F.col("_closing").isNotNull(), F.col("_bucket"))).alias("_closing"))
    from_runs = runs.select(*on, "_run", before(on, "_run").alias("_from_runs"))
    inside = in_runs.withColumn("_inside", before([*on, "_run"], "_bucket")).filter("_has_point")
    return inside.join(from_runs, [*on, "_run"], "left").select(
        *on, "_bucket", F.coalesce("_inside", "_from_runs").alias("_carried"))


def asof_join(
    left: DataFrame, right: DataFrame, on: Sequence[str], left_ts: str, right_ts: str, cols: Sequence[str],
    tie_cols: Sequence[str] = (), bucket_ticks: int | None = None,
) -> DataFrame:
    """Left rows (all of them, once each) plus ``cols`` of the matching right row.

    ``on`` may be empty: then the match is by time alone.  Of several right rows
    at one tick the greatest by ``tie_cols`` counts, and without ``tie_cols`` the
    greatest by ``cols``.  NULLs inside the matched row are kept.
    """
    on = list(on)
    left_tick, default_ticks = _ticks(left, left_ts)
    right_tick, _ = _ticks(right, right_ts)
    width = F.lit(bucket_ticks or default_ticks)

    value = F.struct(*[F.col(c).alias(c) for c in cols])
    order = F.struct(*[F.col(c) for c in tie_cols]) if tie_cols else value

    def usable(df: DataFrame, tick: Column, **more: Column) -> DataFrame:
        rows = df.select(*on, tick.alias("_tick"), *[c.alias(name) for name, c in more.items()])
        for k in [*on, "_tick"]:
            rows = rows.filter(F.col(k).isNotNull())
        return rows

    facts = usable(right, right_tick, _value=value, _order=order).groupBy(*on, "_tick").agg(
        F.max_by("_value", "_order").alias("_value"))
    no_value = F.lit(None).cast(facts.schema["_value"].dataType)
    points = usable(left, left_tick).distinct().withColumn("_value", no_value)
    timeline = (
        facts.withColumn("_is_point", F.lit(False))
        .unionByName(points.withColumn("_is_point", F.lit(True)))
        .withColumn("_bucket", F.floor(F.col("_tick") / width).cast("long"))
        .repartition(*on, "_bucket")
    )

    in_bucket = Window.partitionBy(*on, "_bucket").orderBy("_tick", "_is_point").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    within = timeline.withColumn("_seen", F.last("_value", ignorenulls=True).over(in_bucket)).filter("_is_point")

    # Both branches read the same columns of the timeline, so its shuffle is made once.
    summary = timeline.groupBy(*on, "_bucket").agg(
        F.max_by("_value", F.when(F.col("_value").isNotNull(), F.col("_tick"))).alias("_closing"),
        F.bool_or("_is_point").alias("_has_point"))
    carried = _carried(summary, on)

    resolved = within.join(carried, [*on, "_bucket"], "left").select(
        *on, "_tick", F.coalesce("_seen", "_carried").alias("_match"))

    taken = set(left.columns)
    clash = taken & set(cols)
    if clash:
        raise ValueError(f"rename before the join, both sides have: {sorted(clash)}")
    return (
        left.withColumn("_tick", left_tick)
        .join(resolved, [*on, "_tick"], "left")
        .select(*[F.col(c) for c in left.columns], *[F.col("_match")[c].alias(c) for c in cols])
    )
