"""Which days a backfill has done, and which it has still to do.

Rows cannot tell: a day without any may be done, and a row may come from the
stream or from another source. So each finished run leaves the days it covered
as an interval per table, source and scope (a contract, or ``*`` for all), and
what is missing is found from these by gaps and islands.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import schemas

COVERAGE = schemas._struct(table_name=schemas._S, source=schemas._S, scope=schemas._S, first_day=schemas._D, last_day=schemas._D)
ALL = "*"


def _islands(intervals: DataFrame, keys: list[str]) -> DataFrame:
    """``first_day, last_day`` of maximal runs of covered days; adjoining intervals are one run."""
    order = Window.partitionBy(*keys).orderBy("first_day", "last_day")
    reach = F.max("last_day").over(order.rowsBetween(Window.unboundedPreceding, -1))
    begins = F.when(F.coalesce(F.col("first_day") > F.date_add(reach, 1), F.lit(True)), 1).otherwise(0)
    numbered = intervals.withColumn("_begins", begins).withColumn("_island", F.sum("_begins").over(order))
    return numbered.groupBy(*keys, "_island").agg(F.min("first_day").alias("first_day"), F.max("last_day").alias("last_day")).drop("_island")


def islands(coverage: DataFrame) -> DataFrame:
    """The covered days of each table, source and scope as few intervals as possible."""
    return _islands(coverage.select(*COVERAGE.names).distinct(), ["table_name", "source", "scope"])


def gaps(coverage: DataFrame, scopes: DataFrame, first, last) -> DataFrame:
    """``scope, first_day, last_day``: what of the days ``first`` to ``last`` each scope lacks.

    ``coverage`` holds intervals of one table and source. ``scopes`` has one row
    per ``scope``; what is covered for ``*`` is covered for each of them. No
    interval at all leaves one gap, a window without days leaves none.
    """
    low, high = F.lit(first).cast("date"), F.lit(last).cast("date")
    scopes = scopes.select("scope").distinct()
    named = coverage.select("scope", "first_day", "last_day")
    own = named.join(scopes, "scope")
    common = named.filter(F.col("scope") == ALL).select("first_day", "last_day")
    # Runs over everything make a few islands of days: one array, which each scope takes as it is.
    runs = _islands(common.withColumn("_all", F.lit(1)), ["_all"]).agg(F.collect_list(F.struct("first_day", "last_day"))).scalar()
    shared = scopes.filter(F.col("scope") != ALL).select("scope", F.explode(runs).alias("run")).select("scope", "run.*")
    inside = own.unionByName(shared).filter((F.col("last_day") >= low) & (F.col("first_day") <= high)).select(
        "scope", F.greatest("first_day", low).alias("first_day"), F.least("last_day", high).alias("last_day"))
    # The day before the window is an island of its own, so that the gap at the start needs no case of its own.
    fence = scopes.select("scope", F.date_sub(low, 1).alias("first_day"), F.date_sub(low, 1).alias("last_day"))
    done = _islands(inside.unionByName(fence), ["scope"])
    following = F.lead("first_day").over(Window.partitionBy("scope").orderBy("first_day"))
    between = done.select("scope", F.date_add("last_day", 1).alias("first_day"), F.coalesce(F.date_sub(following, 1), high).alias("last_day"))
    return between.filter(F.col("first_day") <= F.col("last_day"))
