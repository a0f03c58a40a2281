"""Backfill jobs: decode, validate, leave out what the stream has, upsert, count.

Each job writes one curated table of a :class:`TableStore` and returns its counts
(``inserted``, ``updated``, ``stale``, ``rejected``). The decoded rows are written
once to the shared folder, so that validation, rejects and upsert do not decode
again. A job that is run again over the same days changes no row.

Each run notes the days it covered, per contract and source (``operators.coverage``).
``resume=True`` runs over the days that are still missing: those after the last run,
those before a contract was added, and any hole in between, as one scan that reads
the partitions of these days only. The newest day of the log counts as incomplete
and is read again. Rows of the stream, or of another source, are no progress.

``preview`` gives what a job would do, without writing.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..constants import PRICE_BACKFILL, SRC_BACKFILL
from ..functions.timewindow import optional_window
from ..operators.coverage import ALL, COVERAGE, gaps, islands
from ..operators.dedup import dedup_first, dedup_last
from ..operators.upsert import merged_rows
from ..operators.validate import BALANCE_RULES, POSITION_RULES, SNAPSHOT_RULES, Rule, required, validate
from ..session import cut
from ..streaming.tables import TableStore
from . import events, positions, snapshots

_NOTHING = {"inserted": 0, "updated": 0, "stale": 0, "rejected": 0}


# --- which days --------------------------------------------------------------

def _day(log: DataFrame) -> Column:
    return F.col("date") if "date" in log.columns else F.to_date("closed_at")


def _shifted(day, days: int) -> dt.date | None:
    """A date, or the text of one, moved by some days."""
    return None if day is None else dt.date.fromisoformat(str(day)[:10]) + dt.timedelta(days=days)


@dataclass(frozen=True)
class Todo:
    """What a run has to read: the rows of its days, the days' bounds, and the intervals to note when it has ended."""

    log: DataFrame
    start_date: dt.date | None
    end_date: dt.date | None
    intervals: list[tuple[str, dt.date, dt.date]] = field(default_factory=list)
    resumed: bool = False

    @property
    def nothing(self) -> bool:
        return self.resumed and not self.intervals

    def window(self, **options) -> dict:
        return {"start_date": self.start_date, "end_date": self.end_date, **options}


def todo(store: TableStore, table: str, log: DataFrame, contracts: Sequence[str] | None = None, start_date=None, end_date=None,
         resume: bool = False, source: str = SRC_BACKFILL, by_contract: bool = False) -> Todo:
    """The days to run: all of the window, or with ``resume`` the gaps of each contract.

    Two days of the log are looked up (its partitions tell them). A contract's gaps
    come to the driver, one row each; contracts with the same gap share a predicate.
    ``by_contract``: no row of the table rests on rows of several contracts. A run
    over all contracts then leaves out the days that a run of some has covered.
    """
    scopes = sorted(set(contracts)) if contracts is not None else [ALL]
    rows = log if contracts is None else log.filter(F.col("contract_id").isin(scopes))
    oldest, newest = log.agg(F.min(_day(log)), F.max(_day(log))).first()
    first, last = _shifted(start_date, 0) or oldest, _shifted(end_date, 0) or newest
    if newest is None:  # an empty log
        return Todo(rows, first, last, [], resume)
    wanted = [(s, first, last) for s in scopes if first <= last]
    if resume:
        done = store.read("coverage").filter((F.col("table_name") == table) & (F.col("source") == source))
        named = store.spark.createDataFrame([(s,) for s in scopes], "scope string")
        wanted = sorted(tuple(r) for r in gaps(done, named, first, last).collect())
        rows = rows.filter(_in_gaps(rows, wanted)) if wanted else rows
        if by_contract and wanted and contracts is None:
            named = islands(done.filter(F.col("scope") != ALL)).filter((F.col("last_day") >= F.lit(first)) & (F.col("first_day") <= F.lit(last)))
            covered = sorted(tuple(r) for r in named.select("scope", "first_day", "last_day").collect())
            rows = rows.filter(~F.coalesce(_in_gaps(rows, covered), F.lit(False))) if covered else rows
    # The newest day of the log may still grow, so it is never noted as done.
    complete = newest - dt.timedelta(days=1)
    return Todo(rows, min((w[1] for w in wanted), default=first), max((w[2] for w in wanted), default=last),
                [(s, a, min(b, complete)) for s, a, b in wanted], resume)


def _in_gaps(log: DataFrame, wanted: Sequence[tuple[str, dt.date, dt.date]]) -> Column:
    by_days: dict[tuple, list[str]] = {}
    for scope, first, last in wanted:
        by_days.setdefault((first, last), []).append(scope)
    found = F.lit(False)
    for (first, last), scopes in by_days.items():
        days = _day(log).between(F.lit(first), F.lit(last))
        found = found | (days if scopes == [ALL] else days & F.col("contract_id").isin(scopes))
    return found


def _note(store: TableStore, table: str, run: Todo, source: str = SRC_BACKFILL) -> None:
    done = [(table, source, scope, first, last) for scope, first, last in run.intervals if first <= last]
    if done:
        store.append("coverage", store.spark.createDataFrame(done, COVERAGE))


# --- the jobs ----------------------------------------------------------------

@dataclass(frozen=True)
class Planned:
    """Rows that a job is about to upsert, and what it rejects."""

    table: str
    rows: DataFrame
    rejects: DataFrame
    order_cols: Sequence[str] = ("ledger_sequence",)


def _write(store: TableStore, planned: Planned) -> dict[str, int]:
    return store.upsert(planned.table, planned.rows, planned.order_cols) | {"rejected": planned.rejects.count()}


def _finish(store: TableStore, planned: Planned, run: Todo, source: str = SRC_BACKFILL) -> dict[str, int]:
    done = _write(store, planned)
    _note(store, planned.table, run, source)
    return done


def _checked(table: str, rows: DataFrame, rules: Sequence[Rule], order_cols: Sequence[str] = ("ledger_sequence",)) -> Planned:
    return Planned(table, *validate(cut(rows, table), rules), order_cols)


def _new_events(store: TableStore, table: str, decoded: DataFrame, typed, new, start_date, end_date) -> Planned:
    valid, rejects = typed(cut(decoded, table))
    stored = optional_window(store.read(table), "ledger_closed_at", start_date, end_date, end_inclusive=True,
                             partition_col=schemas.TABLE_PARTITIONS[table])
    return Planned(table, new(valid, stored), rejects)


def plan_lending_events(store: TableStore, raw: DataFrame, pools: Sequence[str] | None = None, start_date=None,
                        end_date=None) -> Planned:
    decoded = events.lending_table(raw, pools, start_date, end_date)
    return _new_events(store, "parsed_events", decoded, events.typed_actions, events.new_actions, start_date, end_date)


def plan_backstop_events(store: TableStore, raw: DataFrame, contract: str | None = None, start_date=None, end_date=None) -> Planned:
    decoded = events.backstop_table(raw, contract, start_date, end_date)
    return _new_events(store, "backstop_events", decoded, events.typed_backstop, events.new_backstop_events, start_date, end_date)


def plan_pool_snapshots(state: DataFrame, pools: Sequence[str] | None = None, start_date=None, end_date=None, **options) -> Planned:
    return _checked("pool_snapshots", snapshots.pool_snapshots(state, pools, start_date, end_date, **options), SNAPSHOT_RULES())


def backfill_lending_events(store: TableStore, raw: DataFrame, pools: Sequence[str] | None = None, start_date=None,
                            end_date=None, resume: bool = False) -> dict[str, int]:
    run = todo(store, "parsed_events", raw, pools, start_date, end_date, resume, by_contract=True)
    if run.nothing:
        return dict(_NOTHING)
    return _finish(store, plan_lending_events(store, run.log, pools, **run.window()), run)


def backfill_backstop_events(store: TableStore, raw: DataFrame, contract: str | None = None, start_date=None,
                             end_date=None, resume: bool = False) -> dict[str, int]:
    run = todo(store, "backstop_events", raw, contract and [contract], start_date, end_date, resume)
    if run.nothing:
        return dict(_NOTHING)
    return _finish(store, plan_backstop_events(store, run.log, contract, **run.window()), run)


def backfill_pool_snapshots(store: TableStore, state: DataFrame, pools: Sequence[str] | None = None, start_date=None,
                            end_date=None, resume: bool = False, **options) -> dict[str, int]:
    """Without ``resume`` and dates the last 90 days, which are not noted as covered."""
    run = todo(store, "pool_snapshots", state, pools, start_date, end_date, resume)
    if run.nothing:
        return dict(_NOTHING)
    if not resume and start_date is None:
        return _write(store, plan_pool_snapshots(state, pools, start_date, end_date, **options))
    return _finish(store, plan_pool_snapshots(run.log, pools, **run.window(**options)), run)


def backfill_positions(store: TableStore, state: DataFrame, pools: Sequence[str] | None = None, mode: str = "key",
                       **options) -> dict[str, int]:
    """Positions with the rates valid at their ledger; the window must reach back to a rate of each reserve."""
    rows = positions.position_changes_with_rates(state, pools, mode, **options)
    return _write(store, _checked("user_positions", rows, POSITION_RULES()))


def backfill_backstop_balances(store: TableStore, state: DataFrame, contract: str | None = None, start_date=None,
                               end_date=None, resume: bool = False) -> dict[str, int]:
    """``end_date`` is the first day that is left out."""
    run = todo(store, "backstop_pool_snapshots", state, contract and [contract], start_date, _shifted(end_date, -1), resume)
    if run.nothing:
        return dict(_NOTHING)
    rows = snapshots.backstop_balances(run.log, contract, run.start_date, _shifted(run.end_date, 1))
    return _finish(store, _checked("backstop_pool_snapshots", rows, BALANCE_RULES()), run)


def backfill_lp_prices(store: TableStore, state: DataFrame, token_address: str, contract: str | None = None,
                       start_date=None, end_date=None, resume: bool = False) -> dict[str, int]:
    """Days are noted per token: another source's prices of it are no progress. ``end_date`` is the first day left out."""
    source = f"{PRICE_BACKFILL}:{token_address}"
    run = todo(store, "daily_token_prices", state, contract and [contract], start_date, _shifted(end_date, -1), resume, source)
    if run.nothing:
        return dict(_NOTHING)
    rows = snapshots.lp_prices(run.log, contract, run.start_date, _shifted(run.end_date, 1)).select(
        F.lit(token_address).alias("token_address"), "price_date", F.col("lp_token_price").alias("usd_price"),
        F.lit(PRICE_BACKFILL).alias("source"))
    return _finish(store, _checked("daily_token_prices", rows, [required("price_date")], ["usd_price"]), run, source)


def write_emission_apy(store: TableStore, *yields: DataFrame) -> dict[str, int]:
    """Store daily yields of any kinds (``plans.yields``) in one table."""
    rows = yields[0]
    for more in yields[1:]:
        rows = rows.unionByName(more)
    return _write(store, _checked("daily_emission_apy", rows, [required("rate_date", "apy_type", "pool_address")], ["total_supply"]))


# --- preview -----------------------------------------------------------------

def preview(store: TableStore, planned: Planned, limit: int = 100) -> tuple[dict[str, int], DataFrame]:
    """What an upsert of ``planned`` would insert, update and reject, and ``limit`` of its rows with their ``op``.

    No table is written. Stored rows are read for the days of the planned rows only,
    and compared once, into the shared folder.
    """
    table, day = planned.table, schemas.TABLE_PARTITIONS.get(planned.table)
    rows = store.prepared(table, planned.rows)
    keys = store.keys(table)
    last = dedup_last(rows, keys, planned.order_cols)
    stored = store.read(table)
    if day:
        low, high = rows.agg(F.min(day), F.max(day)).first()
        stored = stored.filter(F.col(day).isNull() | F.col(day).between(F.lit(low), F.lit(high)))
    merged = merged_rows(stored, last, keys).filter(F.col("_op") != "keep").withColumnRenamed("_op", "op")
    merged = cut(merged, "preview")
    counts = merged.agg(F.count_if(F.col("op") == "insert"), F.count_if(F.col("op") == "update")).first()
    report = {"inserted": counts[0], "updated": counts[1], "rejected": planned.rejects.count()}
    return report, _first_rows(merged, keys, limit, counts[0] + counts[1])


#: Up to so many rows are picked by each task in memory and by one task at the end.
_PICKED_IN_MEMORY = 10_000


def _first_rows(rows: DataFrame, keys: Sequence[str], limit: int, total: int) -> DataFrame:
    """The first ``limit`` of ``total`` rows by their keys, however many that are.

    A sort with a limit keeps room for as many rows as the limit names in every
    task. So only a small one is left to it; a larger one is cut from the sorted
    rows, numbered within their partitions, by the partitions' row counts.
    """
    if limit >= total:
        return rows.orderBy(*keys)
    if limit <= _PICKED_IN_MEMORY:
        return rows.orderBy(*keys).limit(limit)
    numbered = cut(rows.orderBy(*keys).withColumn("_at", F.monotonically_increasing_id()), "ordered")
    part = F.shiftright("_at", 33)  # the partition, above the row's number in it
    end, left = -1, limit  # first position that is left out
    for row in numbered.groupBy(part.alias("part")).agg(F.count("*").alias("n")).orderBy("part").collect():
        end, left = (row.part << 33) + min(row.n, left), left - min(row.n, left)
        if not left:
            break
    return numbered.filter(F.col("_at") < end).orderBy("_at").drop("_at")


# --- daily price capture -----------------------------------------------------

@dataclass(frozen=True)
class Captured:
    """Outcome of a capture: row counts, rows per source, and why sources gave nothing."""

    counts: dict[str, int]
    by_source: dict[str, int]
    errors: dict[str, str]


def capture_daily_prices(store: TableStore, sources: Mapping[str, Callable[[], DataFrame]], first_wins: bool = False) -> Captured:
    """All prices of a day, from any number of sources, merged and written once.

    ``sources`` maps names to builders of ``token_address, price_date, usd_price,
    source`` (``plans.prices``). Each is computed by itself: one that fails is
    noted with its message and leaves the others as they are. Of a token that
    several sources price, the later source counts, as if each were written over
    the one before; with ``first_wins`` the earlier. A price that is missing, NaN,
    infinite or not positive is rejected and so hides no other source's price.
    """
    found, errors = [], {}
    for rank, (name, build) in enumerate(sources.items()):
        try:
            found.append(cut(build().select("token_address", F.col("price_date").cast("date").alias("price_date"),
                                            F.col("usd_price").cast("double").alias("usd_price"), "source",
                                            F.lit(name).alias("_from"), F.lit(rank).alias("_rank")), "prices"))
        except Exception as failure:  # noqa: BLE001 - any failure of one source must leave the others alone
            errors[name] = _message(failure)
    if not found:
        return Captured(dict(_NOTHING), {}, errors)
    rows = found[0]
    for more in found[1:]:
        rows = rows.unionByName(more)
    price = F.col("usd_price")
    unusable = Rule("unusable price", price.isNull() | F.isnan(price) | (price <= 0) | (price == float("inf")))
    valid, rejects = validate(rows, [required("token_address"), required("price_date"), unusable])
    order = F.col("_rank") if first_wins else -F.col("_rank")
    keys = schemas.TABLE_KEYS["daily_token_prices"]
    merged = cut(dedup_first(valid.withColumn("_order", order), keys, ["_order", "usd_price"]), "prices")
    counts = store.upsert("daily_token_prices", merged, ("usd_price",)) | {"rejected": rejects.count()}
    return Captured(counts, {r["_from"]: r["n"] for r in merged.groupBy("_from").agg(F.count("*").alias("n")).collect()}, errors)


def _message(failure: Exception) -> str:
    return (str(failure).strip() or type(failure).__name__).splitlines()[0][:300]


def price_sources(day, tokens: DataFrame, lp_prices: DataFrame, lp_token: str, pool_balances: DataFrame,
                  reward_token: str, fx: DataFrame, bond_history: DataFrame, bond_token: str, reserve_state: DataFrame,
                  pool_order: DataFrame) -> dict[str, Callable[[], DataFrame]]:
    """The five sources of a day's capture, in the order in which they are written.

    ``lp_prices`` (price_date, lp_token_price) and ``pool_balances`` (price_date,
    quote, base) give their newest row, ``bond_history`` (position, token_price,
    fx_rate) its last entry, ``fx`` today's rates. Pegged tokens are left out of
    the oracle's prices; a peg whose currency has no rate ends its source only for
    that token, see ``plans.prices.unpriced_pegs``.
    """
    from . import prices

    def newest(rows: DataFrame) -> DataFrame:
        return dedup_last(rows.withColumn("_one", F.lit(1)), ["_one"], ["price_date"]).withColumn("price_date", F.lit(day).cast("date"))

    return {
        "lp token": lambda: prices.from_lp_price(newest(lp_prices), lp_token),
        "pool ratio": lambda: prices.from_pool_ratio(newest(pool_balances), reward_token),
        "pegs": lambda: prices.pegged_today(tokens, prices.usd_rates(fx), day),
        "bond": lambda: prices.bond_today(bond_history, bond_token, day),
        "oracle": lambda: prices.oracle_prices(reserve_state, pool_order, tokens, day),
    }
