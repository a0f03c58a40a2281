"""Emission yields: history, today's capture and configuration."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import EPS_DIGITS, PRICE_BACKFILL, SECONDS_PER_YEAR, SRC_STATE_FEED, YIELD_LAUNCH_DATE
from ..functions.numbers import emission_apy, emissions_per_token_year
from ..operators.fill import forward_fill, running_total

APY_COLUMNS = (
    "rate_date", "apy_type", "pool_address", "asset_address", "eps", "eps_decimals", "total_supply",
    "reward_price_usd", "asset_price_usd", "emissions_per_year_per_token", "emission_apy", "source",
)


def backstop_token_delta() -> Column:
    """Signed LP-token change of one backstop event."""
    amount = F.coalesce(F.col("lp_tokens"), F.lit(0).cast("decimal(38,0)"))
    return (
        F.when(F.col("action_type").isin("deposit", "donate", "gulp_emissions"), amount)
        .when(F.col("action_type").isin("withdraw", "draw"), -amount)
        .otherwise(F.lit(0).cast("decimal(38,0)"))
    )


def _price(prices: DataFrame, token: str | None, day: str, name: str, asset: str | None = None) -> DataFrame:
    if token is not None:
        prices = prices.filter(F.col("token_address") == token)
        return prices.select(F.col("price_date").alias(day), F.col("usd_price").alias(name))
    return prices.select(F.col("price_date").alias(day), F.col("token_address").alias(asset),
                         F.col("usd_price").alias(name))


def _with_apy(df: DataFrame, supply_tokens: Column) -> DataFrame:
    df = df.withColumn(
        "emissions_per_year_per_token",
        emissions_per_token_year(F.col("eps"), F.col("eps_decimals"), supply_tokens))
    return df.withColumn(
        "emission_apy",
        emission_apy(F.col("emissions_per_year_per_token"), F.col("reward_price_usd"), F.col("asset_price_usd")))


def backstop_apy(backstop_events: DataFrame, configs: DataFrame, prices: DataFrame, reward_token: str,
                 lp_token: str, end_date, start_date=YIELD_LAUNCH_DATE) -> DataFrame:
    """Daily backstop emission yield per pool.

    Events are netted per pool and day, accumulated, and filled to days; both
    prices come in by plain left joins on the day.
    """
    events = backstop_events.filter(F.col("pool_address").isNotNull()).withColumn(
        "event_date", F.to_date("ledger_closed_at"))
    totals = running_total(events, ["pool_address"], "event_date", backstop_token_delta(), "total_tokens")
    daily = forward_fill(totals, ["pool_address"], "event_date", ["total_tokens"], start_date, end_date,
                         out_col="rate_date").filter(F.col("total_tokens") > 0)
    emitting = configs.filter(F.col("config_type") == "backstop").select(
        "pool_address", "eps", "eps_decimals").distinct()
    priced = (
        daily.join(emitting, "pool_address")
        .join(_price(prices, reward_token, "rate_date", "reward_price_usd"), "rate_date", "left")
        .join(_price(prices, lp_token, "rate_date", "asset_price_usd"), "rate_date", "left")
    )
    return _with_apy(priced, F.col("total_tokens").cast("double") / 1e7).select(
        "rate_date", F.lit("backstop").alias("apy_type"), "pool_address",
        F.lit(None).cast("string").alias("asset_address"), "eps", "eps_decimals",
        F.col("total_tokens").cast("double").alias("total_supply"), "reward_price_usd", "asset_price_usd",
        "emissions_per_year_per_token", "emission_apy", F.lit("backstop_events").alias("source"))


def lending_apy(snapshots: DataFrame, configs: DataFrame, prices: DataFrame, reward_token: str, side: str,
                start_date=YIELD_LAUNCH_DATE) -> DataFrame:
    """Daily emission yield per pool and asset of one side (``supply`` or ``borrow``).

    A configuration applies while the day lies before its expiration.
    """
    supply = {"supply": "b_supply", "borrow": "d_supply"}[side]
    apy_type = f"lending_{side}"
    active = configs.filter(F.col("config_type") == apy_type).select(
        F.col("pool_address").alias("pool_id"), "asset_address", "eps", "eps_decimals", "expiration")
    held = snapshots.filter((F.col(supply) > 0) & (F.col("snapshot_date") >= F.lit(start_date).cast("date")))
    s, c = held.alias("s"), active.alias("c")
    midnight = F.unix_date("s.snapshot_date").cast("long") * 86_400
    matched = s.join(c, (
        (F.col("s.pool_id") == F.col("c.pool_id")) & (F.col("s.asset_address") == F.col("c.asset_address"))
        & (F.col("c.expiration").isNull() | (midnight < F.col("c.expiration")))
    )).select(
        F.col("s.snapshot_date").alias("rate_date"), F.col("s.pool_id").alias("pool_address"),
        F.col("s.asset_address").alias("asset_address"), "c.eps", "c.eps_decimals",
        F.col(f"s.{supply}").cast("double").alias("total_supply"))
    priced = (
        matched.join(_price(prices, reward_token, "rate_date", "reward_price_usd"), "rate_date", "left")
        .join(_price(prices, None, "rate_date", "asset_price_usd", "asset_address"),
              ["rate_date", "asset_address"], "left")
    )
    return _with_apy(priced, F.col("total_supply")).select(
        "rate_date", F.lit(apy_type).alias("apy_type"), "pool_address", "asset_address", "eps", "eps_decimals",
        "total_supply", "reward_price_usd", "asset_price_usd", "emissions_per_year_per_token", "emission_apy",
        F.lit(PRICE_BACKFILL).alias("source"))


def todays_apy(reserve_state: DataFrame, backstop_state: DataFrame, prices: DataFrame, reward_token: str,
               lp_token: str, day) -> DataFrame:
    """Yields of one day from the state feeds (backstop, supply and borrow sides).

    Lending supplies are stored scaled, backstop tokens raw, as in the history.
    """
    today = F.lit(day).cast("date")
    day_prices = prices.filter(F.col("price_date") == today).select("token_address", "usd_price")

    def price_of(token: str) -> Column:
        one = day_prices.filter(F.col("token_address") == token).agg(F.max("usd_price").alias("p"))
        return one.scalar()

    backstop = backstop_state.filter(F.col("eps") > 0).select(
        F.lit("backstop").alias("apy_type"), F.col("pool_id").alias("pool_address"),
        F.lit(None).cast("string").alias("asset_address"), "eps", "eps_decimals",
        F.col("tokens").cast("double").alias("total_supply"),
        (F.col("tokens").cast("double") / 1e7).alias("_tokens"), F.lit(lp_token).alias("_priced"))

    def side(name: str, eps: str, supply: str) -> DataFrame:
        tokens = F.col(supply).cast("double") / F.pow(F.lit(10.0), F.col("decimals").cast("double"))
        return reserve_state.filter(F.col(eps) > 0).select(
            F.lit(f"lending_{name}").alias("apy_type"), F.col("pool_id").alias("pool_address"),
            F.col("asset_id").alias("asset_address"), F.col(eps).alias("eps"),
            F.lit(EPS_DIGITS).alias("eps_decimals"), tokens.alias("total_supply"), tokens.alias("_tokens"),
            F.col("asset_id").alias("_priced"))

    rows = backstop.unionByName(side("supply", "supply_eps", "total_supply")).unionByName(
        side("borrow", "borrow_eps", "total_liabilities"))
    priced = rows.join(
        day_prices.withColumnsRenamed({"token_address": "_priced", "usd_price": "asset_price_usd"}),
        "_priced", "left",
    ).withColumn("reward_price_usd", price_of(reward_token)).withColumn("rate_date", today)
    return _with_apy(priced, F.col("_tokens")).withColumn("source", F.lit(SRC_STATE_FEED)).select(*APY_COLUMNS)


def emission_configs(reserve_state: DataFrame, backstop_state: DataFrame) -> DataFrame:
    """Emission configuration rows of both state feeds; expiration 0 means none."""
    def expiry(c: str) -> Column:
        return F.when(F.col(c) != 0, F.col(c))

    def side(name: str) -> DataFrame:
        return reserve_state.filter(F.col(f"{name}_eps") > 0).select(
            F.lit(f"lending_{name}").alias("config_type"), F.col("pool_id").alias("pool_address"),
            F.col("asset_id").alias("asset_address"), F.col(f"{name}_eps").alias("eps"),
            F.lit(EPS_DIGITS).alias("eps_decimals"), expiry(f"{name}_expiration").alias("expiration"))

    backstop = backstop_state.filter(F.col("eps").isNotNull()).select(
        F.lit("backstop").alias("config_type"), F.col("pool_id").alias("pool_address"),
        F.lit(None).cast("string").alias("asset_address"), "eps", "eps_decimals",
        expiry("expiration").alias("expiration"))
    return side("supply").unionByName(side("borrow")).unionByName(backstop)


def annual_emissions(configs: DataFrame) -> DataFrame:
    """Yearly emissions per pool: supply side, borrow side, backstop, lending total."""
    yearly = F.col("eps").cast("double") / F.pow(F.lit(10.0), F.col("eps_decimals").cast("double")) * float(
        SECONDS_PER_YEAR)

    def part(kind: str) -> Column:
        return F.sum(F.when(F.col("config_type") == kind, yearly).otherwise(0.0))

    return configs.groupBy("pool_address").agg(
        part("lending_supply").alias("supply"), part("lending_borrow").alias("borrow"),
        part("backstop").alias("backstop"),
    ).withColumn("lending_total", F.col("supply") + F.col("borrow"))


def apy_summary(apy: DataFrame) -> DataFrame:
    """Rows and range of the yields per kind."""
    return apy.groupBy("apy_type").agg(
        F.count("*").alias("n"), F.min("emission_apy").alias("min_apy"), F.max("emission_apy").alias("max_apy"),
        F.avg("emission_apy").alias("avg_apy"))
