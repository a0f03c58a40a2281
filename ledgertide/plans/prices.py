"""Token prices: statistics, status and the builders of the daily price table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import (
    FALLBACK_FX, PRICE_BOND, PRICE_MARKET, PRICE_ORACLE, PRICE_PEGGED, PRICE_POOL_RATIO,
)
from ..functions.numbers import inverse_rate, pool_ratio_price
from ..operators.dedup import dedup_first
from ..operators.fill import day_series
from ..operators.paging import ordering, page
from ..operators.upsert import missing_rows

PRICE_KEYS = ["token_address", "price_date"]


def token_price_statistics(tokens: DataFrame, prices: DataFrame) -> DataFrame:
    """Per token: records, records per source, first and last day and price.

    One pass over the prices: per (token, source) first, then per token, where the
    earliest and latest price ride along with their day (a token has one price per
    day, so the day alone decides).
    """
    per_source = prices.groupBy("token_address", "source").agg(
        F.count("*").alias("n"), F.min("price_date").alias("lo"), F.max("price_date").alias("hi"),
        F.min_by("usd_price", "price_date").alias("first"), F.max_by("usd_price", "price_date").alias("last"))
    per_token = per_source.groupBy("token_address").agg(
        F.sum("n").alias("total_records"),
        F.sort_array(F.collect_list(F.when(F.col("source").isNotNull(), F.struct("source", "n")))).alias("_sources"),
        F.min("lo").alias("earliest_date"), F.max("hi").alias("latest_date"),
        F.min_by("first", "lo").alias("earliest_price"), F.max_by("last", "hi").alias("latest_price"))
    empty = F.array().cast("array<struct<source:string,n:bigint>>")
    return tokens.select("asset_address", "symbol", "name").join(
        per_token.withColumnRenamed("token_address", "asset_address"), "asset_address", "left",
    ).select(
        "asset_address", "symbol", "name", F.coalesce("total_records", F.lit(0)).alias("total_records"),
        F.map_from_entries(F.coalesce("_sources", empty)).alias("source_counts"),
        "earliest_date", "latest_date", "earliest_price", "latest_price").orderBy("symbol", "asset_address")


def price_sources(prices: DataFrame) -> DataFrame:
    return prices.select("source").distinct().orderBy("source")


def source_count_table(prices: DataFrame, sources: Sequence[str] | None = None) -> DataFrame:
    """Records per token spread to one column per source, 0 where there are none."""
    grouped = prices.groupBy("token_address")
    pivoted = (grouped.pivot("source", list(sources)) if sources else grouped.pivot("source")).agg(F.count(F.lit(1)))
    return pivoted.na.fill(0)


def latest_prices(prices: DataFrame, tokens: DataFrame) -> DataFrame:
    """Prices of the newest day of the table, with symbols."""
    newest = prices.agg(F.max("price_date").alias("d")).scalar()
    named = tokens.select(F.col("asset_address").alias("token_address"), "symbol")
    return prices.filter(F.col("price_date") == newest).join(named, "token_address").select(
        "symbol", "token_address", "price_date", "usd_price", "source").orderBy("symbol", "token_address")


def price_coverage(tokens: DataFrame, prices: DataFrame, count_unpriced: bool = True) -> DataFrame:
    """Days covered per symbol.

    ``count_unpriced`` counts rows after the left join, so a token without any
    price shows one day; without it such a token shows 0.
    """
    per_token = prices.groupBy(F.col("token_address").alias("asset_address")).agg(
        F.min("price_date").alias("earliest"), F.max("price_date").alias("latest"), F.count("*").alias("n"))
    joined = tokens.select("symbol", "asset_address").join(per_token, "asset_address", "left")
    return joined.groupBy("symbol").agg(
        F.min("earliest").alias("earliest"), F.max("latest").alias("latest"),
        F.sum(F.coalesce("n", F.lit(1 if count_unpriced else 0))).alias("days")).orderBy("symbol")


def lp_price_page(prices: DataFrame, lp_token: str, limit: int = 100, offset: int = 0) -> DataFrame:
    rows = prices.filter(F.col("token_address") == lp_token).select(
        "price_date", F.col("usd_price").alias("lp_token_price"), "source")
    return page(rows, ordering("price_date", "desc"), limit, offset)


# --- builders of daily_token_prices -------------------------------------------

def _rows(df: DataFrame, token, source: str) -> DataFrame:
    token = token if not isinstance(token, str) else F.lit(token)
    return df.select(token.alias("token_address"), "price_date", "usd_price", F.lit(source).alias("source"))


def from_series(points: DataFrame, token_address: str, existing: DataFrame | None = None,
                source: str = PRICE_MARKET) -> DataFrame:
    """Market series → one price per day (the last point of the day), missing days only."""
    last = points.groupBy("price_date").agg(F.max_by("price", F.struct("at", "price")).alias("usd_price"))
    return _only_missing(_rows(last, token_address, source), existing)


def _only_missing(rows: DataFrame, existing: DataFrame | None) -> DataFrame:
    return rows if existing is None else missing_rows(existing, rows, PRICE_KEYS)


def from_bond_history(points: DataFrame, token_address: str, start=None, end=None,
                      existing: DataFrame | None = None, source: str = PRICE_BOND) -> DataFrame:
    """Bond history → USD price (token price over exchange rate), last entry per day."""
    last = points.groupBy("price_date").agg(
        F.max_by(F.struct("token_price", "fx_rate"), "position").alias("v"))
    priced = last.select("price_date", F.try_divide("v.token_price", "v.fx_rate").alias("usd_price"))
    if start is not None:
        priced = priced.filter(F.col("price_date") >= F.lit(start).cast("date"))
    if end is not None:
        priced = priced.filter(F.col("price_date") <= F.lit(end).cast("date"))
    return _only_missing(_rows(priced, token_address, source), existing)


def priced_tokens(tokens: DataFrame, token_address: str | None = None) -> DataFrame:
    """Tokens with a market id and without a peg."""
    rows = tokens.filter(
        F.col("coingecko_id").isNotNull() & (F.col("coingecko_id") != "") & F.col("pegged_currency").isNull())
    return rows if token_address is None else rows.filter(F.col("asset_address") == token_address)


def pegged_tokens(tokens: DataFrame, token_address: str | None = None) -> DataFrame:
    rows = tokens.filter(F.col("pegged_currency").isNotNull())
    return rows if token_address is None else rows.filter(F.col("asset_address") == token_address)


def pegged_usd_days(tokens: DataFrame, start, end) -> DataFrame:
    """USD-pegged tokens: price 1 on every day of the range."""
    usd = pegged_tokens(tokens).filter(F.upper("pegged_currency") == "USD")
    days = day_series(usd.select("asset_address"), start, end, "price_date").withColumn("usd_price", F.lit(1.0))
    return _rows(days, F.col("asset_address"), PRICE_PEGGED)


def pegged_fx_days(tokens: DataFrame, fx_series: DataFrame) -> DataFrame:
    """Other pegs: inverse of the day's last quote of a USD token in that currency.

    ``fx_series``: (currency, at, price_date, price).
    """
    usable = fx_series.filter(F.col("price") > 0)
    daily = usable.groupBy(F.upper("currency").alias("currency"), "price_date").agg(
        F.max_by("price", F.struct("at", "price")).alias("price"))
    foreign = pegged_tokens(tokens).filter(F.upper("pegged_currency") != "USD").select(
        "asset_address", F.upper("pegged_currency").alias("currency"))
    joined = foreign.join(daily, "currency").withColumn("usd_price", inverse_rate(F.col("price")))
    return _rows(joined, F.col("asset_address"), PRICE_PEGGED)


def usd_rates(fx: DataFrame) -> DataFrame:
    """USD value of one unit of each fiat currency, from rates quoted in one base.

    Without a usable USD entry the named fallback rates apply.
    """
    spark = fx.sparkSession
    usd = fx.filter(F.col("currency") == "USD").agg(F.max("value").alias("v")).scalar()
    crossed = fx.filter((F.col("type") == "fiat") & (F.col("value") > 0)).select(
        "currency", F.try_divide(usd, F.col("value")).alias("usd_value")).filter(
        (F.col("usd_value") > 0) & (F.col("currency") != "USD"))
    usable = fx.filter((F.col("currency") == "USD") & (F.col("value") != 0))
    fallback = spark.createDataFrame(sorted(FALLBACK_FX.items()), "currency string, usd_value double")
    one = fallback.filter(F.col("currency") == "USD")
    return crossed.where(usable.exists()).unionByName(one).unionByName(
        fallback.filter(F.col("currency") != "USD").where(~usable.exists()))


def pegged_today(tokens: DataFrame, rates: DataFrame, day) -> DataFrame:
    """Pegged tokens at today's exchange rates; a currency without a rate gives no row."""
    pegs = pegged_tokens(tokens).select("asset_address", F.upper("pegged_currency").alias("currency"))
    named = pegs.join(rates, "currency").select(
        "asset_address", F.lit(day).cast("date").alias("price_date"), F.col("usd_value").alias("usd_price"))
    return _rows(named, F.col("asset_address"), PRICE_PEGGED)


def unpriced_pegs(tokens: DataFrame, rates: DataFrame) -> DataFrame:
    """Pegged tokens whose currency has no exchange rate."""
    pegs = pegged_tokens(tokens).select("asset_address", F.upper("pegged_currency").alias("currency"))
    return pegs.join(rates.select("currency"), "currency", "left_anti").select("asset_address", "currency")


def bond_today(points: DataFrame, token_address: str, day, source: str = PRICE_BOND) -> DataFrame:
    """USD price of the last entry of a bond history, whatever its day, as the price of ``day``."""
    last = points.agg(F.max_by(F.struct("token_price", "fx_rate"), "position").alias("v")).filter(F.col("v").isNotNull())
    priced = last.select(F.lit(day).cast("date").alias("price_date"), F.try_divide("v.token_price", "v.fx_rate").alias("usd_price"))
    return _rows(priced, token_address, source)


def from_lp_price(daily: DataFrame, token_address: str, source: str = PRICE_POOL_RATIO) -> DataFrame:
    """``(price_date, lp_token_price)`` → price rows of the LP token."""
    return _rows(daily.select("price_date", F.col("lp_token_price").alias("usd_price")), token_address, source)


def from_pool_ratio(balances: DataFrame, token_address: str, source: str = PRICE_POOL_RATIO) -> DataFrame:
    """Reward-token price of an 80/20 pool: (price_date, quote, base) → price."""
    priced = balances.select("price_date", pool_ratio_price(F.col("quote"), F.col("base")).alias("usd_price"))
    return _rows(priced, token_address, source)


def oracle_prices(reserve_state: DataFrame, pool_order: DataFrame, tokens: DataFrame, day,
                  source: str = PRICE_ORACLE) -> DataFrame:
    """Oracle prices per asset: the first pool that lists it counts; pegged tokens are left out.

    The first pool decides even when its price is unusable, in which case the
    asset has no price that day.  ``pool_order``: (pool_id, pool_rank).
    """
    ranked = reserve_state.join(pool_order, "pool_id").select(
        F.col("asset_id").alias("asset_address"), "pool_rank", "oracle_price")
    first = dedup_first(ranked, ["asset_address"], ["pool_rank"])
    free = first.join(pegged_tokens(tokens).select("asset_address"), "asset_address", "left_anti")
    priced = free.filter(F.col("oracle_price") > 0).select(
        "asset_address", F.lit(day).cast("date").alias("price_date"), F.col("oracle_price").alias("usd_price"))
    return _rows(priced, F.col("asset_address"), source)
