"""Fixed-point scaling and ratios."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def _shifted(raw: Column, whole_digits: int, digits: int) -> Column:
    """raw * 10**-digits as decimal(38, digits), exact for every integer of up to 38 digits; NULL beyond.

    Up to ``whole_digits`` the product fits the type of a decimal product; a
    wider integer has its point set in its text.
    """
    narrow = (raw.try_cast(f"decimal({whole_digits},0)") * F.lit(Decimal(1).scaleb(-digits))).cast(f"decimal(38,{digits})")
    text = raw.try_cast("decimal(38,0)").cast("string")
    pointed = F.concat(F.substring(text, F.lit(1), F.length(text) - digits), F.lit("."), F.right(text, F.lit(digits)))
    return F.coalesce(narrow, pointed.try_cast(f"decimal(38,{digits})"))


def scaled_amount(raw: Column) -> Column:
    """Raw token amount → tokens with 7 decimals.

    A missing amount counts as 0; one that is no integer of up to 38 digits is NULL.
    """
    zero = F.lit(Decimal("0E-7")).cast("decimal(38,7)")
    return F.when(raw.isNull(), zero).otherwise(_shifted(raw, 30, 7))


def scaled_rate(raw: Column, null_as_zero: bool = False) -> Column:
    """Raw rate → rate with 12 decimals.

    Backfills keep a missing rate NULL; the real-time feed stored 0 instead
    (``null_as_zero``). A rate that is no integer of up to 38 digits is NULL.
    """
    rate = _shifted(raw, 25, 12)
    return F.when(raw.isNull(), F.lit(0).cast("decimal(38,12)")).otherwise(rate) if null_as_zero else rate


def q4w_percent(q4w: Column, shares: Column) -> Column:
    """Share of the backstop that is queued for withdrawal, 0 for an empty one."""
    pct = F.round(F.try_divide(q4w.cast("double") * 100.0, shares.cast("double")), 4)
    return F.when(shares > 0, pct).otherwise(F.lit(0.0))


def lp_token_price(quote_balance: Column, total_shares: Column) -> Column:
    """A pool holding 20% quote asset: its value is five times the quote side."""
    return F.try_divide(F.lit(5.0) * quote_balance.cast("double"), total_shares.cast("double"))


def pool_ratio_price(quote_balance: Column, base_balance: Column) -> Column:
    """Price of the 80% side of an 80/20 pool in units of the 20% side."""
    return F.try_divide(quote_balance.cast("double") / 0.2, base_balance.cast("double") / 0.8)


def inverse_rate(x: Column) -> Column:
    return F.when(x > 0, F.try_divide(F.lit(1.0), x))


def emissions_per_token_year(eps: Column, eps_decimals: Column, supply_tokens: Column) -> Column:
    from ..constants import SECONDS_PER_YEAR

    per_year = eps.cast("double") / F.pow(F.lit(10.0), eps_decimals.cast("double")) * F.lit(float(SECONDS_PER_YEAR))
    return F.when(supply_tokens > 0, F.try_divide(per_year, supply_tokens.cast("double"))).otherwise(F.lit(0.0))


def emission_apy(per_token_year: Column, reward_price: Column, asset_price: Column) -> Column:
    """Yearly emissions as a percentage of the asset's value; NULL without prices."""
    return F.when(
        asset_price > 0, F.try_divide(per_token_year * reward_price, asset_price) * 100.0
    )
