"""Well-formedness predicates for addresses and dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import ADDRESS_PATTERN, DATE_PATTERN


def is_address(c: Column) -> Column:
    return F.coalesce(c.rlike(ADDRESS_PATTERN), F.lit(False))


def is_iso_day(c: Column) -> Column:
    """Text of the form YYYY-MM-DD that is also a day of the calendar."""
    return F.coalesce(c.rlike(DATE_PATTERN), F.lit(False)) & F.try_to_date(c, "yyyy-MM-dd").isNotNull()


def blank(c: Column) -> Column:
    """NULL or empty text (the two are the same thing in imports)."""
    return c.isNull() | (c.cast("string") == "")


def null_if_blank(c: Column) -> Column:
    return F.when(~blank(c), c)
