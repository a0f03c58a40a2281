"""Reading scalars out of tagged-union JSON text."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_TWO_64 = "18446744073709551616"


def json_scalar(doc: Column, path: str) -> Column:
    """Scalar at ``path``, NULL where the path leads to an object or array.

    ``get_json_object`` alone returns the JSON text of a nested object, which
    would win over the fallback in ``coalesce(scalar, nested.lo)``.
    """
    return _scalar_only(F.get_json_object(doc, path))


def _scalar_only(text: Column) -> Column:
    return F.when(~(text.startswith("{") | text.startswith("[")), text)


def scalar_text(text: Column) -> Column:
    """Same guard for a string field that ``from_json`` took from any JSON value."""
    return _scalar_only(text)


def i128_halves(text: Column) -> Column:
    """``{hi, lo}`` of an integer that is given as an object, else NULL."""
    return F.from_json(F.when(text.startswith("{"), text), "struct<hi:string,lo:string>")


def i128_text(text: Column, low_word_only: bool = False, halves: Column | None = None) -> Column:
    """Decimal digits of a 128-bit integer given as scalar text or ``{hi, lo}``.

    With ``low_word_only`` the high word is ignored, as older backfills did.
    A ``{hi, lo}`` that needs 39 digits keeps its JSON text, which is no number,
    so that validation rejects the row instead of storing a missing amount.
    ``halves`` is :func:`i128_halves` of the same text from an earlier projection
    (hot paths parse it there once instead of once per use).
    """
    halves = i128_halves(text) if halves is None else halves
    low, high = halves["lo"], halves["hi"]
    if low_word_only:
        nested = low
    else:
        wide = F.try_add(
            F.try_multiply(high.try_cast("decimal(19,0)"), F.lit(_TWO_64).cast("decimal(20,0)")).cast("decimal(38,0)"),
            low.try_cast("decimal(20,0)"),
        )
        nested = F.when(high.isNull() | (high == "0"), low).otherwise(F.coalesce(wide.try_cast("decimal(38,0)").cast("string"), text))
    return F.when(text.startswith("{"), nested).when(~text.startswith("["), text)


def _integer_keys(entries: Column) -> Column:
    # Fields of an array of structs and a cast of the whole array run as generated code, a lambda per entry does not.
    return entries["key"]["u32"].try_cast("array<bigint>")


def keys_of(entries: Column) -> Column:
    """Distinct integer keys of ``array<struct<key:struct<u32>, val:…>>``, in order; unsigned 32-bit keys need a long."""
    return F.array_distinct(F.array_compact(_integer_keys(entries)))


def find_by_key(entries: Column, key: Column | int) -> Column:
    """First entry with this integer key, NULL where there is none."""
    key = (F.lit(key) if isinstance(key, int) else key).cast("bigint")
    return F.get(entries, (F.array_position(_integer_keys(entries), key) - 1).cast("int"))


def with_integers(df: DataFrame, texts: Mapping[str, Column], low_word_only: bool = False) -> DataFrame:
    """Adds 128-bit integers as digit texts, each source text taken and parsed once.

    Three thin projections: an integer's text is looked at several times, so the
    expression that finds it, and the parse of a nested one, get their own.
    """
    found = df.withColumns({f"_{n}_text": text for n, text in texts.items()})
    halves = found.withColumns({f"_{n}_halves": i128_halves(F.col(f"_{n}_text")) for n in texts})
    return halves.withColumns({
        n: i128_text(F.col(f"_{n}_text"), low_word_only, F.col(f"_{n}_halves")) for n in texts
    }).drop(*[f"_{n}_{part}" for n in texts for part in ("text", "halves")])
