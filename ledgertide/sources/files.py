"""File imports: event CSVs and price payloads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..constants import PRICE_BACKFILL, SRC_CSV
from ..functions.timewindow import parse_day, parse_instant
from ..functions.wellformed import is_iso_day, null_if_blank
from ..operators.validate import ACTION_RULES, BACKSTOP_RULES, Rule, typed_text, validate

ACTION_CSV_REQUIRED = ("id", "pool_id", "action_type", "ledger_sequence")
BACKSTOP_CSV_REQUIRED = ("id", "action_type", "ledger_sequence")


def _read_csv(spark: SparkSession, path: str, required: Sequence[str], columns: Sequence[str]) -> DataFrame:
    raw = (
        spark.read.option("header", True).option("ignoreLeadingWhiteSpace", True)
        .option("ignoreTrailingWhiteSpace", True).option("multiLine", True).option("escape", '"').csv(path)
    )
    named = raw.toDF(*[c.strip().lower() for c in raw.columns])
    missing = [c for c in required if c not in named.columns]
    if missing:
        raise ValueError(f"Missing required columns: {', '.join(missing)}")
    for c in columns:
        if c not in named.columns:
            named = named.withColumn(c, F.lit(None).cast("string"))
    return named.select([null_if_blank(F.trim(F.col(c))).alias(c) for c in columns])


def _type_rules(schema: T.StructType, columns: Sequence[str]) -> list[Rule]:
    """No text is stored as another number or time; the ledger alone is read by its leading digits."""
    return [typed_text(f.name, f.dataType) for f in schema.fields
            if f.name in columns and f.name != "ledger_sequence" and isinstance(f.dataType, (T.NumericType, T.TimestampType))]


def _with_defaults(df: DataFrame) -> DataFrame:
    # The ledger text counts as far as its leading digits go, as parseInt reads it.
    ledger = F.regexp_extract(F.col("ledger_sequence"), r"^([+-]?\d+)", 1).try_cast("long")
    return df.withColumns({
        "transaction_hash": F.coalesce("transaction_hash", F.lit("")),
        "ledger_sequence": F.coalesce(ledger, F.lit(0)),
        "ledger_closed_at": F.coalesce(parse_instant(F.col("ledger_closed_at")), F.current_timestamp()),
        "src": F.lit(SRC_CSV),
    })


def read_csv_actions(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Lending-event CSV → ``(rows of parsed_events, rejects)``.

    Header names are case-insensitive, cells are trimmed, blank lines skipped; a
    missing essential column fails the import, a row without id, pool or action
    is rejected, and so is one with an unreadable time or a number that its
    column cannot hold as it is. A missing time is the time of the import.
    """
    cols = [c for c in schemas.PARSED_EVENTS.names if c not in ("bid_assets", "lot_assets", "src")]
    raw = _read_csv(spark, path, ACTION_CSV_REQUIRED, cols)
    valid, rejects = validate(raw, [*ACTION_RULES(), *_type_rules(schemas.PARSED_EVENTS, cols)])
    return schemas.conform(_with_defaults(valid), schemas.PARSED_EVENTS), rejects


def read_csv_backstop(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Backstop-event CSV → ``(rows of backstop_events, rejects)``."""
    cols = [c for c in schemas.BACKSTOP_EVENTS.names if c != "src"]
    raw = _read_csv(spark, path, BACKSTOP_CSV_REQUIRED, cols)
    valid, rejects = validate(raw, [*BACKSTOP_RULES(), *_type_rules(schemas.BACKSTOP_EVENTS, cols)])
    return schemas.conform(_with_defaults(valid), schemas.BACKSTOP_EVENTS), rejects


_PRICE_ROW = "price_date string, lp_token_price string, ledger_sequence long"


def read_price_json(spark: SparkSession, path: str) -> DataFrame:
    """LP price rows from NDJSON (``.ndjson``/``.jsonl``), a JSON array or ``{rows: […]}``."""
    if path.endswith((".ndjson", ".jsonl")):
        return spark.read.schema(_PRICE_ROW).json(path)
    # The layout is a property of the file, so it shows in its inferred columns.
    found = spark.read.option("multiLine", True).json(path).columns
    if "rows" in found:
        wrapped = spark.read.schema(f"rows array<struct<{_PRICE_ROW.replace(' ', ':').replace(',:', ',')}>>")
        return wrapped.option("multiLine", True).json(path).select(F.inline("rows"))
    if "price_date" in found:
        return spark.read.schema(_PRICE_ROW).option("multiLine", True).json(path)
    raise ValueError("Unexpected JSON format: expected rows of price_date and lp_token_price")


def validate_prices(rows: DataFrame, token_address: str, source: str = PRICE_BACKFILL) -> tuple[DataFrame, DataFrame]:
    """Price rows → ``(rows of daily_token_prices, rejects)``: a day, and a number above 0."""
    day = F.split_part(F.col("price_date"), F.lit("T"), F.lit(1))
    price = F.col("lp_token_price").try_cast("double")
    valid, rejects = validate(rows.withColumns({"_day": day, "_price": price}), [
        Rule("invalid date format", ~is_iso_day(F.col("_day"))),
        Rule("invalid price", F.col("_price").isNull() | F.isnan("_price") | (F.col("_price") <= 0)),
    ])
    return valid.select(
        F.lit(token_address).alias("token_address"), parse_day(F.col("_day")).alias("price_date"),
        F.col("_price").alias("usd_price"), F.lit(source).alias("source"),
    ), rejects.drop("_day", "_price")


def read_price_series(spark: SparkSession, path: str) -> DataFrame:
    """Landed market series ``{prices: [[epoch_ms, price], …]}`` → (day, price, instant)."""
    payload = spark.read.schema(schemas.PRICE_SERIES).option("multiLine", True).json(path)
    return series_points(payload)


def series_points(payload: DataFrame) -> DataFrame:
    point = F.col("p")
    at = F.timestamp_millis(F.get(point, 0).cast("long"))
    return payload.select(F.explode("prices").alias("p")).select(
        at.alias("at"), F.to_date(at).alias("price_date"), F.get(point, 1).alias("price"))


def read_bond_history(spark: SparkSession, path: str) -> DataFrame:
    """Landed bond history ``{historyRange: [{date, tokenPrice, usdExchangeRate}]}``."""
    payload = spark.read.schema(schemas.BOND_HISTORY).option("multiLine", True).json(path)
    return bond_points(payload)


def bond_points(payload: DataFrame) -> DataFrame:
    return payload.select(F.posexplode("historyRange").alias("position", "h")).select(
        "position", parse_day(F.col("h")["date"]).alias("price_date"),
        F.col("h")["tokenPrice"].try_cast("double").alias("token_price"),
        F.col("h")["usdExchangeRate"].try_cast("double").alias("fx_rate"),
    )


def read_fx(spark: SparkSession, path: str) -> DataFrame:
    """Landed exchange rates ``{rates: {code: {value, type}}}`` → one row per currency."""
    payload = spark.read.schema(schemas.EXCHANGE_RATES).option("multiLine", True).json(path)
    return fx_rows(payload)


def fx_rows(payload: DataFrame) -> DataFrame:
    return payload.select(F.explode("rates").alias("code", "info")).select(
        F.upper("code").alias("currency"), F.col("info")["value"].alias("value"), F.col("info")["type"].alias("type"))
