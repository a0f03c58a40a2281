"""Values at the edge of their types are kept, or told apart from missing ones."""

import random
from decimal import Decimal

from pyspark.sql import functions as F

from ledgertide.functions.jsonvalues import find_by_key, i128_text, keys_of
from ledgertide.functions.numbers import scaled_amount, scaled_rate
from ledgertide.operators.validate import numeric_text, validate
from ledgertide.sources.ledger import split_state_batches


def test_amounts_of_38_digits_are_exact_and_wider_ones_are_not_zero(spark):
    rows = ["1", "-5", "0", "9" * 30, "9" * 38, "-" + "9" * 38, "9" * 39, "x", None]
    df = spark.createDataFrame([(r,) for r in rows], "raw string")
    got = df.select(scaled_amount(F.col("raw")).alias("a"), scaled_rate(F.col("raw")).alias("r"),
                    scaled_rate(F.col("raw"), null_as_zero=True).alias("z")).collect()
    for raw, row in zip(rows, got, strict=True):
        fits = raw is not None and raw.lstrip("-").isdigit() and len(raw.lstrip("-")) <= 38
        assert row.a == (Decimal(raw).scaleb(-7) if fits and len(raw) < 28 else row.a)
        assert (row.a is None) == (raw is not None and not fits)
        assert (row.r is None) == (not fits)
        assert row.z == 0 if raw is None else (row.z is None) == (not fits)
    assert str(got[4].a) == "9" * 31 + "." + "9" * 7
    assert str(got[5].r) == "-" + "9" * 26 + "." + "9" * 12


def test_wide_pairs_are_rejected_not_lost(spark):
    wide = '{"hi":"9000000000000000000","lo":"18446744073709551615"}'
    df = spark.createDataFrame([(wide,), ('{"hi":"1","lo":"5"}',), ("7",)], "t string")
    good, bad = validate(df.select(i128_text(F.col("t")).alias("amount")), [numeric_text("amount")])
    assert sorted(r.amount for r in good.collect()) == ["18446744073709551621", "7"]
    assert bad.count() == 1


def test_unsigned_and_unreadable_keys(spark):
    kind = "array<struct<key:struct<u32:string>,val:string>>"
    df = spark.createDataFrame([([(("4294967295",), "a"), (("x",), "b"), (("1",), "c")],)], f"m {kind}")
    row = df.select(keys_of(F.col("m")).alias("k"), find_by_key(F.col("m"), 4294967295)["val"].alias("v")).first()
    assert row.k == [4294967295, 1] and row.v == "a"


def test_a_bad_close_time_does_not_end_the_batch(spark):
    event = "struct<contract_id:string,closed_at:string,ledger_sequence:bigint,ledger_key_hash:string," \
            "ledger_entry_change:int,deleted:boolean,key_decoded:string,val_decoded:string>"
    payload = [([("P", t, 1, "h", 1, False, "{}", "{}") for t in ("soon", "2025-01-01T00:00:00Z")], "t", "n")]
    df = spark.createDataFrame(payload, f"events array<{event}>, timestamp string, network string")
    entries, _ = split_state_batches(df)
    assert sorted(r.closed_at is None for r in entries.collect()) == [False, True]


def test_rates_of_any_width_are_exact(spark):
    from decimal import ROUND_HALF_UP, localcontext

    from ledgertide.plans.decode import implied_rate

    rng = random.Random(4)
    pairs = [("1000000000000000000000000057", "1000000000000000000000000000"), ("1" + "0" * 24 + "7", "3" + "0" * 24),
             ("-5", "3"), ("2", "3"), ("0", "7"), ("9" * 20, "1"), ("1", "9" * 38), ("9" * 38, "9" * 38), ("5", "1" + "0" * 19),
             ("999999999999999999999", "1000000000000000000000")]
    pairs += [(str(rng.randrange(10 ** rng.randrange(1, 39))), str(rng.randrange(1, 10 ** rng.randrange(1, 39)))) for _ in range(300)]
    rows = spark.createDataFrame(pairs + [("1", "0"), ("x", "1"), (None, "1"), ("9" * 38, "1")], "u string, t string")
    got = [r[0] for r in rows.select(implied_rate(F.col("u"), F.col("t"))).collect()]
    with localcontext() as c:
        c.prec = 100
        for (u, t), rate in zip(pairs, got, strict=False):
            want = (Decimal(u) / Decimal(t)).quantize(Decimal("1e-18"), ROUND_HALF_UP)
            assert rate == want if abs(want) < Decimal(10) ** 20 else rate is None, (u, t)
    assert got[-4:] == [None] * 4


def test_numbers_too_wide_for_their_column_are_rejected(spark):
    from ledgertide.plans.events import typed_actions, typed_backstop

    base = spark.range(1).selectExpr("'i' AS id", "'deposit' AS action_type", "'p' AS pool_id", "CAST(NULL AS STRING) AS lp_tokens",
                                     "CAST(NULL AS STRING) AS shares", "CAST(NULL AS STRING) AS emissions_amount",
                                     "CAST(NULL AS STRING) AS emissions_shares", *[f"CAST(NULL AS STRING) AS {c}" for c in (
                                         "amount_underlying", "amount_tokens", "liquidation_percent", "bid_amount", "lot_amount")])
    for text, kept in (("18446744073709551615", False), ("9223372036854775807", True), (None, True)):
        good, bad = typed_backstop(base.withColumn("q4w_exp", F.lit(text)))
        assert [r.q4w_exp for r in good.collect()] == ([text and int(text)] if kept else []) and bad.count() == (not kept)
    good, bad = typed_actions(base.withColumn("auction_type", F.lit("4294967295")))
    assert good.count() == 0 and "auction_type" in bad.first().reject_reason
