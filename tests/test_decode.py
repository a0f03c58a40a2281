import hashlib
import json

import pytest
from pyspark.sql import functions as F

from ledgertide import schemas
from ledgertide.functions import i128_text, json_scalar
from ledgertide.plans import decode, events, positions, snapshots
from tests import samples as s

IDENTITY = decode.ACTION_IDENTITY


def raw_events(spark, rows):
    return spark.createDataFrame(rows, schemas.CONTRACT_EVENTS)


def state(spark, rows):
    return spark.createDataFrame(rows, schemas.CONTRACT_DATA)


@pytest.mark.parametrize("number", [s.flat, s.split], ids=["scalar", "hi_lo"])
def test_every_lending_action(spark, number):
    cases = s.lending_cases(number)
    rows = [s.event(100 + i, topics, data) for i, (topics, data, _) in enumerate(cases.values())]
    got = {r["action_type"]: r.asDict() for r in events.lending_table(raw_events(spark, rows), [s.POOL]).collect()}
    assert set(got) == set(cases)
    for action, (_, _, expected) in cases.items():
        for field, value in expected.items():
            assert got[action][field] == value, (action, field)
    assert float(got["supply"]["implied_rate"]) == pytest.approx(1000 / 900, abs=1e-15)
    assert [tuple(x) for x in got["new_auction"]["bid_assets"]] == [("CBID", "70")]


def test_identity_is_over_parsed_texts(spark):
    topics, data, _ = s.lending_cases(s.flat)["supply"]
    row = events.lending_table(raw_events(spark, [s.event(7, topics, data)])).collect()[0].asDict()
    text = "".join("" if row[c] is None else str(row[c]) for c in IDENTITY)
    assert row["id"] == "7-" + hashlib.sha256(text.encode()).hexdigest()[:16]


def test_both_encodings_have_one_identity(spark):
    a, b = (s.lending_cases(n)["borrow"] for n in (s.flat, s.split))
    rows = [s.event(7, a[0], a[1]), s.event(7, b[0], b[1], tx="tx7")]
    assert events.lending_table(raw_events(spark, rows)).count() == 1


@pytest.mark.parametrize("number", [s.flat, s.split], ids=["scalar", "hi_lo"])
def test_every_backstop_action(spark, number):
    cases = s.backstop_cases(number)
    rows = [s.event(200 + i, [s.sym(a), *topics], data, contract=s.BACKSTOP)
            for i, (a, (topics, data, _)) in enumerate(cases.items())]
    got = {r["action_type"]: r.asDict() for r in events.backstop_table(raw_events(spark, rows), s.BACKSTOP).collect()}
    assert set(got) == set(cases)
    for action, (_, _, expected) in cases.items():
        for field, value in expected.items():
            assert got[action][field] == value, (action, field)


def test_irrelevant_events_are_left_out(spark):
    topics, data, _ = s.lending_cases(s.flat)["supply"]
    rows = [
        s.event(1, topics, data), s.event(2, topics, data, ok=False), s.event(3, topics, data, op=None),
        s.event(4, topics, data, contract="COTHER"), s.event(5, [s.sym("set_admin")], data),
        s.event(6, [{"u32": 4}], data)]
    assert [r["ledger_sequence"] for r in events.lending_table(raw_events(spark, rows), [s.POOL]).collect()] == [1]


def test_date_bounds_hold_whole_days(spark):
    topics, data, _ = s.lending_cases(s.flat)["supply"]
    days = [s.AT.replace(day=d, hour=23, minute=59) for d in (1, 2, 3)]
    rows = [s.event(d.day, topics, data, at=d) for d in days]
    got = events.lending_table(raw_events(spark, rows), start_date="2025-05-02", end_date="2025-05-02")
    assert [r["ledger_sequence"] for r in got.collect()] == [2]
    assert events.lending_table(raw_events(spark, rows), limit=1).collect()[0]["ledger_sequence"] == 1


def test_zero_tokens_have_no_rate_and_wide_numbers_are_rejected(spark):
    topics, _, _ = s.lending_cases(s.flat)["supply"]
    rows = [s.event(1, topics, {"vec": [s.flat(5), s.flat(0)]}), s.event(2, topics, {"vec": [s.flat(s.BIG), s.flat(1)]})]
    valid, rejects = events.typed_actions(events.lending_table(raw_events(spark, rows)))
    ok = valid.collect()
    assert [(r["ledger_sequence"], r["implied_rate"]) for r in ok] == [(1, None)]
    assert [r["reject_reason"] for r in rejects.collect()] == ["amount_underlying is not a 38-digit number"]


def test_bare_array_auction_gives_only_its_head(spark):
    rows = [
        s.event(1, [s.sym("new_auction"), {"u32": 0}, s.adr(s.USER)], [{"u32": 33}, s.auction(s.flat)]),
        s.event(2, [s.sym("fill_auction"), {"u32": 0}, s.adr(s.USER)], [s.adr("GFILL"), s.flat(50)]),
        s.event(3, [s.sym("fill_auction"), {"u32": 0}, s.adr(s.USER)], [{"address": "GFILL"}])]
    got = {r["ledger_sequence"]: r for r in events.lending_table(raw_events(spark, rows)).collect()}
    assert got[1]["liquidation_percent"] == "33" and got[1]["bid_asset"] is None
    assert got[2]["filler_address"] == "GFILL" and got[2]["liquidation_percent"] is None


def test_auction_user_falls_back_to_second_topic(spark):
    rows = [s.event(1, [s.sym("new_auction"), s.adr("GONLY")], {"vec": [{"u32": 1}]})]
    assert events.lending_table(raw_events(spark, rows)).collect()[0]["user_address"] == "GONLY"


def test_scalar_guard_and_wide_integers(spark):
    docs = [('{"a":{"b":1}}',), ('{"a":[1]}',), ('{"a":"x"}',), ('{"a":7}',), ("not json",)]
    df = spark.createDataFrame(docs, "j string")
    assert [r[0] for r in df.select(json_scalar(F.col("j"), "$.a")).collect()] == [None, None, "x", "7", None]
    texts = [("12",), ('{"hi":0,"lo":5}',), ('{"hi":1,"lo":5}',), ('{"hi":-1,"lo":18446744073709551615}',), ("[1]",), (None,)]
    t = spark.createDataFrame(texts, "t string")
    assert [r[0] for r in t.select(i128_text(F.col("t"))).collect()] == [
        "12", "5", str(2**64 + 5), "-1", None, None]
    assert [r[0] for r in t.select(i128_text(F.col("t"), low_word_only=True)).collect()][2] == "5"


def test_positions_by_key_and_by_place(spark):
    val = s.positions({3: 10, 1: 20}, {}, {5: 30})
    df = state(spark, [s.entry("Positions", s.USER, val, 1), s.entry("Positions", s.USER, val, 2, deleted=True),
                       s.entry("Positions", s.USER, s.positions({}, {}, {}), 3)])
    by_key = {r["reserve_index"]: (r["supply_raw"], r["collateral_raw"], r["liabilities_raw"])
              for r in decode.decode_positions(df, "key").collect()}
    assert by_key == {3: (None, "10", None), 1: (None, "20", None), 5: ("30", None, None)}
    by_place = {r["reserve_index"]: (r["supply_raw"], r["collateral_raw"])
                for r in decode.decode_positions(df, "position").collect()}
    assert by_place == {0: ("30", "10"), 1: (None, "20")}
    with pytest.raises(ValueError):
        decode.decode_positions(df, "other")


def test_maps_named_by_symbols(spark):
    inner = lambda n: {"map": [{"key": {"u32": 4}, "val": s.flat(n)}]}
    val = {"map": [{"key": s.sym(k), "val": inner(n)} for k, n in (("collateral", 1), ("liabilities", 2), ("supply", 3))]}
    names = ("b_rate", "b_supply", "backstop_credit", "d_rate", "d_supply", "ir_mod", "last_time")
    res = {"map": [{"key": s.sym(k), "val": s.flat(10**12 * (i + 1))} for i, k in enumerate(names[:6])]}
    df = state(spark, [s.entry("Positions", s.USER, val, 1), s.entry("ResData", s.ASSET, res, 2)])
    row = decode.decode_positions(df).collect()[0]
    assert (row["reserve_index"], row["supply_raw"], row["collateral_raw"], row["liabilities_raw"]) == (4, "3", "1", "2")
    rates = decode.decode_reserve_state(df).collect()[0]
    assert (float(rates["b_rate"]), float(rates["d_rate"])) == (1.0, 4.0)


def test_more_than_sixteen_reserves(spark):
    val = s.positions({}, {}, {i: i + 1 for i in range(20)})
    assert decode.decode_positions(state(spark, [s.entry("Positions", s.USER, val, 1)]), "position").count() == 20


def test_all_zero_rows_count_for_presence_but_not_for_amount(spark):
    df = state(spark, [s.entry("Positions", s.USER, s.positions({0: 0}, {}, {1: 5}), 1)])
    rows = decode.decode_positions(df, "key")
    assert rows.count() == 2
    assert [r["reserve_index"] for r in decode.has_amount(rows).collect()] == [1]


def test_reserve_state_config_and_mapping(spark):
    df = state(spark, [
        s.entry("ResData", s.ASSET, s.reserve(1_100_000_000_000, 1_200_000_000_000), 5),
        s.entry("ResConfig", s.ASSET, s.config(2), 6), s.entry("ResConfig", "COTHER", s.config(2), 7),
        s.entry("ResConfig", "CGONE", None, 8, deleted=True)])
    row = decode.decode_reserve_state(df).collect()[0]
    assert (float(row["b_rate"]), float(row["d_rate"]), float(row["b_supply"]), row["last_time"]) == (1.1, 1.2, 1.0, 1_700_000_000)
    configs = {r["asset_address"]: r["reserve_index"] for r in decode.decode_reserve_config(df).collect()}
    assert configs == {s.ASSET: 2, "COTHER": 2, "CGONE": -1}
    assert decode.reserve_mapping(df).count() == 2
    assert [r["asset_address"] for r in decode.reserve_mapping(df, latest_only=True).collect()] == ["COTHER"]
    kinds = df.select(decode.entry_type(F.col("key_decoded"))).distinct().collect()
    assert {r[0] for r in kinds} == {"ResData", "ResConfig"}


def test_missing_rates_stay_null_in_backfills_and_become_zero_in_the_feed(spark):
    df = state(spark, [s.entry("ResData", s.ASSET, s.keyed((1, s.flat(10))), 5)])
    assert decode.decode_reserve_state(df).collect()[0]["b_rate"] is None
    assert decode.decode_reserve_state(df, null_rate_as_zero=True).collect()[0]["b_rate"] == 0


def test_daily_snapshot_keeps_nulls_of_the_latest_row(spark):
    early = s.entry("ResData", s.ASSET, s.reserve(10**12, 10**12), 5)
    late = s.entry("ResData", s.ASSET, s.keyed((3, s.flat(2 * 10**12))), 6, at=s.AT.replace(hour=13))
    got = snapshots.pool_snapshots(state(spark, [late, early]), [s.POOL], "2025-05-01", "2025-05-01", mode="key").collect()
    assert len(got) == 1 and got[0]["b_rate"] is None and float(got[0]["d_rate"]) == 2.0 and got[0]["ledger_sequence"] == 6


def test_position_query_is_empty_for_an_unverified_asset(spark):
    rows = [s.entry("Positions", s.USER, s.positions({}, {}, {0: 50_000_000}), 10),
            s.entry("ResData", s.ASSET, s.reserve(10**12, 2 * 10**12), 9)]
    df = state(spark, rows)
    hit = positions.asset_position_changes(df, s.POOL, s.ASSET, 0, start_date="2025-05-01").collect()
    assert [(float(r["supply_btokens"]), float(r["b_rate"]), float(r["d_rate"])) for r in hit] == [(5.0, 1.0, 2.0)]
    assert positions.asset_position_changes(df, s.POOL, "CNOPE", 0, start_date="2025-05-01").count() == 0


def test_backstop_balance_of_an_empty_pool(spark):
    val = {"map": [{"key": s.sym("q4w"), "val": s.flat(5)}, {"key": s.sym("shares"), "val": s.flat(0)},
                   {"key": s.sym("tokens"), "val": s.flat(1)}]}
    df = state(spark, [s.entry("PoolBalance", s.POOL, val, 1, contract=s.BACKSTOP, deleted=True)])
    assert snapshots.backstop_balances(df, s.BACKSTOP).collect()[0]["q4w_pct"] == 0


def test_lp_price_needs_both_entries_on_one_ledger(spark):
    record = {"map": [{"key": s.adr("Q"), "val": {"map": [{"key": s.sym("balance"), "val": s.flat(200)}]}}]}
    df = state(spark, [
        s.entry("TotalShares", None, {"i128": "500"}, 1, contract="LP"), s.entry("AllRecordData", None, record, 1, contract="LP"),
        s.entry("TotalShares", None, {"i128": "100"}, 2, contract="LP")])
    got = snapshots.lp_prices(df, "LP").collect()
    assert [(r["lp_token_price"], r["ledger_sequence"]) for r in got] == [(2.0, 1)]


def test_payload_with_numbers_instead_of_texts(spark):
    rows = [s.event(1, [s.sym("supply"), s.adr(s.ASSET), s.adr(s.USER)], {"vec": [{"i128": 12}, {"i128": 10}]})]
    got = events.lending_table(raw_events(spark, rows)).collect()[0]
    assert (got["amount_underlying"], got["amount_tokens"]) == ("12", "10")
    assert json.loads(rows[0][9])["vec"][0]["i128"] == 12


def test_spans_of_an_index_follow_takeover_restatement_deletion_and_move(spark):
    rows = [s.entry("ResConfig", "CA", s.config(0), 10), s.entry("ResConfig", "CA", s.config(0), 15),
            s.entry("ResConfig", "CB", s.config(0), 20), s.entry("ResConfig", "CB", None, 30, deleted=True),
            s.entry("ResConfig", "CC", s.config(1), 12), s.entry("ResConfig", "CC", s.config(2), 40),
            s.entry("ResConfig", "CD", s.config(3), 50), s.entry("ResConfig", "CD", None, 50, deleted=True),
            s.entry("ResConfig", "CE", s.config(4), 60), s.entry("ResConfig", "CF", s.config(4), 60)]
    spans = decode.reserve_validity(state(spark, rows)).collect()
    assert sorted((r.reserve_index, r.asset_address, r.from_ledger, r.until_ledger or 0) for r in spans) == [
        (0, "CA", 10, 20), (0, "CB", 20, 30), (1, "CC", 12, 40), (2, "CC", 40, 0), (4, "CF", 60, 0)]
    held = [s.entry("Positions", s.USER, s.positions({0: n}, {}, {}), n) for n in (9, 10, 19, 20, 29, 30)]
    got = positions.all_assets_changes(state(spark, rows + held), then_valid=True, start_date="2025-01-01").collect()
    assert sorted((r.ledger_sequence, r.asset_address or "") for r in got) == [
        (9, ""), (10, "CA"), (19, "CA"), (20, "CB"), (29, "CB"), (30, "")]
    rated = positions.position_changes_with_rates(
        state(spark, rows + held + [s.entry("ResData", "CA", s.reserve(2 * 10**12, 10**12), 18)]), then_valid=True, start_date="2025-01-01")
    assert sorted((r.ledger_sequence, r.asset_address, r.b_rate and float(r.b_rate)) for r in rated.collect()) == [
        (10, "CA", None), (19, "CA", 2.0), (20, "CB", None), (29, "CB", None)]


def test_no_configuration_gives_no_spans(spark):
    assert decode.reserve_validity(state(spark, [])).collect() == []


def test_an_lp_ledger_of_several_entries_is_priced_once(spark):
    many = [s.entry("TotalShares", None, s.flat(n), 7) for n in (0, 200, 100)]
    many += [s.entry("AllRecordData", None, s.keyed((0, s.keyed((0, s.flat(q))))), 7) for q in (10, 40)]
    one = snapshots.lp_prices(state(spark, many)).collect()
    assert [(r.lp_token_price, r.ledger_sequence) for r in one] == [(2.0, 7)]


def test_entries_are_found_by_generated_code(spark):
    """The first entry of a key, whatever else the map holds, without a lambda per entry."""
    from ledgertide.functions.jsonvalues import find_by_key, keys_of

    rows = spark.sql("""SELECT from_json('[{"key":{"u32":"x"},"val":"a"},{"key":null,"val":"b"},null,{"key":{"u32":" 3 "},"val":"c"},
      {"key":{"u32":"4294967295"},"val":"d"},{"key":{"u32":"3"},"val":"e"}]', 'array<struct<key:struct<u32:string>,val:string>>') AS m""")
    found = rows.select(keys_of(F.col("m")).alias("keys"), *[find_by_key(F.col("m"), k)["val"].alias(f"v{i}") for i, k in enumerate(
        (3, 4, F.lit(4294967295), F.lit(None).cast("bigint")))], find_by_key(F.lit(None).cast(rows.schema["m"].dataType), 3)["val"].alias("none"))
    assert tuple(found.first()) == ([3, 4294967295], "c", None, "d", None, None)
    assert "lambdafunction" not in found._jdf.queryExecution().analyzed().toString()
