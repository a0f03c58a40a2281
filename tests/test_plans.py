import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from ledgertide import schemas
from ledgertide.plans import events, explore, feed, prices, refdata, search, yields
from ledgertide.sources import files, ledger
from tests import samples as s

H = "user_address string, pool_id string, asset_address string, action_type string, amount_tokens decimal(38,0), amount_underlying decimal(38,0)"


def history(spark, rows):
    return spark.createDataFrame([(u, p, a, k, t, t) for u, p, a, k, t in rows], "u string, p string, a string, k string, t long, t2 long").toDF(
        "user_address", "pool_id", "asset_address", "action_type", "amount_tokens", "amount_underlying").withColumn(
        "ledger_closed_at", F.lit("2024-01-01 00:00:00").cast("timestamp"))


U = 10_000_000


def test_balance_filters(spark):
    h = history(spark, [("u1", "p", "A", "supply", 10 * U), ("u1", "p", "A", "borrow", 4 * U), ("u1", "p", "B", "supply", U),
                        ("u2", "p", "A", "supply", 10 * U), ("u3", "p", "A", "supply_collateral", 3 * U), ("u3", "p", "B", "supply", 5 * U)])
    rates = spark.createDataFrame([("p", "A", date(2024, 1, 1), 9.0, 9.0), ("p", "A", date(2024, 1, 2), 2.0, 1.5)],
                                  "pool_id string, asset_address string, rate_date date, b_rate double, d_rate double")
    back = spark.createDataFrame([("u1",), (None,)], "user_address string")
    f = explore.TokenFilter

    def users(filters, **kw):
        return {r["user_address"]: r["net_balance"] for r in explore.accounts_by_balance(h, rates, filters, backstop_events=back, **kw).collect()}

    assert users([f("A", min_amount=6)]) == {"u1": 14.0, "u2": 20.0, "u3": 6.0}
    assert users([f("A", min_amount=6), f("B", min_amount=2)]) == {"u3": 6.0}
    assert users([f("A"), f("A", min_amount=15)]) == {"u2": 20.0}
    assert set(users([f("A")], has_borrows=True)) == {"u1"}
    assert set(users([f("A")], has_borrows=False)) == {"u2", "u3"}
    assert set(users([f("A")], has_backstop=True)) == {"u1"}
    assert set(users([f("A")], has_backstop=False)) == {"u2", "u3"}
    assert set(users([f("A", "AAA", 30)], in_usd=True, prices={"AAA": 2.0})) == {"u2"}
    assert users([]) == {}


def test_event_counts_with_no_types_select_nothing(spark):
    h = history(spark, [("u1", "p", "A", "supply", 1), ("u1", "p", "A", "claim", 1), ("u1", "p", "A", "claim", 1)])
    assert explore.accounts_by_event_count(h, [], 1).count() == 0
    row = explore.accounts_by_event_count(h, ["supply", "claim"], 3).collect()[0]
    assert row["events_by_type"] == {"supply": 1, "claim": 2} and row["first_event_date"] == "2024-01-01T00:00:00Z"


def test_thresholds():
    assert explore.native_threshold(10, 2.0, True) == 5 and explore.native_threshold(10, 0.0, True) == 10
    assert explore.native_threshold(10, 2.0, False) == 10


def test_pool_without_events_and_inactive_pool(spark):
    pools = spark.createDataFrame([("p", "Pool", "P", True), ("q", "Quiet", "Q", True), ("x", "Off", "X", False)], "pool_id string, name string, short_name string, is_active boolean")
    out = {r["pool_id"]: r for r in explore.pool_statistics(pools, history(spark, [("u", "p", "A", "supply", 1)])).collect()}
    assert set(out) == {"p", "q"} and out["q"]["event_count"] == 0 and out["q"]["unique_event_types"] == []
    assert out["p"]["total_count"] == 2


def test_metrics_of_an_empty_range_are_zero(spark):
    h = history(spark, [("u", "p", "A", "supply", U)])
    tokens = spark.createDataFrame([("A", "AAA", "a", None, None)], TOKENS)
    no_prices = spark.createDataFrame([], "symbol string, price double")
    row = explore.aggregate_metrics(h, tokens, no_prices, "2030-01-01", "2031-01-01").collect()[0]
    assert (row["total_deposits"], row["total_events"], row["active_accounts"], row["net_flow_usd"]) == (0.0, 0, 0, 0.0)
    row = explore.aggregate_metrics(h, tokens, no_prices).collect()[0]
    assert (row["total_deposits"], row["total_deposits_usd"], row["active_accounts"]) == (1.0, 0.0, 1)


def test_feed_of_one_table(spark):
    back = spark.createDataFrame([("b1", "p", 5)], "id string, pool_address string, ledger_sequence long").select(
        "*", F.current_timestamp().alias("ledger_closed_at"), F.lit("deposit").alias("action_type"), F.lit("u").alias("user_address"),
        F.lit(3).cast("decimal(38,0)").alias("lp_tokens"), F.lit("t").alias("transaction_hash"))
    rows = feed.live_feed(back, back, "p", include_actions=False).collect()
    assert [(r["source"], r["asset_address"]) for r in rows] == [("backstop", None)]


# --- prices -------------------------------------------------------------------

TOKENS = "asset_address string, symbol string, name string, coingecko_id string, pegged_currency string"


def test_pegged_prices(spark):
    tokens = spark.createDataFrame([("A", "A", "a", "x", None), ("U", "U", "u", None, "usd"), ("E", "E", "e", None, "eur"), ("X", "X", "x", None, "xyz")], TOKENS)
    days = prices.pegged_usd_days(tokens, "2024-01-01", "2024-01-03").collect()
    assert [(r["token_address"], str(r["price_date"]), r["usd_price"], r["source"]) for r in days] == [
        ("U", f"2024-01-0{d}", 1.0, "pegged") for d in (1, 2, 3)]
    assert [r["asset_address"] for r in prices.priced_tokens(tokens).collect()] == ["A"]
    fx = spark.createDataFrame([("EUR", 0.5, "fiat"), ("USD", 1.0, "fiat"), ("ETH", 2.0, "crypto"), ("ZZZ", 0.0, "fiat")], "currency string, value double, type string")
    rates = {r["currency"]: r["usd_value"] for r in prices.usd_rates(fx).collect()}
    assert rates == {"USD": 1.0, "EUR": 2.0}
    today = {r["token_address"]: r["usd_price"] for r in prices.pegged_today(tokens, prices.usd_rates(fx), "2024-01-05").collect()}
    assert today == {"U": 1.0, "E": 2.0}


def test_fallback_exchange_rates(spark):
    fx = spark.createDataFrame([("EUR", 0.5, "fiat")], "currency string, value double, type string")
    assert {r["currency"]: r["usd_value"] for r in prices.usd_rates(fx).collect()} == {"USD": 1.0, "EUR": 1.05, "GBP": 1.27}


def test_oracle_price_of_the_first_pool_counts(spark):
    feed_rows = spark.createDataFrame([("p1", "A", 0.0), ("p2", "A", 5.0), ("p2", "B", 3.0), ("p1", "P", 1.0)], "pool_id string, asset_id string, oracle_price double")
    order = spark.createDataFrame([("p1", 1), ("p2", 2)], "pool_id string, pool_rank int")
    tokens = spark.createDataFrame([("P", "P", "p", None, "USD")], TOKENS)
    got = prices.oracle_prices(feed_rows, order, tokens, "2024-01-01").collect()
    assert [(r["token_address"], r["usd_price"]) for r in got] == [("B", 3.0)]


def test_landed_payloads(spark, tmp_path):
    (tmp_path / "series.json").write_text(json.dumps({"prices": [[1704067200000, 1.0], [1704070800000, 2.0], [1704153600000, 3.0]]}))
    series = files.read_price_series(spark, str(tmp_path / "series.json"))
    stored = spark.createDataFrame([("T", date(2024, 1, 2))], "token_address string, price_date date")
    got = prices.from_series(series, "T", stored).collect()
    assert [(str(r["price_date"]), r["usd_price"]) for r in got] == [("2024-01-01", 2.0)]
    (tmp_path / "bond.json").write_text(json.dumps({"historyRange": [
        {"date": "2024-01-01T01:00:00Z", "tokenPrice": "10", "usdExchangeRate": "5", "statusType": "x"},
        {"date": "2024-01-01T09:00:00Z", "tokenPrice": "12", "usdExchangeRate": "4", "statusType": "x"}]}))
    bond = prices.from_bond_history(files.read_bond_history(spark, str(tmp_path / "bond.json")), "B").collect()
    assert [r["usd_price"] for r in bond] == [3.0]
    (tmp_path / "fx.json").write_text(json.dumps({"rates": {"usd": {"value": 2.0, "type": "fiat"}, "eur": {"value": 1.0, "type": "fiat"}}}))
    assert {r["currency"] for r in files.read_fx(spark, str(tmp_path / "fx.json")).collect()} == {"USD", "EUR"}


def test_unpriced_token_shows_one_day_as_stored_or_none_as_fixed(spark):
    tokens = spark.createDataFrame([("A", "A", "a", None, None)], TOKENS)
    none = spark.createDataFrame([], schemas.DAILY_TOKEN_PRICES)
    assert prices.price_coverage(tokens, none).collect()[0]["days"] == 1
    assert prices.price_coverage(tokens, none, count_unpriced=False).collect()[0]["days"] == 0
    assert prices.token_price_statistics(tokens, none).collect()[0]["source_counts"] == {}


# --- imports ------------------------------------------------------------------

def test_csv_of_actions(spark, tmp_path):
    (tmp_path / "a.csv").write_text(
        "ID, Pool_Id ,ACTION_TYPE,Ledger_Sequence,amount_underlying\n 1-a , P1 ,supply, 12 ,500\n\n,P1,supply,13,1\n2-b,P2,claim,x,\n")
    valid, rejects = files.read_csv_actions(spark, str(tmp_path / "a.csv"))
    got = {r["id"]: r for r in valid.collect()}
    assert set(got) == {"1-a", "2-b"} and got["1-a"]["pool_id"] == "P1" and int(got["1-a"]["amount_underlying"]) == 500
    assert got["2-b"]["ledger_sequence"] == 0 and got["2-b"]["amount_underlying"] is None
    assert got["2-b"]["transaction_hash"] == "" and got["2-b"]["ledger_closed_at"] is not None and got["2-b"]["src"] == "csv"
    assert rejects.count() == 1


def test_csv_without_an_essential_column(spark, tmp_path):
    (tmp_path / "b.csv").write_text("id,action_type\n1,deposit\n")
    with pytest.raises(ValueError, match="ledger_sequence"):
        files.read_csv_backstop(spark, str(tmp_path / "b.csv"))


def test_csv_of_backstop_events(spark, tmp_path):
    (tmp_path / "b.csv").write_text('id,action_type,ledger_sequence,q4w_exp,lp_tokens\n1,deposit,5,,"7"\n2,queue_withdrawal,6,1750000000,\n')
    valid, _ = files.read_csv_backstop(spark, str(tmp_path / "b.csv"))
    assert {r["id"]: (r["q4w_exp"], r["lp_tokens"] and int(r["lp_tokens"])) for r in valid.collect()} == {"1": (None, 7), "2": (1750000000, None)}


@pytest.mark.parametrize("name,text", [
    ("p.ndjson", '{"price_date":"2024-01-01T00:00:00","lp_token_price":1.5}\n{"price_date":"bad","lp_token_price":1}\n'),
    ("p.json", '[{"price_date":"2024-01-01","lp_token_price":"1.5"},{"price_date":"2024-01-02","lp_token_price":0}]'),
    ("q.json", '{"rows":[{"price_date":"2024-01-01","lp_token_price":1.5},{"price_date":"2024-13-45","lp_token_price":2}]}'),
])
def test_price_files(spark, tmp_path, name, text):
    (tmp_path / name).write_text(text)
    valid, rejects = files.validate_prices(files.read_price_json(spark, str(tmp_path / name)), "LP")
    assert [(str(r["price_date"]), r["usd_price"]) for r in valid.collect()] == [("2024-01-01", 1.5)]
    assert rejects.count() == 1


def test_unknown_price_layout(spark, tmp_path):
    (tmp_path / "z.json").write_text('{"values":[1]}')
    with pytest.raises(ValueError):
        files.read_price_json(spark, str(tmp_path / "z.json"))


# --- yields, dimensions, searches ----------------------------------------------

def test_expired_configuration_and_missing_price(spark):
    snaps = spark.createDataFrame([("p", "A", date(2025, 5, d), 100.0, 0.0) for d in (1, 2)], "pool_id string, asset_address string, snapshot_date date, b_supply double, d_supply double")
    configs = spark.createDataFrame([("lending_supply", "p", "A", 10**14, 14, 1746144000)], "config_type string, pool_address string, asset_address string, eps long, eps_decimals int, expiration long")
    price = spark.createDataFrame([("R", date(2025, 5, 1), 2.0)], "token_address string, price_date date, usd_price double")
    got = yields.lending_apy(snaps, configs, price, "R", "supply").collect()
    assert [(str(r["rate_date"]), r["emissions_per_year_per_token"], r["emission_apy"]) for r in got] == [("2025-05-01", 315360.0, None)]
    assert yields.lending_apy(snaps, configs, price, "R", "borrow").count() == 0


def test_state_feed_configs(spark):
    reserve = spark.createDataFrame([("p", "A", 5, 0, 0, 9)], "pool_id string, asset_id string, supply_eps long, borrow_eps long, supply_expiration long, borrow_expiration long")
    back = spark.createDataFrame([("p", 7, 14, 3)], "pool_id string, eps long, eps_decimals int, expiration long")
    got = {r["config_type"]: (r["asset_address"], r["expiration"]) for r in yields.emission_configs(reserve, back).collect()}
    assert got == {"lending_supply": ("A", None), "backstop": (None, 3)}


def test_token_defaults_and_native_token(spark):
    assets = spark.createDataFrame([("CABCDEFGHIJ",), ("NATIVE",), ("CKNOWN",)], "asset_address string")
    meta = spark.createDataFrame([("CKNOWN", "KNW", "", 6)], "asset_address string, symbol string, name string, decimals int")
    got = {r["asset_address"]: tuple(r)[1:] for r in refdata.token_rows(assets, meta, ("NATIVE", "NAT", "Native")).collect()}
    assert got == {"CABCDEFGHIJ": ("UNKNOWN", "CABCDEFG", 7, False), "NATIVE": ("NAT", "Native", 7, True), "CKNOWN": ("KNW", "KNW", 6, False)}


def test_search_falls_back_to_auctions_only_without_hits(spark):
    topics, data, _ = s.lending_cases(s.flat)["new_auction"]
    rows = [s.event(20_000, topics, data), s.event(10, [s.sym("bad_debt")], data)]
    df = spark.createDataFrame(rows, schemas.CONTRACT_EVENTS)
    assert [r["action_type"] for r in search.topic_window_search(df).collect()] == ["new_auction"]
    assert [r["action_type"] for r in search.topic_window_search(df, n_ledgers=30_000).collect()] == ["bad_debt"]


def test_bytes_across_base64_boundaries(spark):
    df = spark.createDataFrame([(b"xxabcKEYdef",), (b"KE Y",), (None,)], "b binary").select(F.base64("b").alias("envelope"), F.lit(None).cast("string").alias("meta"))
    assert search.byte_scan(df, b"KEY").count() == 1


def test_streamed_rows_win_with_nulls(spark):
    cols = "transaction_hash string, pool_id string, action_type string, ledger_sequence long, user_address string, amount_underlying long, amount_tokens long, src string"
    back = spark.createDataFrame([("t1", "p", "claim", 1, None, 5, None, "bq"), ("t2", "p", "claim", 1, None, 5, None, "bq"), (None, "p", "claim", 1, None, 5, None, "bq")], cols)
    have = spark.createDataFrame([("t1", "p", "claim", 1, None, 5, None, "gs"), ("t2", "p", "claim", 1, None, 5, None, "bq"), (None, "p", "claim", 1, None, 5, None, "gs")], cols)
    assert sorted(r["transaction_hash"] or "-" for r in events.new_actions(back, have).collect()) == ["-", "t2"]


def test_discovery_relation(spark):
    pools = spark.createDataFrame([("p", ["A", "B"])], "pool_id string, assets array<string>")
    assert [tuple(r) for r in ledger.flatten_discovery(pools).collect()] == [("p", 0, "A"), ("p", 1, "B")]
    dim = ledger.pool_dimension(spark, [("p", "Pool with a name beyond twenty letters", "V2")])
    assert ledger.tracked(spark.createDataFrame([("p",), ("x",)], "contract_id string"), dim).count() == 1
    row = refdata.pool_rows(dim).collect()[0]
    assert (row["short_name"], row["version"], row["is_active"]) == ("Pool with a name bey", "v2", True)


def test_csv_texts_that_no_column_holds_are_rejected(spark, tmp_path):
    wide = "1" * 40
    (tmp_path / "c.csv").write_text(
        "id,pool_id,action_type,ledger_sequence,amount_underlying,ledger_closed_at\n"
        f"1,p,supply,5,12.7,\n2,p,supply,5,{wide},\n3,p,supply,5,abc,\n4,p,supply,5,9,yesterday\n"
        f"5,p,supply,5,{'9' * 38},2024-01-02T03:04:05Z\n6,p,supply,5,-7,\n")
    valid, rejects = files.read_csv_actions(spark, str(tmp_path / "c.csv"))
    assert {r["id"]: int(r["amount_underlying"]) for r in valid.collect()} == {"5": int("9" * 38), "6": -7}
    assert sorted(r["id"] for r in rejects.collect()) == ["1", "2", "3", "4"]
