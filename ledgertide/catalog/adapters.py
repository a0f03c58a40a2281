"""Ledger-shaped tables derived from the generic test tables.

Roles: ``events`` is the action log (``event_id`` the ledger, ``props.k`` picks
pool and asset), ``part`` the tokens, ``nation`` the pools, ``lineitem`` the daily
token prices.  Every table is derived from all rows of its source; the SQL twins
of the same tables are in :mod:`ledgertide.catalog.sqltables`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path, spread
from ..sources import bronze


# Declared, so that no footer has to be read to plan a query.
SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
                "l_shipdate timestamp_ntz",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
}


_STORED: dict[tuple[str, str, str], tuple] = {}


class Tables:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.schema(SCHEMAS[name]).parquet(f"{self.dir}/{name}.parquet")

    # --- the action log and its parts ----------------------------------------
    def ev(self) -> DataFrame:
        return with_parts(self.raw("events"))

    def spread_ev(self) -> DataFrame:
        """The same rows for the JSON logs, whose building and decoding is CPU-bound."""
        return with_parts(spread(self.raw("events")))

    def actions(self) -> DataFrame:
        t = F.col("event_type")
        return self.ev().select(
            F.col("event_id").cast("string").alias("id"), "pool_id", _text("T", F.col("event_id")).alias("transaction_hash"),
            F.col("event_id").alias("ledger_sequence"), F.col("ts").alias("ledger_closed_at"),
            _action_of_type(F.lit("claim")).alias("action_type"), "asset_address", "user_address",
            (F.col("cents") * 100000).cast("decimal(38,0)").alias("amount_underlying"),
            F.when(t != "error", F.col("cents") * 90000 + F.col("k")).cast("decimal(38,0)").alias("amount_tokens"),
            F.when(t != "error", F.try_divide(F.col("cents") * 100000.0, (F.col("cents") * 90000 + F.col("k")).cast("double")))
            .alias("implied_rate"),
            F.when(F.col("event_id") % 2 == 0, "gs").otherwise("bq").alias("src"),
        )

    def history(self) -> DataFrame:
        from ..plans.events import action_history

        return action_history(self.actions(), self.pools(), self.tokens())

    def backstop(self) -> DataFrame:
        t, c = F.col("event_type"), F.col("cents")
        return self.ev().select(
            F.concat(F.lit("b"), F.col("event_id").cast("string")).alias("id"),
            _text("T", F.col("event_id")).alias("transaction_hash"),
            F.col("event_id").alias("ledger_sequence"), F.col("ts").alias("ledger_closed_at"),
            _pick(t, signup="deposit", click="withdraw", purchase="queue_withdrawal", view="donate", error="claim")
            .alias("action_type"),
            F.when(t != "error", F.col("pool_id")).alias("pool_address"), "user_address",
            F.when(t != "purchase", c * 100000).cast("decimal(38,0)").alias("lp_tokens"),
            F.when(t.isin("signup", "click", "purchase"), c * 90000).cast("decimal(38,0)").alias("shares"),
        )

    # --- dimensions -----------------------------------------------------------
    def tokens(self) -> DataFrame:
        size = F.col("p_size")
        return self.raw("part").select(
            _text("A", F.col("p_partkey")).alias("asset_address"), _text("S", F.col("p_partkey")).alias("symbol"),
            F.col("p_name").alias("name"), F.lit(7).alias("decimals"), F.lit(None).cast("string").alias("icon_url"),
            F.when(size % 2 == 0, F.col("p_type")).alias("coingecko_id"),
            F.when(size % 5 == 0, "USD").when(size % 5 == 1, "eur").when(size % 5 == 2, "gbp").alias("pegged_currency"),
            (F.col("p_partkey") == 0).alias("is_native"),
        )

    def pools(self) -> DataFrame:
        none = F.lit(None).cast("string")
        return self.raw("nation").select(
            _text("P", F.col("n_nationkey")).alias("pool_id"), F.col("n_name").alias("name"),
            F.substring("n_name", 1, 6).alias("short_name"), none.alias("description"), none.alias("icon_url"),
            none.alias("website_url"), F.lit("v2").alias("version"), (F.col("n_regionkey") != 1).alias("is_active"))

    # --- curated series -------------------------------------------------------
    def prices(self) -> DataFrame:
        """Token prices per day: highest extended price of the part that day."""
        return self.raw("lineitem").groupBy(
            _text("A", F.col("l_partkey")).alias("token_address"), F.to_date("l_shipdate").alias("price_date"),
        ).agg((F.max("l_extendedprice") / 1000.0).alias("usd_price"),
              # Greatest flag as a number: a string maximum would force a sort-based aggregation.
              F.char(F.max(F.ascii("l_returnflag"))).alias("source"))

    def day_prices(self) -> DataFrame:
        """Prices of assets, reward token (RWD) and LP token (LP) by event day."""
        ev = self.ev().withColumn("price_date", F.to_date("ts"))
        dollars = (F.max("cents") / 100.0).alias("usd_price")
        assets = ev.groupBy(F.col("asset_address").alias("token_address"), "price_date").agg(dollars)
        special = ev.filter(F.col("event_type").isin("view", "click")).groupBy(
            F.when(F.col("event_type") == "view", "RWD").otherwise("LP").alias("token_address"), "price_date").agg(dollars)
        return assets.unionByName(special).withColumn("source", F.lit("events"))

    def snapshots(self) -> DataFrame:
        """Pool snapshots: latest view event per pool, asset and day."""
        views = self.ev().filter(F.col("event_type") == "view")
        rows = views.groupBy("pool_id", "asset_address", F.to_date("ts").alias("snapshot_date")).agg(
            F.max("event_id").alias("ledger_sequence"), F.max_by("cents", "event_id").alias("c"),
            F.max_by("k", "event_id").alias("k"))
        return rows.select(
            "pool_id", "asset_address", "snapshot_date", "ledger_sequence",
            ((F.col("c") + 1000000) / 1e6).alias("b_rate"), ((F.col("c") * 2 + 1000000) / 1e6).alias("d_rate"),
            F.col("c").cast("double").alias("b_supply"), F.col("k").cast("double").alias("d_supply"))

    def positions(self) -> DataFrame:
        """User positions: one per purchase event."""
        c, k = F.col("cents"), F.col("k")
        return self.ev().filter(F.col("event_type") == "purchase").select(
            "pool_id", "user_address", "asset_address", F.to_date("ts").alias("snapshot_date"),
            F.col("ts").alias("snapshot_timestamp"), F.col("event_id").alias("ledger_sequence"),
            _text("E", F.col("event_id")).alias("entry_hash"), F.lit(1).cast("long").alias("ledger_entry_change"),
            (c / 100.0).alias("supply_btokens"), k.cast("double").alias("collateral_btokens"),
            (F.col("event_id") % 50).cast("double").alias("liabilities_dtokens"),
            F.when(k % 2 == 0, (c * 3 + 1000000) / 1e6).alias("b_rate"),
            F.when(k % 3 == 0, (c * 4 + 1000000) / 1e6).alias("d_rate"))

    def emission_configs(self) -> DataFrame:
        backstop = self.raw("nation").select(
            F.lit("backstop").alias("config_type"), _text("P", F.col("n_nationkey")).alias("pool_address"),
            F.lit(None).cast("string").alias("asset_address"),
            ((F.col("n_nationkey") + 1) * F.lit(1000000000000)).cast("decimal(38,0)").alias("eps"),
            F.lit(14).alias("eps_decimals"), F.lit(None).cast("long").alias("expiration"))
        pairs = self.ev().groupBy("pool_id", "asset_address").agg(F.max("k").alias("k"))

        def side(name: str, factor: int) -> DataFrame:
            return pairs.select(
                F.lit(f"lending_{name}").alias("config_type"), F.col("pool_id").alias("pool_address"), "asset_address",
                ((F.col("k") + 1) * F.lit(factor)).cast("decimal(38,0)").alias("eps"), F.lit(14).alias("eps_decimals"),
                F.when(F.col("k") % 2 == 1, F.lit(1705276800)).cast("long").alias("expiration"))

        return backstop.unionByName(side("supply", 100000000000)).unionByName(side("borrow", 70000000000))

    def reserve_state(self) -> DataFrame:
        """Latest state per pool and asset, in the shape of the reserve feed."""
        rows = self.ev().groupBy("pool_id", F.col("asset_address").alias("asset_id")).agg(
            F.max("event_id").alias("ledger_sequence"), F.max_by("cents", "event_id").alias("c"),
            F.max_by("k", "event_id").cast("long").alias("k"))
        c, k = F.col("c"), F.col("k")
        big = "decimal(38,0)"
        return rows.select(
            "pool_id", "asset_id", (c * 1000000 + 1000000000000).cast(big).alias("b_rate"),
            (c * 2000000 + 1000000000000).cast(big).alias("d_rate"), (c * 10000000).cast(big).alias("b_supply"),
            (k * F.lit(10000000)).cast(big).alias("d_supply"), (c * 20000000).cast(big).alias("total_supply"),
            (k * F.lit(20000000)).cast(big).alias("total_liabilities"), F.lit(7).alias("decimals"),
            F.when(k % 2 == 0, k * F.lit(1000000000)).otherwise(0).cast(big).alias("supply_eps"),
            F.when(k % 3 == 0, k * F.lit(2000000000)).otherwise(0).cast(big).alias("borrow_eps"),
            F.when(k % 4 == 0, 0).otherwise(1705276800).cast("long").alias("supply_expiration"),
            F.when(k % 5 == 0, 0).otherwise(1705276800).cast("long").alias("borrow_expiration"),
            F.when(k % 7 == 0, 0.0).otherwise(c / 100.0).alias("oracle_price"),
            F.col("ledger_sequence").alias("last_time"), "ledger_sequence")

    def backstop_state(self) -> DataFrame:
        rows = self.ev().groupBy("pool_id").agg(F.max("event_id").alias("ledger_sequence"), F.sum("cents").alias("c"))
        big = "decimal(38,0)"
        return rows.select(
            "pool_id", (F.col("c") * 1000).cast(big).alias("shares"), (F.col("c") * 1100).cast(big).alias("tokens"),
            (F.col("c") * 10).cast(big).alias("q4w"), F.lit(500000000000).cast(big).alias("eps"),
            F.lit(14).alias("eps_decimals"), F.lit(0).cast("long").alias("expiration"), "ledger_sequence")

    # --- raw logs with JSON ---------------------------------------------------
    def raw_lending(self) -> DataFrame:
        """Contract-event log of the lending pools."""
        return self._stored("raw_lending", bronze.with_event_layout)

    def raw_backstop(self) -> DataFrame:
        """Contract-event log of the backstop."""
        return self._stored("raw_backstop", bronze.with_event_layout)

    def state(self) -> DataFrame:
        """Contract-state log of the pools."""
        return self._stored("state", bronze.with_state_layout)

    def lp_state(self) -> DataFrame:
        """Contract-state log of backstop and LP contract."""
        return self._stored("lp_state", bronze.with_state_layout)

    def _stored(self, name: str, layout) -> DataFrame:
        """The log as a stored table, written on first use in a session.

        The queries start, as they would on a ledger, from logs that lie in
        storage; writing them out of ``events`` is not part of any query.
        """
        key = (self.spark.sparkContext.applicationId, self.dir, name)
        if key not in _STORED:
            rows = layout(getattr(self, f"_make_{name}")())
            path = scratch_path(self.spark, name)
            bronze.land(rows, path)
            _STORED[key] = (path, rows.schema)
        path, schema = _STORED[key]
        return self.spark.read.schema(schema).parquet(path)

    def log_path(self, name: str) -> str:
        """Where a raw log lies, for the queries that scan it themselves."""
        getattr(self, name)()
        return _STORED[(self.spark.sparkContext.applicationId, self.dir, name)][0]

    def land_logs(self) -> None:
        for table in (self.raw_lending, self.raw_backstop, self.state, self.lp_state):
            table()

    def _make_raw_lending(self) -> DataFrame:
        """Contract-event log of the lending pools, in every encoding the decoder knows."""
        e = F.col("event_id")
        auction = F.when(e % 3 == 0, "claim").when(e % 3 == 1, "new_auction").otherwise("fill_auction")
        df = self.spread_ev().withColumn("a", _action_of_type(auction))
        a, u, t, k = F.col("a"), F.col("cents") * 100000, F.col("cents") * 90000 + F.col("k"), F.col("k")
        sym, asset, user = _obj("symbol", a), _obj("address", F.col("asset_address")), _obj("address", F.col("user_address"))
        topics = F.when(a == "claim", _arr(sym, user, asset)).when(
            a.isin("new_auction", "fill_auction"), _arr(sym, _obj("u32", k % 3, False), user)).otherwise(_arr(sym, asset, user))

        def holding(name: str, address: Column, amount: Column) -> Column:
            return F.concat(F.lit('{"key":{"symbol":"%s"},"val":{"map":[{"key":' % name), _obj("address", address),
                            F.lit(',"val":'), _int(amount), F.lit("}]}}"))

        sides = F.concat(
            F.lit('{"map":['), holding("bid", F.col("asset_address"), u),
            F.lit(',{"key":{"symbol":"block"},"val":{"u32":7}},'), holding("lot", _text("B", k), t), F.lit("]}"))
        data = (
            F.when((a == "repay") & (e % 7 == 0), _int(u))
            .when((a == "new_auction") & (e % 4 == 0), _arr(_obj("u32", k, False), sides))
            .when(a == "new_auction", _vec(_obj("u32", k, False), sides))
            .when(a == "fill_auction", _vec(_obj("address", _text("F", F.col("user_id"))), _int(k), sides))
            .otherwise(_vec(_int(u), _int(t))))
        return df.select(*_event_columns(F.col("pool_id")), topics.alias("topics_decoded"), data.alias("data_decoded"))

    def _make_raw_backstop(self) -> DataFrame:
        e, k = F.col("event_id"), F.col("k")
        a = _pick(
            F.col("event_type"), signup="deposit", click="withdraw",
            purchase=F.when(e % 2 == 0, "queue_withdrawal").otherwise("dequeue_withdrawal"),
            view=F.when(k % 2 == 0, "donate").otherwise("draw"),
            error=F.when(k % 2 == 0, "claim").otherwise("gulp_emissions"))
        df = self.spread_ev().withColumn("a", a)
        a, u, t = F.col("a"), F.col("cents") * 100000, F.col("cents") * 90000 + k
        sym, pool, user = _obj("symbol", a), _obj("address", F.col("pool_id")), _obj("address", F.col("user_address"))
        topics = F.when(a == "claim", _arr(sym, user)).when(a == "gulp_emissions", _arr(sym, pool)).otherwise(
            _arr(sym, pool, user))
        data = (
            F.when(a.isin("deposit", "gulp_emissions"), _vec(_int(u), _int(t)))
            .when(a == "withdraw", _vec(_int(t), _int(u)))
            .when(a == "queue_withdrawal", _vec(_int(t), _obj("u64", e + 1700000000)))
            .when(a == "dequeue_withdrawal", _int(t))
            .when(a == "draw", _vec(user, _int(u))).otherwise(_int(u)))
        return df.select(*_event_columns(F.lit("BACKSTOP")), topics.alias("topics_decoded"), data.alias("data_decoded"))

    def _make_state(self) -> DataFrame:
        """State log of the pools: reserve data, reserve configuration and positions."""
        t, idx, c, k = F.col("event_type"), F.col("idx"), F.col("cents"), F.col("k")
        df = self.spread_ev().withColumn("idx", (F.floor(F.col("k") / 5) % 4).cast("int")).withColumn(
            "reserve_asset", F.concat(F.lit("R"), F.col("pool_id"), F.lit("_"), F.col("idx").cast("string")))
        kind = _pick(t, view="ResData", error="ResConfig", signup="Positions", click="Positions", purchase="Positions")
        address = F.when(t.isin("view", "error"), F.col("reserve_asset")).otherwise(F.col("user_address"))
        key = F.concat(F.lit('{"vec":['), _obj("symbol", kind), F.lit(","), _obj("address", address), F.lit("]}"))
        reserve = _keyed_map(
            (0, _obj("i128", c * 1000000 + 1000000000000)), (1, _obj("i128", c * 1000)), (2, _obj("i128", c)),
            (3, _obj("i128", c * 2000000 + 1000000000000)), (4, _obj("i128", k)), (5, _obj("i128", c)),
            (6, _obj("u64", F.col("event_id") + 1700000000)))
        config = _keyed_map((0, _obj("u32", k, False)), (1, _obj("u32", k, False)), (2, _obj("u32", k, False)),
                            (3, _obj("u32", idx, False)))
        one = _entry(idx, _obj("i128", c * 1000))
        two = F.concat(_entry(idx, _obj("i128", c * 2000)), F.lit(","), _entry(idx + 1, _obj("i128", k)))
        maps = lambda inner: F.concat(F.lit('{"map":['), inner, F.lit("]}"))
        position = _keyed_map((0, maps(one)), (1, maps(_entry(idx + 1, _obj("i128", k * 1000)))), (2, maps(two)))
        val = F.when(t == "view", reserve).when(t == "error", config).otherwise(position)
        return df.select(*_state_columns(F.col("pool_id")), key.alias("key_decoded"), val.alias("val_decoded"))

    def _make_lp_state(self) -> DataFrame:
        """State log of backstop and LP contract: balances, total shares, record data."""
        ev, c, k = self.spread_ev(), F.col("cents"), F.col("k")
        shares = F.when(k == 0, F.lit(0)).otherwise(c * 100)
        balance = _listed_map(_obj("i128", c), _obj("i128", shares), _obj("i128", c * 110))

        def entries(kind: str, contract: str, val: Column, keyed: bool = False) -> DataFrame:
            key = F.concat(F.lit('{"vec":['), _obj("symbol", F.lit(kind)), *(
                [F.lit(","), _obj("address", F.col("pool_id"))] if keyed else []), F.lit("]}"))
            return ev.select(*_state_columns(F.lit(contract)), key.alias("key_decoded"), val.alias("val_decoded"))

        record = F.concat(F.lit('{"map":[{"key":{"address":"Q"},"val":{"map":[{"key":{"symbol":"balance"},"val":'),
                          _obj("i128", c * 7), F.lit("}]}}]}"))
        return entries("PoolBalance", "BACKSTOP", balance, True).unionByName(
            entries("TotalShares", "LPTOKEN", _obj("i128", c * 11 + k + 1))).unionByName(
            entries("AllRecordData", "LPTOKEN", record))


def with_parts(events: DataFrame) -> DataFrame:
    """Event rows with the numbers and addresses that play the ledger roles."""
    k = F.get_json_object("props", "$.k").cast("int")
    return events.select(
        "event_id", "ts", "user_id", "event_type", "value", "props", k.alias("k"),
        F.round(F.col("value") * 100).cast("long").alias("cents"),
        _text("P", k % 5).alias("pool_id"), _text("A", F.floor(k / 5) % 10).alias("asset_address"),
        _text("U", F.col("user_id")).alias("user_address"))


def _text(prefix: str, number: Column) -> Column:
    return F.concat(F.lit(prefix), number.cast("string"))


def _pick(column: Column, **values) -> Column:
    out = F
    for name, value in values.items():
        out = out.when(column == name, value)
    return out


def _action_of_type(error: Column) -> Column:
    even = F.col("event_id") % 2 == 0
    return _pick(
        F.col("event_type"), signup=F.when(even, "supply").otherwise("supply_collateral"),
        click=F.when(even, "withdraw").otherwise("withdraw_collateral"), purchase="borrow", view="repay", error=error)


def _obj(name: str, value: Column, quoted: bool = True) -> Column:
    q = '"' if quoted else ""
    return F.concat(F.lit('{"%s":%s' % (name, q)), value.cast("string"), F.lit(q + "}"))


def _int(value: Column) -> Column:
    """128-bit integer as scalar text on even ledgers, as {hi, lo} on odd ones."""
    nested = F.concat(F.lit('{"i128":{"hi":0,"lo":'), value.cast("string"), F.lit("}}"))
    return F.when(F.col("event_id") % 2 == 0, _obj("i128", value)).otherwise(nested)


def _arr(*items: Column) -> Column:
    return F.concat(F.lit("["), F.concat_ws(",", *items), F.lit("]"))


def _vec(*items: Column) -> Column:
    return F.concat(F.lit('{"vec":'), _arr(*items), F.lit("}"))


def _entry(key, val: Column) -> Column:
    key = F.lit(str(key)) if isinstance(key, int) else key.cast("string")
    return F.concat(F.lit('{"key":{"u32":'), key, F.lit('},"val":'), val, F.lit("}"))


def _keyed_map(*entries) -> Column:
    return F.concat(F.lit('{"map":'), _arr(*[_entry(k, v) for k, v in entries]), F.lit("}"))


def _listed_map(*vals: Column) -> Column:
    return F.concat(F.lit('{"map":'), _arr(*[F.concat(F.lit('{"key":{"symbol":"x"},"val":'), v, F.lit("}")) for v in vals]),
                    F.lit("}"))


def _event_columns(contract: Column) -> list[Column]:
    e = F.col("event_id")
    return [
        _text("T", e).alias("transaction_hash"), e.alias("ledger_sequence"), F.col("ts").alias("closed_at"),
        contract.alias("contract_id"), (e % 11 != 0).alias("in_successful_contract_call"),
        F.when(e % 13 != 0, e).alias("operation_id")]


def _state_columns(contract: Column) -> list[Column]:
    e = F.col("event_id")
    return [
        contract.alias("contract_id"), F.col("ts").alias("closed_at"), e.alias("ledger_sequence"),
        _text("E", e).alias("ledger_key_hash_base_64"), F.lit(1).cast("long").alias("ledger_entry_change"),
        (e % 17 == 0).alias("deleted")]
