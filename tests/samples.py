"""Hand-written raw rows: every action in both integer encodings, and odd ones."""

import json
from datetime import datetime

POOL, BACKSTOP, ASSET, USER = "CPOOL", "CBACK", "CASSET", "GUSER"
AT = datetime(2025, 5, 1, 12, 0, 0)
BIG = "170141183460469231731687303715884105727"  # 2**127 - 1, 39 digits


def sym(a):
    return {"symbol": a}


def adr(a):
    return {"address": a}


def flat(n):
    return {"i128": str(n)}


def split(n):
    return {"i128": {"hi": 0, "lo": n}}


def auction(number, bid=("CBID", 70), lot=("CLOT", 30)):
    def side(name, held):
        return {"key": sym(name), "val": {"map": [{"key": adr(held[0]), "val": number(held[1])}]}}

    return {"map": [side("bid", bid), {"key": sym("block"), "val": {"u32": 9}}, side("lot", lot)]}


def lending_cases(number):
    """action → (topics, data, expected fields)."""
    two = {"vec": [number(1000), number(900)]}
    plain = {"asset_address": ASSET, "user_address": USER, "amount_underlying": "1000", "amount_tokens": "900"}
    out = {a: ([sym(a), adr(ASSET), adr(USER)], two, plain) for a in (
        "supply", "withdraw", "supply_collateral", "withdraw_collateral", "borrow", "repay")}
    out["claim"] = ([sym("claim"), adr(USER), adr(ASSET)], two, {
        "asset_address": ASSET, "user_address": USER, "amount_underlying": "900", "amount_tokens": None,
        "implied_rate": None})
    held = {"bid_asset": "CBID", "bid_amount": "70", "lot_asset": "CLOT", "lot_amount": "30", "asset_address": None,
            "user_address": USER, "amount_underlying": None, "auction_type": "1"}
    out["new_auction"] = ([sym("new_auction"), {"u32": 1}, adr(USER)], {"vec": [{"u32": 45}, auction(number)]},
                          {**held, "liquidation_percent": "45", "filler_address": None})
    out["fill_auction"] = ([sym("fill_auction"), {"u32": 1}, adr(USER)],
                           {"vec": [adr("GFILL"), number(80), auction(number)]},
                           {**held, "liquidation_percent": "80", "filler_address": "GFILL"})
    return out


def backstop_cases(number):
    pool_user = [adr(POOL), adr(USER)]
    return {
        "deposit": (pool_user, {"vec": [number(5), number(4)]}, {"lp_tokens": "5", "shares": "4", "pool_address": POOL, "user_address": USER}),
        "withdraw": (pool_user, {"vec": [number(4), number(5)]}, {"lp_tokens": "5", "shares": "4"}),
        "queue_withdrawal": (pool_user, {"vec": [number(4), {"u64": "1750000000"}]}, {"lp_tokens": None, "shares": "4", "q4w_exp": "1750000000"}),
        "dequeue_withdrawal": (pool_user, number(4), {"lp_tokens": None, "shares": "4"}),
        "claim": ([adr(USER)], number(6), {"lp_tokens": "6", "shares": None, "pool_address": None, "user_address": USER}),
        "donate": (pool_user, number(7), {"lp_tokens": "7", "user_address": USER}),
        "draw": (pool_user, {"vec": [adr("GTO"), number(3)]}, {"lp_tokens": None, "pool_address": POOL, "user_address": None}),
        "gulp_emissions": ([adr(POOL)], {"vec": [number(11), number(12)]}, {
            "lp_tokens": None, "emissions_amount": "11", "emissions_shares": "12", "user_address": None}),
    }


def event(ledger, topics, data, contract=POOL, ok=True, op=1, tx=None, at=AT):
    return (f"{contract}-{ledger}", "contract", tx or f"tx{ledger}", ledger, at, contract, ok, op, json.dumps(topics),
            json.dumps(data))


def entry(kind, address, val, ledger, contract=POOL, deleted=False, at=AT, change=1):
    key = {"vec": [sym(kind)] + ([adr(address)] if address else [])}
    return (contract, at, ledger, f"hash{ledger}", change, deleted, json.dumps(key), json.dumps(val) if val else None)


def keyed(*pairs):
    return {"map": [{"key": {"u32": k}, "val": v} for k, v in pairs]}


def positions(collateral, liabilities, supply, number=flat):
    side = lambda d: {"map": [{"key": {"u32": k}, "val": number(v)} for k, v in d.items()]}
    return keyed((0, side(collateral)), (1, side(liabilities)), (2, side(supply)))


def reserve(b_rate, d_rate, b_supply=10_000_000, d_supply=20_000_000, last_time=1_700_000_000):
    return keyed((0, flat(b_rate)), (1, flat(b_supply)), (2, flat(0)), (3, flat(d_rate)), (4, flat(d_supply)),
                 (5, flat(0)), (6, {"u64": str(last_time)}))


def config(index):
    return keyed((0, {"u32": 1}), (1, {"u32": 1}), (2, {"u32": 1}), (3, {"u32": index}))
