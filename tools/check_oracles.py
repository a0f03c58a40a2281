"""Run registered queries and their SQL twins side by side.

    python tools/check_oracles.py [sf_dir] [name …]
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb

from ledgertide.catalog import load_queries
from ledgertide.session import build_session

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


SAME_TYPE = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if hasattr(v, "isoformat"):
        return str(v)
    if isinstance(v, float):
        return round(v, 5) + 0.0
    if type(v).__name__ == "Decimal":
        return round(float(v), 5) + 0.0
    if isinstance(v, bool):
        return v
    return v


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr), [names[i] for i in order]


def main(argv):
    sf = argv[0] if argv else "/root/testdata/sf0.01"
    queries, oracles = load_queries()
    wanted = argv[1:] or list(queries)
    spark = build_session("oracle-check", "8", 8)
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    failed = []
    for name in wanted:
        begin = time.time()
        try:
            df = queries[name](spark, sf)
            got = df.collect()
            spent = time.time() - begin
            mine, my_names = rows_of(df.columns, got)
            types = dict(df.dtypes)
            if name not in oracles:
                print(f"rows {name}: {len(mine)} rows {spent:.2f}s")
                continue
            res = con.execute(oracles[name])
            names = [d[0] for d in res.description]
            dtypes = {d[0]: str(d[1]) for d in res.description}
            theirs, their_names = rows_of(names, res.fetchall())
            if my_names != their_names:
                failed.append(name)
                print(f"FAIL {name}: columns {my_names} != {their_names}")
            elif mine != theirs:
                failed.append(name)
                a, b = set(map(repr, mine)), set(map(repr, theirs))
                print(f"FAIL {name}: {len(mine)} vs {len(theirs)} rows; ours only {sorted(a - b)[:3]}; theirs only {sorted(b - a)[:3]}")
            else:
                odd = {n: (types[n], dtypes[n]) for n in names if SAME_TYPE.get(types[n]) != dtypes[n]}
                print(f"ok   {name}: {len(mine)} rows {spent:.2f}s {odd or ''}{' EMPTY' if not mine else ''}")
        except Exception as exc:  # noqa: BLE001 - report and go on with the next query
            failed.append(name)
            print(f"ERR  {name}: {type(exc).__name__} {str(exc)[:600]}")
    print(f"{len(wanted)} checked, {len(failed)} failed: {failed}")
    spark.stop()
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
