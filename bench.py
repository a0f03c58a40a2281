"""Benchmark: seconds per headline query, one JSON line on stdout.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "aggregate_flows", "volume_by_asset", "having_min_deposit", "event_count_map", "token_intersect_filter",
    "top_depositors_ranked", "pool_stats_arrays", "token_price_stats", "price_coverage", "lending_events_decode",
    "backstop_events_decode", "pool_snapshots_daily", "position_changes_one_asset", "position_changes_all_pools",
    "q4w_daily_pct", "lp_price_daily", "emission_apy_backstop", "emission_apy_lending_supply", "user_balance_latest",
    "balance_history", "asof_join_keys", "asof_join_range_only", "forward_fill_daily", "running_total_daily",
    "dedup_first_by_hash", "dedup_last_by_key", "latest_per_key", "range_residual_join", "null_safe_anti_match",
    "live_feed_union", "upsert_result", "stream_lending_events", "byte_scan",
)


def main() -> None:
    from ledgertide.catalog import load_queries
    from ledgertide.catalog.adapters import Tables
    from ledgertide.session import build_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = sys.argv[1:] or HEADLINE
    partitions = int(cpus) if cpus.isdigit() else 8
    spark = build_session("ledgertide-bench", cpus, partitions)
    spark.sparkContext.setLogLevel("ERROR")
    queries, _ = load_queries()
    seconds: dict[str, float] = {}
    queries["action_type_counts"](spark, sf_dir).count()  # start-up is not part of any query
    begin = time.perf_counter()
    Tables(spark, sf_dir).land_logs()  # the raw logs exist before any query runs
    landing = round(time.perf_counter() - begin, 3)
    for name in only:
        begin = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - begin, 3)
    print(json.dumps({
        "metric": "total seconds over headline queries", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")), "landing_logs_sec": landing, "cpus": cpus,
        "shuffle_partitions": partitions,
        "spark": spark.version,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
