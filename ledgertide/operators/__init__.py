"""Row-set operators the engine owns, composed from DataFrame operations."""

from .asof import asof_join
from .dedup import dedup_first, dedup_last, duplicate_keys, latest_per, earliest_per
from .fill import forward_fill, day_series, running_total
from .paging import page, page_with_total, top_k_ranked
from .stats import action_counts, breakdown, day_coverage, table_stats, watermark
from .upsert import conditional_merge, insert_missing, missing_rows, upsert
from .validate import Rule, validate

__all__ = [
    "asof_join", "dedup_first", "dedup_last", "duplicate_keys", "latest_per", "earliest_per", "forward_fill",
    "day_series", "running_total", "page", "page_with_total", "top_k_ranked", "action_counts", "breakdown",
    "day_coverage", "table_stats", "watermark", "conditional_merge", "insert_missing", "missing_rows", "upsert",
    "Rule", "validate",
]
