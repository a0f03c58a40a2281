"""One registered query per operator, over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

from .collocations import OP13_SQL
from .exact import OP9_SQL
from .substring import OP6_SQL
from .topk import OP8_SQL

# operator module, function, table
_QUERIES = (
    ("bpe", "op1_byte_bpe", "documents"),
    ("ctw", "op2_context_tree", "documents"),
    ("jaccard", "op3_jaccard_join", "documents"),
    ("langid", "op4_language_id", "documents"),
    ("packing", "op5_cost_packing", "documents"),
    ("substring", "op6_block_anchors", "documents"),
    ("counts", "op7_prefix_counts", "documents"),
    ("topk", "op8_threshold_top_k", "embeddings"),
    ("exact", "op9_block_naming", "documents"),
    ("tokenfiles", "op10_token_files", "documents"),
    ("conversation", "op11_run_length_repair", "conversations"),
    ("rankarray", "op12_rank_array", "documents"),
    ("collocations", "op13_misra_gries", "documents"),
)


def _query(module: str, name: str, table: str) -> Callable[[SparkSession, str], DataFrame]:
    fn = getattr(import_module(f"{__package__}.{module}"), name)

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return fn(spark.read.parquet(f"{sf_dir}/{table}.parquet"))

    return run


QUERIES = {name: _query(module, name, table) for module, name, table in _QUERIES}

ORACLES = {"op6_block_anchors": OP6_SQL, "op8_threshold_top_k": OP8_SQL, "op9_block_naming": OP9_SQL,
           "op13_misra_gries": OP13_SQL}
