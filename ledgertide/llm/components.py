"""Connected components of an edge table, kept in tables throughout."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``label`` (smallest node of its component) for every end of ``edges(a, b)``.

    Each round every node hooks to its smallest neighbour if that is smaller,
    then to what that one hooked to, and the edges are contracted accordingly;
    rounds end when no edge is left. What a round decides is written to the
    shared folder. Contraction leaves a fraction of the edges each time, so the
    rounds together move little more than the edges given.
    """
    ends = [F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")]
    left = stored(edges.where("a <> b").select(*ends).distinct(), "edges")
    labels = left.select(F.col("a").alias("node")).union(left.select("b")).distinct().withColumn("label", F.col("node"))
    while not left.isEmpty():
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hook = both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("to"))
        onward = hook.select(F.col("node").alias("to"), F.col("to").alias("via"))
        hook = stored(hook.join(onward, "to").select("node", F.col("via").alias("to")), "hooks")
        labels = labels.join(hook.select(F.col("node").alias("label"), "to"), "label", "left").select(
            "node", F.coalesce("to", "label").alias("label"))
        left = left.join(hook.select(F.col("node").alias("a"), F.col("to").alias("c")), "a").select("c", "b")
        left = left.join(hook.select(F.col("node").alias("b"), F.col("to").alias("d")), "b").where("c <> d")
        left = stored(left.select(F.col("c").alias("a"), F.col("d").alias("b")).select(*ends).distinct(), "edges")
    return stored(labels, "labels")
