"""Exact top-k by inner product with the threshold algorithm (operator 8).

Vectors of integers are dealt to blocks of bounded size. Within a block every
dimension has its list sorted by value. For a query the lists are read from the
end that contributes most, round by round; every row met is scored in full; the
sum of the contributions at the reading positions bounds all rows not yet met.
Reading stops once that bound is below the k-th score (a tie goes on, because
a smaller id may follow). The best of all blocks are then ranked per query.

Queries are a stated set, met with all rows block by block; a task holds one
block of rows and one of queries.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import library_on_workers

K = 5
SCALE = 256
BLOCK_ROWS = 8192
QUERY_ROWS = 1024
FIRST_DEPTH = 16
EXACT = 2.0**53
LONG = 2.0**63


class SortedLists:
    """One block: integer vectors, their ids, and a sorted list per dimension."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray):
        self.vectors, self.ids = vectors, ids
        by_dimension = np.ascontiguousarray(vectors.T)
        self.order = np.argsort(by_dimension, axis=1, kind="stable").astype(np.int32)
        self.values = np.take_along_axis(by_dimension, self.order, 1)

    @staticmethod
    def _ranked(ids: np.ndarray, scores: np.ndarray) -> np.ndarray | list[int]:
        if scores.dtype == object:  # Python's integers
            return sorted(range(len(ids)), key=lambda i: (-scores[i], ids[i]))
        return np.lexsort((ids, -scores))

    def top(self, query: np.ndarray, own: int, k: int) -> list[tuple[int, int]]:
        """``(id, score)`` of the ``k`` best rows without those of id ``own``, ties to the smaller id."""
        n = len(self.ids)
        dims = np.flatnonzero(query)
        up, down = dims[query[dims] < 0], dims[query[dims] > 0]
        unseen = self.ids != own
        best_score, best_id = np.zeros(0, query.dtype), np.zeros(0, np.int64)
        depth, step = 0, FIRST_DEPTH
        while True:
            stop = min(n, depth + step)
            met = np.zeros(n, bool)
            met[self.order[down, n - stop:n - depth]] = True
            met[self.order[up, depth:stop]] = True
            if not len(dims):
                met[depth:stop] = True
            fresh = np.flatnonzero(met & unseen)
            unseen[fresh] = False
            score = self.vectors[fresh] @ query
            if len(best_id) == k:
                fresh, score = fresh[score >= best_score[-1]], score[score >= best_score[-1]]
            best_score = np.concatenate([best_score, score])
            best_id = np.concatenate([best_id, self.ids[fresh]])
            keep = self._ranked(best_id, best_score)[:k]
            best_score, best_id = best_score[keep], best_id[keep]
            if stop >= n:
                break
            bound = self.values[down, n - 1 - stop] @ query[down] + self.values[up, stop] @ query[up]
            if len(best_id) == k and best_score[-1] > bound:
                break
            depth, step = stop, step * 2
        return list(zip(best_id.tolist(), [int(s) for s in best_score], strict=True))


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows padded with zeros to one length."""
    lists = column.to_pylist()
    width = max(map(len, lists), default=0)
    out = np.zeros((len(lists), width), np.int64)
    for row, values in zip(out, lists, strict=True):
        row[:len(values)] = values
    return out


def _exact_kind(table: np.ndarray, wanted: np.ndarray, width: int) -> type:
    """Floats where every sum is exact in them, else 64-bit integers where none passes their range, else Python's integers."""
    largest = [float(np.abs(x.astype(np.float64)).max(initial=0)) for x in (table, wanted)]
    bound = largest[0] * largest[1] * max(width, 1)
    return np.float64 if bound < EXACT else np.int64 if bound < LONG / 2 else object


def _pair(rows: pa.Table, queries: pa.Table) -> pa.Table:
    found = []
    if rows.num_rows and queries.num_rows:
        table, wanted = _matrix(rows["vector"].combine_chunks()), _matrix(queries["vector"].combine_chunks())
        width = max(table.shape[1], wanted.shape[1])
        table, wanted = (np.pad(x, ((0, 0), (0, width - x.shape[1]))) for x in (table, wanted))
        kind = _exact_kind(table, wanted, width)
        table, wanted = table.astype(kind), wanted.astype(kind)
        lists = SortedLists(table, rows["vec_id"].to_numpy())
        for row, own, query in zip(queries["row"].to_pylist(), queries["vec_id"].to_pylist(), wanted, strict=True):
            found += [(row, own, other, score) for other, score in lists.top(query, own, rows["k"][0].as_py())]
    columns = list(zip(*found, strict=True)) or [()] * 4
    return pa.table([pa.array(c, pa.int64()) for c in columns], names=["row", "query_id", "vec_id", "score"])


def exact_top_k(vectors: DataFrame, queries: DataFrame, k: int = K, vec_id: str = "vec_id", embedding: str = "embedding",
                scale: int = SCALE, block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """The ``k`` best rows of ``vectors`` for every row of ``queries``: ``query_id``, ``rank``, ``vec_id``, ``score``.

    Components become ``floor(scale * x)``. Rows take no part whose id or
    vector is null, or that hold a null or non-finite component; shorter vectors
    count as padded with zeros. Scores are exact; a scaled component, or a score
    among the best, that does not fit in a long is an error. Rows of the query's
    own id are no candidates; other repeated rows are candidates each; a
    repeated query row gets its own ranks. Other columns are not carried.
    """
    def whole(df: DataFrame) -> DataFrame:
        def component(x):
            value = F.floor(F.lit(float(scale)) * x.cast("double"))
            fits = F.abs(F.lit(float(scale)) * x.cast("double")) < LONG
            return F.when(fits, value).otherwise(F.raise_error(F.lit("a scaled component does not fit in a long")).cast("bigint"))

        scaled = F.transform(embedding, component)
        fine = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
        return df.where(F.col(vec_id).isNotNull() & fine).select(F.col(vec_id).cast("long").alias("vec_id"),
                                                                 scaled.cast("array<bigint>").alias("vector"))

    rows, wanted = whole(vectors), whole(queries).withColumn("row", F.monotonically_increasing_id())
    blocks = max(1, -(-rows.count() // block_rows))
    query_blocks = max(1, -(-wanted.count() // query_rows))
    left = (
        rows.withColumn("block", F.pmod(F.xxhash64("vec_id", "vector"), F.lit(blocks)))
        .withColumn("query_block", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1)))).withColumn("k", F.lit(k))
    )
    right = (
        wanted.withColumn("query_block", F.pmod(F.xxhash64("row"), F.lit(query_blocks)).cast("int"))
        .withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
    )
    library_on_workers(vectors.sparkSession)
    best = left.groupBy("block", "query_block").cogroup(right.groupBy("block", "query_block")).applyInArrow(
        _pair, "row bigint, query_id bigint, vec_id bigint, score bigint")
    order = Window.partitionBy("row").orderBy(F.desc("score"), "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def op8_threshold_top_k(embeddings: DataFrame) -> DataFrame:
    """The five best for every vector whose id is divisible by 50, among all others."""
    return exact_top_k(embeddings, embeddings.where(F.col("vec_id") % 50 == 0))


OP8_SQL = """
WITH fine AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(
    list_transform(q.v, lambda x: CAST(x AS DOUBLE)), list_transform(c.v, lambda x: CAST(x AS DOUBLE))) AS BIGINT) AS score
  FROM fine q JOIN fine c ON c.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""
