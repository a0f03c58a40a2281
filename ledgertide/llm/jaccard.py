"""Similarity join on word n-grams with Bayesian pruning of candidates (operator 3).

A text is the set of its five-word shingles. Texts of one set form a copy class
and are compared once. MinHash values of a class are banded; classes that meet
in a band are candidates, and connected candidates form a group. A group is
compared in square tiles of bounded size. In a tile, pairs that share a band
are compared a few MinHash values at a time: after each step a pair goes if the
posterior probability (uniform prior) that its similarity reaches the
threshold is below the tolerance. What remains is verified on the exact sets.

A tile returns one row per class (how many documents it is linked to there, and
a spanning forest of the links), so a large group of near copies makes rows in
proportion to its members and not to its pairs.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import as_bytes, library_on_workers, map_batches, owned_by, stored
from .components import components
from .wordhash import mixed, words_of

SHINGLE_WORDS = 5
THRESHOLD = 0.8
BANDS, BAND_ROWS = 40, 4  # a pair at the threshold shares no band with probability (1 - 0.8**4)**40 = 7e-10
TOLERANCE = 1e-7
STEP = 16  # MinHash values compared at a time
TILE = 256  # classes on either side of a tile
SLICE = 1 << 15
HASHED_BYTES = 1 << 20
SKETCHED_ROWS = 512

_RNG = np.random.default_rng(20240301)
_SEEDS = _RNG.integers(1, 2**63, (2, BANDS * BAND_ROWS), dtype=np.uint64)


def shingle_sets(texts: list[bytes]) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text, A-Z lower-cased; fewer than five words make one shingle.

    Texts are taken a few at a time, because hashing holds several numbers for each of their bytes.
    """
    sets, at = [], 0
    while at < len(texts):
        stop, size = at + 1, len(texts[at])
        while stop < len(texts) and size + len(texts[stop]) <= HASHED_BYTES:
            size += len(texts[stop])
            stop += 1
        sets += _shingle_sets(texts[at:stop])
        at = stop
    return sets


def _shingle_sets(texts: list[bytes]) -> list[np.ndarray]:
    words = words_of([t.lower() for t in texts])
    hashes = words.hashes()
    runs = words.runs(hashes, SHINGLE_WORDS)
    sets = []
    for first, n in zip(words.first.tolist(), words.per_text.tolist(), strict=True):
        if n >= SHINGLE_WORDS:
            sets.append(np.unique(runs[first:first + n - SHINGLE_WORDS + 1]))
        elif n:
            short = np.bitwise_xor.reduce(mixed(hashes[first:first + n] + np.arange(1, n + 1, dtype=np.uint64)))
            sets.append(np.array([short], np.uint64))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


def minhashes(sets: list[np.ndarray]) -> np.ndarray:
    """A row of 32-bit MinHash values per set (all ones for an empty set)."""
    out = np.full((len(sets), BANDS * BAND_ROWS), 2**32 - 1, np.uint32)
    odd = _SEEDS[1] | np.uint64(1)
    at = 0
    while at < len(sets):
        stop, total = at, 0
        while stop < len(sets) and (stop == at or total + len(sets[stop]) <= SLICE):
            total += len(sets[stop])
            stop += 1
        full = [i for i in range(at, stop) if len(sets[i])]
        if full:
            values = np.concatenate([sets[i] for i in full])
            starts = np.cumsum([0] + [len(sets[i]) for i in full])[:-1]
            for k in range(out.shape[1]):
                h = ((values ^ _SEEDS[0, k]) * odd[k]) >> np.uint64(32)
                out[full, k] = np.minimum.reduceat(h, starts)
        at = stop
    return out


@functools.lru_cache(maxsize=8)
def least_matches(threshold: float, tolerance: float, total: int) -> tuple[tuple[int, int], ...]:
    """``(values compared, matches needed)``: fewer make the threshold too improbable.

    With a uniform prior, P(similarity >= t | m of n match) = P(Binomial(n + 1, t) <= m).
    """
    steps = []
    for n in range(STEP, total + 1, STEP):
        below, m = 0.0, 0
        while True:
            below += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
            if below >= tolerance:
                break
            m += 1
        steps.append((n, m))
    return tuple(steps)


def similar_pairs(left: list[np.ndarray], right: list[np.ndarray], left_sig: np.ndarray, right_sig: np.ndarray, same: bool,
                  threshold: float, tolerance: float) -> tuple[np.ndarray, np.ndarray]:
    """Places of the pairs at or above the threshold; ``same``: both sides are one list, each pair once."""
    candidate = np.zeros((len(left), len(right)), bool)
    bands = [s.view(np.dtype((np.void, 4 * BAND_ROWS))).reshape(len(s), BANDS) if len(s) else s for s in (left_sig, right_sig)]
    for band in range(BANDS):
        _, names = np.unique(np.concatenate([b[:, band] for b in bands]), return_inverse=True)
        candidate |= names[:len(left), None] == names[None, len(left):]
    sizes = [np.array([len(s) for s in side]) for side in (left, right)]
    small, large = np.minimum(sizes[0][:, None], sizes[1]), np.maximum(sizes[0][:, None], sizes[1])
    candidate &= (small >= threshold * large) & (small > 0)
    if same:
        candidate &= np.arange(len(left))[:, None] < np.arange(len(right))
    a, b = np.nonzero(candidate)
    matches, done = np.zeros(len(a), np.int64), 0
    for n, needed in least_matches(threshold, tolerance, left_sig.shape[1]):
        matches += (left_sig[a, done:n] == right_sig[b, done:n]).sum(1)
        good = matches >= needed
        a, b, matches, done = a[good], b[good], matches[good], n
    keep = np.zeros(len(a), bool)
    if len(a):
        values, where = np.unique(np.concatenate(left + right), return_inverse=True)
        parts = np.split(where, np.cumsum(np.concatenate([sizes[0], sizes[1]]))[:-1])
        present = np.zeros(len(values), bool)
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(a)) + 1, [len(a)]])
        for start, stop in zip(cuts[:-1], cuts[1:], strict=True):
            mine = parts[a[start]]
            present[mine] = True
            others = [parts[len(left) + j] for j in b[start:stop]]
            lengths = np.array([len(o) for o in others])
            common = np.add.reduceat(present[np.concatenate(others)].astype(np.int64), np.cumsum(lengths) - lengths)
            keep[start:stop] = common >= threshold * (len(mine) + lengths - common) - 1e-9
            present[mine] = False
    return a[keep], b[keep]


def _tile(threshold: float, tolerance: float):
    def run(members: pa.Table) -> pa.Table:
        owned_by(__name__)
        low, high = members["low"][0].as_py(), members["high"][0].as_py()
        chunk = members["chunk"].to_numpy()
        reps, copies = members["rep"].to_numpy(), members["copies"].to_numpy()
        sets = shingle_sets(members["text"].to_pylist())
        sig = np.frombuffer(b"".join(members["sig"].to_pylist()), np.uint32).reshape(len(reps), -1)
        one, two = np.flatnonzero(chunk == low), np.flatnonzero(chunk == high)
        a, b = similar_pairs([sets[i] for i in one], [sets[i] for i in two], sig[one], sig[two], low == high, threshold, tolerance) \
            if len(one) and len(two) else (np.zeros(0, int), np.zeros(0, int))
        a, b = one[a], two[b]
        links = np.zeros(len(reps), np.int64)
        np.add.at(links, a, copies[b])
        np.add.at(links, b, copies[a])
        root = list(range(len(reps)))

        def find(x: int) -> int:
            while root[x] != x:
                root[x] = x = root[root[x]]
            return x

        for x, y in zip(a.tolist(), b.tolist(), strict=True):
            x, y = find(x), find(y)
            root[max(x, y)] = min(x, y)
        used = np.flatnonzero(links)
        return pa.table([pa.array(reps[used]), pa.array(links[used]), pa.array(reps[[find(i) for i in used.tolist()]])],
                        names=["rep", "links", "root"])

    return run


def _classes(df: DataFrame, doc_id: str, text: str, threshold: float, tolerance: float, tile: int,
             carry: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """The stored rows (with ``carry``) and the class of each."""
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (whole.slice(at, SKETCHED_ROWS) for whole in batches for at in range(0, whole.num_rows, SKETCHED_ROWS)):
            sets = shingle_sets(batch.column("text").to_pylist())
            sig = minhashes(sets)
            keys = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(keys, pa.binary()), pa.array([s.tobytes() for s in sig], pa.binary())],
                names=["row_id", "doc_id", "carried", "text", "key", "sig"])

    rows = df.select(F.monotonically_increasing_id().alias("row_id"), F.col(doc_id).cast("long").alias("doc_id"),
                     F.struct(F.col(text).isNull().alias("no_text"), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(carry) if c != text])
                     .alias("carried"), as_bytes(text).alias("text"))
    fields = StructType([*rows.schema.fields, *StructType.fromDDL("key binary, sig binary").fields])
    rows = stored(map_batches(rows, sketch, fields), "sketches")
    keyed = rows.where("key IS NOT NULL")
    classes = stored(keyed.groupBy("key").agg(F.min("row_id").alias("rep"), F.count(F.lit(1)).alias("copies"),
                                              F.first("sig").alias("sig")), "classes")

    width = 4 * BAND_ROWS
    bands = classes.select("rep", F.explode(F.transform(
        F.sequence(F.lit(0), F.lit(BANDS - 1)),
        lambda i: F.xxhash64(i, F.substring(F.col("sig"), i * width + 1, F.lit(width))))).alias("band"))
    shared = bands.groupBy("band").agg(F.min("rep").alias("a"), F.max("rep").alias("last")).where("a < last").select("band", "a")
    groups = components(bands.join(shared, "band").select("a", F.col("rep").alias("b")))

    sizes = groups.groupBy("label").agg(F.ceil(F.count(F.lit(1)) / tile).cast("int").alias("chunks"))
    chunk = F.pmod(F.xxhash64("rep"), F.col("chunks")).cast("int")
    members = (
        groups.join(sizes, "label").withColumnRenamed("node", "rep").withColumn("chunk", chunk)
        .join(classes.select("rep", "copies", "sig"), "rep")
        .join(rows.select(F.col("row_id").alias("rep"), "text"), "rep")
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .select("label", F.least("chunk", "other").alias("low"), F.greatest("chunk", "other").alias("high"), "chunk", "rep",
                "copies", "sig", "text")
    )
    library_on_workers(df.sparkSession)
    found = stored(members.groupBy("label", "low", "high").applyInArrow(_tile(threshold, tolerance),
                                                                       "rep bigint, links bigint, root bigint"), "links")
    labels = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    ranked = (
        classes.select("key", "rep", "copies").join(links, "rep", "left")
        .join(labels.withColumnRenamed("node", "rep"), "rep", "left")
        .select("key", F.col("rep").alias("copy_id"), F.coalesce("label", "rep").alias("class_row"),
                (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    )
    placed = rows.select("row_id", "doc_id", "key").join(ranked, "key", "left").select(
        "row_id", "doc_id", F.coalesce("copy_id", "row_id").alias("copy_id"),
        F.coalesce("class_row", "row_id").alias("class_row"), F.coalesce("n_links", F.lit(0)).alias("n_links"))
    least = placed.groupBy("class_row").agg(F.min("doc_id").alias("class_id"))
    return rows, placed.join(least, "class_row").select("row_id", "doc_id", "copy_id", "class_row", "class_id", "n_links")


def similarity_classes(df: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD,
                       tolerance: float = TOLERANCE, tile: int = TILE) -> DataFrame:
    """Near-duplicate classes of all rows.

    One row per input row: ``row_id``, ``doc_id``, ``copy_id`` (least
    ``row_id`` with the same shingle set), ``class_row`` (least ``row_id`` of
    all rows it is connected to), ``class_id`` (least ``doc_id`` there, nulls
    ignored) and ``n_links`` (other rows at or above the threshold). Null and
    empty texts have no shingles: each is a class of its own. Repeated rows are
    rows of one copy class. Other columns are not carried.
    """
    return _classes(df, doc_id, text, threshold, tolerance, tile)[1]


def one_per_class(df: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD,
                  tolerance: float = TOLERANCE, tile: int = TILE) -> DataFrame:
    """The rows of ``df`` that stay, with all their columns: the first (least ``doc_id``, nulls last) of each class."""
    rows, placed = _classes(df, doc_id, text, threshold, tolerance, tile, tuple(df.columns))
    member = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row_id")
    first = placed.groupBy("class_row").agg(F.min(member).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    gone = placed.join(first, "class_row").where("first.row_id <> row_id").select("row_id")
    kept = rows.join(gone, "row_id", "left_anti")
    whole = F.when(~F.col("carried.no_text"), F.col("text").cast(df.schema[text].dataType))  # stored once, not in the struct as well
    return kept.select(*[whole.alias(c) if c == text else F.col(f"carried.c{i}").alias(c) for i, c in enumerate(df.columns)])


def op3_jaccard_join(documents: DataFrame) -> DataFrame:
    """Near-duplicate class and number of links of every document."""
    return similarity_classes(documents).select("doc_id", "class_id", "n_links")
