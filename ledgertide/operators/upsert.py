"""Keyed writes into Parquet tables.

A table is a directory of Parquet files, partitioned by a date column where its
schema names one and, below that, by a bucket of its key. An upsert reads and
writes only the (day, bucket) pairs that its source touches, in one job: Spark's
dynamic overwrite puts the new files of a pair in place of the old ones when the
job has ended, so a plan may read what it overwrites, a lost executor only repeats
its own tasks, and a failed job changes nothing. Running the same upsert twice
gives the same table.

The number of buckets is fixed by the first write and kept in the name of the
bucket column (``bucket_of_4=3``), so a later writer cannot miss stored rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .dedup import dedup_last

BUCKET = "bucket_of_"
#: Beyond so many touched (day, bucket) pairs the whole touched days are rewritten.
MOST_PAIRS = 20_000


def _fs_path(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def table_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs_path(spark, path)
    return fs.exists(p) and any(
        not s.getPath().getName().startswith(("_", ".")) for s in fs.listStatus(p))


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table, or an empty frame of its schema before the first write."""
    if table_exists(spark, path):
        return spark.read.schema(schema).parquet(path).select(*schema.names)
    return spark.createDataFrame([], schema)


def stored_buckets(spark: SparkSession, path: str) -> int | None:
    """Number of buckets of a stored table, read off its directory names; ``None`` before the first write."""
    fs, p = _fs_path(spark, path)
    while fs.exists(p):
        below = [s.getPath() for s in fs.listStatus(p) if s.isDirectory() and not s.getPath().getName().startswith(("_", "."))]
        if not below:
            break
        p = below[0]
        if p.getName().startswith(BUCKET):
            return int(p.getName().removeprefix(BUCKET).split("=")[0])
    return None


def _bucket(keys: Sequence[str], schema: T.StructType, buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(k).cast(schema[k].dataType) for k in keys]), F.lit(buckets)).cast("int")


def _drop(spark: SparkSession, path: str) -> None:
    fs, p = _fs_path(spark, path)
    fs.delete(p, True)


def _null_safe(left: str, right: str, keys: Sequence[str]) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}"))
    return cond


def merged_rows(target: DataFrame, src: DataFrame, keys: Sequence[str], guard: str | None = None) -> DataFrame:
    """Target after the upsert, each row with ``_op``: keep, insert, update or stale.

    One full outer join on the null-safe keys.  With ``guard`` a source row that
    is older than the stored one (by that column) leaves the stored row in place.
    ``src`` must hold each key once.
    """
    cols = target.columns
    old = target.select(F.struct(*[F.col(c) for c in cols]).alias("_old"), *[F.col(k) for k in keys]).alias("o")
    new = src.select(F.struct(*[F.col(c) for c in cols]).alias("_new"), *[F.col(k) for k in keys]).alias("n")
    joined = old.join(new, _null_safe("o", "n", keys), "full_outer").select("_old", "_new")
    stale = F.lit(False)
    if guard:
        stale = F.coalesce(F.col("_old")[guard] > F.col("_new")[guard], F.lit(False))
    op = (
        F.when(F.col("_new").isNull(), "keep").when(F.col("_old").isNull(), "insert")
        .when(stale, "stale").otherwise("update")
    )
    row = F.when(F.col("_new").isNull() | stale, F.col("_old")).otherwise(F.col("_new"))
    return joined.select(op.alias("_op"), row.alias("_row")).select("_op", "_row.*")


def upsert(
    spark: SparkSession, path: str, src: DataFrame, schema: T.StructType, keys: Sequence[str],
    order_cols: Sequence[str], partition_col: str | None = None, key_fixes_partition: bool = True,
    guard: str | None = None, buckets: int = 1,
) -> dict[str, int]:
    """Insert or replace by key, last writer wins; returns the row counts.

    Of several source rows with one key the last by ``order_cols`` counts. The
    counts are taken while the new files are written. ``buckets`` counts for the
    first write only; a stored table keeps its own number.

    ``src`` is evaluated twice (once for the days and buckets it touches), so a
    caller whose source is expensive persists it.

    ``key_fixes_partition``: equal keys always have equal ``partition_col`` (true
    for keys that hold the date or a ledger). Otherwise the partitions that
    already hold a matching key are looked up first and rewritten as well.
    """
    names = schema.names
    buckets = stored_buckets(spark, path) or buckets
    bucket = f"{BUCKET}{buckets}"
    places = [partition_col, bucket] if partition_col else [bucket]
    last = dedup_last(src, keys, order_cols).select(*names, _bucket(keys, schema, buckets).alias(bucket))
    if not table_exists(spark, path):
        _write(last, path, places, "append")
        return {"inserted": read_table(spark, path, schema).count(), "updated": 0, "stale": 0}

    target = spark.read.schema(schema).parquet(path).select(*names, bucket)
    # One value per day and bucket of the source: bounded by the time span.
    touched = {tuple(r) for r in src.select(*names).withColumn(bucket, _bucket(keys, schema, buckets)).select(*places).distinct().collect()}
    if partition_col and not key_fixes_partition:
        held = target.join(last.select(*keys), list(keys), "left_semi").select(*places).distinct()
        touched |= {tuple(r) for r in held.collect()}
    none = {"inserted": 0, "updated": 0, "stale": 0}
    if not touched:
        return none
    merged = merged_rows(target.filter(_at(places, touched)), last, keys, guard)
    if partition_col and not key_fixes_partition:
        kept = {tuple(r) for r in merged.select(*places).distinct().collect()}
    seen = Observation()
    ops = {"inserted": "insert", "updated": "update", "stale": "stale"}
    counted = merged.hint("rebalance", *places).observe(seen, *[F.count_if(F.col("_op") == op).alias(n) for n, op in ops.items()])
    _overwrite(counted.drop("_op"), path, places, "overwrite")
    if partition_col and not key_fixes_partition:
        for day, number in touched - kept:
            name = "__HIVE_DEFAULT_PARTITION__" if day is None else day
            _drop(spark, f"{path.rstrip('/')}/{partition_col}={name}/{bucket}={number}")
    return none | {n: int(seen.get[n]) for n in ops}


def keep_newest(spark: SparkSession, path: str, src: DataFrame, schema: T.StructType, keys: Sequence[str], group: Sequence[str],
                newest: Sequence[Column], limit: int, buckets: int = 1) -> None:
    """Keep the first ``limit`` rows of each group by ``newest``; a source row replaces the stored one of its key.

    Reads and writes only the buckets (of the group) that the source touches: a
    bounded number of rows, whatever has passed. Equal keys must have equal
    groups and places in the order; then the table is what the whole history
    would give, and a repeated call changes nothing.
    """
    buckets = stored_buckets(spark, path) or buckets
    bucket = f"{BUCKET}{buckets}"

    def first(rows: DataFrame) -> DataFrame:
        rank = F.row_number().over(Window.partitionBy(*group).orderBy(*newest))
        return rows.withColumn("_rank", rank).filter(F.col("_rank") <= limit).drop("_rank")

    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*newest))
    once = src.select(*schema.names).withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")
    news = first(once).withColumn(bucket, _bucket(group, schema, buckets)).persist()
    try:
        if not table_exists(spark, path):
            return _write(news, path, [bucket], "append")
        touched = [r[0] for r in news.select(bucket).distinct().collect()]  # at most one value per bucket
        if touched:
            held = spark.read.schema(schema).parquet(path).select(*schema.names, bucket).filter(F.col(bucket).isin(touched))
            kept = held.join(news.select(*keys), list(keys), "left_anti")
            _write(first(kept.unionByName(news)), path, [bucket], "overwrite")
    finally:
        news.unpersist()


def overwrite_days(spark: SparkSession, path: str, rows: DataFrame, partition_col: str) -> None:
    """Put ``rows`` in place of the stored ones of their days."""
    _write(rows, path, [partition_col], "overwrite")


def _at(places: Sequence[str], touched: set) -> Column:
    """Whether a row lies at one of the places; made of partition columns alone, so it picks the files to read."""
    if len(touched) > MOST_PAIRS and len(places) > 1:
        days = {day for day, _ in touched}
        known = F.col(places[0]).isin([d for d in days if d is not None])
        return known | F.col(places[0]).isNull() if None in days else known
    name = F.concat_ws("/", *[F.coalesce(F.col(p).cast("string"), F.lit("-")) for p in places])
    return name.isin(sorted("/".join("-" if v is None else str(v) for v in place) for place in touched))


def _write(rows: DataFrame, path: str, places: Sequence[str], mode: str) -> None:
    # The rows of a day's bucket are brought together so that they become few files;
    # adaptive execution splits what is too large for one task and joins small ones.
    _overwrite(rows.hint("rebalance", *places), path, places, mode)


def _overwrite(rows: DataFrame, path: str, places: Sequence[str], mode: str) -> None:
    rows.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(*places).parquet(path)


def conditional_merge(target: DataFrame, src: DataFrame, keys: Sequence[str],
                      rules: Mapping[str, Column | None]) -> DataFrame:
    """Merge that may keep old values column by column.

    ``rules[c]`` is a condition over ``new``/``old`` under which the new value of
    column ``c`` is taken; ``None`` takes it always.  Columns without a rule keep
    the old value where the row exists.
    """
    o, n = target.alias("old"), src.alias("new")
    joined = o.join(n, _null_safe("old", "new", keys), "full_outer")
    old_there = F.coalesce(*[F.col(f"old.{k}").isNotNull() for k in keys])
    new_there = F.coalesce(*[F.col(f"new.{k}").isNotNull() for k in keys])
    out = []
    for c in target.columns:
        if c in keys:
            out.append(F.coalesce(F.col(f"new.{c}"), F.col(f"old.{c}")).alias(c))
        elif c not in src.columns:
            out.append(F.col(f"old.{c}").alias(c))
        else:
            new, old = F.col(f"new.{c}"), F.col(f"old.{c}")
            if c in rules:
                take = new_there if rules[c] is None else new_there & F.coalesce(rules[c], F.lit(False))
                out.append(F.when(~old_there | take, new).otherwise(old).alias(c))
            else:
                out.append(F.when(old_there, old).otherwise(new).alias(c))
    return joined.select(*out)


def missing_rows(target: DataFrame, src: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows whose key the target does not hold yet."""
    return src.join(target.select(*keys), list(keys), "left_anti")


def insert_missing(spark: SparkSession, path: str, src: DataFrame, schema: T.StructType, keys: Sequence[str],
                   order_cols: Sequence[str], partition_col: str | None = None, buckets: int = 1) -> dict[str, int]:
    """Append only what is missing; no stored file is touched.

    Of several source rows with one key the last by ``order_cols`` counts. Rows
    are counted from the files' footers before and after.
    """
    stored = read_table(spark, path, schema)
    before = stored.count()
    fresh = dedup_last(missing_rows(stored, src, keys), keys, order_cols)
    buckets = stored_buckets(spark, path) or buckets
    bucket = f"{BUCKET}{buckets}"
    _write(fresh.select(*schema.names, _bucket(keys, schema, buckets).alias(bucket)), path,
           [partition_col, bucket] if partition_col else [bucket], "append")
    return {"inserted": read_table(spark, path, schema).count() - before, "updated": 0, "stale": 0}
