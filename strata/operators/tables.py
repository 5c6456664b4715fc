"""Table maintenance on partitioned Parquet: keyed upsert, partition replace,
insert-if-absent, and the late-data lookback.

All writes use dynamic partition overwrite: a job replaces exactly the
partitions it writes, staged and committed at the end of the job, so tasks that
fail or are retried (lost executors included) leave the previous partitions in
place, and a re-run of the same input gives the same table. The commit itself
replaces folder by folder: a driver that dies in it leaves some partitions old
and some new (one may be missing); running the job again repairs that. Where a
commit must be atomic, use a table format with a log.
"""

from __future__ import annotations

from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.clean import dedup


# Folder name Spark gives the partition of NULL values.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"

# ---------------------------------------------------------------- file system

def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def table_exists(spark: SparkSession, path: str) -> bool:
    fs, p, _ = _fs(spark, path)
    return bool(fs.exists(p))


def delete_path(spark: SparkSession, path: str) -> bool:
    fs, p, _ = _fs(spark, path)
    return bool(fs.delete(p, True)) if fs.exists(p) else False


def partition_path(path: str, column: str, value) -> str:
    return f"{path.rstrip('/')}/{column}={value}"


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Read a Parquet table; with ``schema`` the partition column keeps its
    declared type (e.g. DATE) instead of being inferred."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(path)


def write_table(df: DataFrame, path: str, partition_by: str | None = None, mode: str = "overwrite",
                whole: bool = False) -> None:
    """Write Parquet (``whole``: replace the table, else only the partitions written), rows clustered by the partition value first so each task
    writes few partition folders (no small-file explosion).

    Clustering uses the REBALANCE hint rather than ``repartition(col)``: AQE
    splits a partition value that holds far more rows than the advisory size
    (one busy day) over several tasks and merges small ones, where a plain
    hash repartition would put each whole day into a single task."""
    if partition_by:
        df = df.hint("rebalance", partition_by)
    writer = df.write.mode(mode).option("partitionOverwriteMode", "static" if whole else "dynamic")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)


# ---------------------------------------------------------------- keys

def _match(target: DataFrame, source: DataFrame, keys: list[str], null_safe: bool) -> Column:
    conds = [target[k].eqNullSafe(source[f"_src_{k}"]) if null_safe else target[k] == source[f"_src_{k}"]
             for k in keys]
    return reduce(lambda a, b: a & b, conds)


def in_partitions(df: DataFrame, column: str, values: list[str]) -> DataFrame:
    """Rows of the partitions named by folder values, the one of NULL included."""
    cond = F.col(column).cast("string").isin([v for v in values if v != NULL_PARTITION])
    return df.where(cond | F.col(column).isNull() if NULL_PARTITION in values else cond)


def _source_keys(source: DataFrame, keys: list[str]) -> DataFrame:
    return source.select(*[F.col(k).alias(f"_src_{k}") for k in keys])


# ---------------------------------------------------------------- operators

def list_partitions(spark: SparkSession, path: str, column: str) -> list[str]:
    """Values of ``column=`` folders directly below ``path`` (listing only)."""
    fs, p, _ = _fs(spark, path)
    if not fs.exists(p):
        return []
    prefix = f"{column}="
    return sorted(st.getPath().getName()[len(prefix):] for st in fs.listStatus(p)
                  if st.isDirectory() and st.getPath().getName().startswith(prefix))


def upsert(spark: SparkSession, path: str, source: DataFrame, keys: list[str],
           partition_col: str, schema: T.StructType | None = None, null_safe: bool = True) -> list[str]:
    """MERGE on ``keys``: matched target rows are replaced by the source row,
    unmatched source rows are inserted, other target rows stay. Returns the
    partitions rewritten.

    The source batch is computed once and written partitioned to a staging
    table in the shared checkpoint folder (this also cuts its lineage), so the
    partitions it touches come from a folder listing, not a second pass.
    Only those partitions of the target are read and rewritten (a key never
    changes partition: the partition value derives from a key part). Keys
    compare NULL-safe by default, so a re-run never duplicates rows whose key
    holds a NULL. The source must hold one row per key (dedup first).
    """
    from strata.session import work_path
    if not table_exists(spark, path):
        write_table(source, path, partition_col)
        return list_partitions(spark, path, partition_col)
    stage = work_path(spark, "upsert-source")
    try:
        write_table(source, stage, partition_col)
        touched = list_partitions(spark, stage, partition_col)
        if not touched:
            return []
        # The source's schema also reads a target that exists but holds no files
        # yet (an earlier empty load), where inference would fail.
        target = read_table(spark, path, schema or source.schema)
        src = read_table(spark, stage, target.schema)
        pruned = in_partitions(target, partition_col, touched)
        src_keys = _source_keys(src, keys)
        kept = pruned.join(src_keys, _match(pruned, src_keys, keys, null_safe), "left_anti")
        write_table(kept.unionByName(src.select(*target.columns)), path, partition_col)
        return touched
    finally:
        delete_path(spark, stage)


def merge_distinct(spark: SparkSession, path: str, source: DataFrame, keys: list[str], partition_col: str,
                   order_by: list[str] | None = None) -> list[str]:
    """Keep one row per key over the table and ``source`` together: the first by
    ``order_by``, whichever load brought it, so loads in any order (and replayed
    ones) give the same table. Only partitions ``source`` has rows in are rewritten;
    a key must not change partition. Returns them."""
    from strata.session import work_path
    stage = work_path(spark, "merge-source")
    try:
        write_table(source, stage, partition_col)
        touched = list_partitions(spark, stage, partition_col)
        if not touched:
            return []
        rows = read_table(spark, stage, source.schema)
        if table_exists(spark, path):
            stored = in_partitions(read_table(spark, path, source.schema), partition_col, touched)
            rows = rows.unionByName(stored)
        write_table(dedup(rows, keys=keys, order_by=order_by), path, partition_col)
        return touched
    finally:
        delete_path(spark, stage)


def observed(obs: Observation, source: DataFrame) -> dict:
    """Metrics of ``obs`` after the action ran. A plan the optimizer proved
    empty runs no task and reports nothing; only then is an empty result
    (all counts 0) the right reading."""
    try:
        return dict(obs.get)
    except Py4JJavaError:  # no metrics were reported
        if not source.isEmpty():
            raise
        return {}


def replace_partitions(spark: SparkSession, path: str, df: DataFrame, partition_col: str,
                       owned: list | None = None, observe: bool = True) -> dict:
    """Make the table's ``owned`` partitions hold exactly ``df``'s rows (the
    day delete-then-insert). Partitions of ``owned`` that ``df`` has no rows
    for are removed, so re-loading an emptied day clears it.

    Rows per owned partition are observed during the write itself (no second
    pass over ``df``). Returns those counts. ``observe=False`` is for micro-batches,
    whose plans report no observations: the owned partitions are removed first, and
    no counts are returned.
    """
    owned = [str(v) for v in (owned or [])]
    counts: dict = {}
    source = df
    if not observe:
        for v in owned:
            delete_path(spark, partition_path(path, partition_col, v))
        write_table(df, path, partition_col)
        return counts
    if owned:
        obs = Observation("owned_partitions")
        value = F.col(partition_col).cast("string")
        df = df.observe(obs, *[F.count(F.when(value == F.lit(v), F.lit(1))).alias(f"p{i}")
                               for i, v in enumerate(owned)])
    write_table(df, path, partition_col)
    if owned:
        got = observed(obs, source)
        counts = {v: int(got.get(f"p{i}", 0)) for i, v in enumerate(owned)}
        for v, n in counts.items():
            if n == 0:
                delete_path(spark, partition_path(path, partition_col, v))
    return counts


def insert_absent(spark: SparkSession, path: str, source: DataFrame, key: str,
                  order_by: list[str] | None = None) -> None:
    """INSERT ... ON CONFLICT (key) DO NOTHING: append the source rows whose
    key is not in the table yet (first row per key within the source).
    Existing rows are never rewritten; only new rows are written."""
    fresh = dedup(source.where(F.col(key).isNotNull()), keys=[key], order_by=order_by)
    if not table_exists(spark, path):
        write_table(fresh, path)
        return
    existing = read_table(spark, path, fresh.schema).select(key)
    fresh.join(existing, key, "left_anti").write.mode("append").parquet(path)


def lookback_bound(df: DataFrame, column: str, days: int) -> str | None:
    """``max(column) - days`` as timestamp text in the session zone (one
    scalar), or None for an empty table (then everything is in the window)."""
    row = df.agg(F.date_format(F.max(column) - F.make_dt_interval(F.lit(days)),
                               "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("b")).first()
    return None if row is None else row["b"]


def partitioned_lookback_bound(spark: SparkSession, path: str, column: str, partition_col: str,
                               days: int) -> str | None:
    """``lookback_bound`` for a table partitioned by the date of ``column``:
    the maximum lies in the newest partition, so only that partition is
    scanned (found from the folder listing) instead of the whole table."""
    parts = [v for v in list_partitions(spark, path, partition_col) if v != NULL_PARTITION]
    if not parts:
        return None   # no dated rows yet: everything is inside the window
    newest = read_table(spark, path).where(F.col(partition_col).cast("string") == F.lit(parts[-1]))
    return lookback_bound(newest, column, days)


def within_lookback(df: DataFrame, column: str, bound: str | None) -> DataFrame:
    """Rows at or after ``bound``; a literal bound lets the scan prune files
    and row groups by min/max statistics."""
    if bound is None:
        return df
    return df.where(F.col(column) >= F.lit(bound).cast(df.schema[column].dataType))
