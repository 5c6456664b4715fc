"""Merge on read: a keyed table of a base and the deltas since.

Layout below ``path``::

    base/<partition>=.../            one row per key, compacted
    delta/_seq=<n>/<partition>=.../  the rows of load n, one row per key

A load appends its rows as one delta and reads or rewrites nothing else, so a late row
costs one row. A reader takes, of all rows of a key, those of the latest load: deltas are
reduced to it, and the base rows of their partitions whose key a delta holds are left out.
Partitions without a delta are read as they are. ``compact`` folds deltas into the base,
partition by partition; until it has removed them they give the same rows, so a reader
between the two steps, and a run after a crash, see the same table.

Loads are numbered by the caller (a run's or a micro-batch's id): writing a number again
replaces that load. Compaction must not run beside itself; loads of new numbers may run
beside it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators import tables

SEQ = "_seq"


def _delta(path: str) -> str:
    return f"{path.rstrip('/')}/delta"


def _base(path: str) -> str:
    return f"{path.rstrip('/')}/base"


def delta_numbers(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the loads that aren't compacted yet, from a listing."""
    return sorted(int(v) for v in tables.list_partitions(spark, _delta(path), SEQ))


def append_delta(spark: SparkSession, path: str, source: DataFrame, partition_col: str, seq: int) -> None:
    """Write ``source`` (one row per key) as load ``seq``; nothing stored is read or rewritten."""
    tables.write_table(source, f"{_delta(path)}/{SEQ}={int(seq)}", partition_col, whole=True)


def _touched(spark: SparkSession, path: str, partition_col: str, numbers: list[int]) -> list[str]:
    """Partitions that the deltas of ``numbers`` hold rows of, from listings."""
    return sorted({v for n in numbers for v in tables.list_partitions(spark, f"{_delta(path)}/{SEQ}={n}", partition_col)})


def _read_deltas(spark: SparkSession, path: str, schema: T.StructType, numbers: list[int]) -> DataFrame:
    fields = T.StructType(schema.fields + [T.StructField(SEQ, T.LongType(), True)])
    folders = [f"{_delta(path)}/{SEQ}={n}" for n in numbers]
    return spark.read.schema(fields).option("basePath", _delta(path)).parquet(*folders)


def latest(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of each key's latest load; NULLs in a key are equal. Planned with a limit per
    group before the shuffle, so a key that came in every load is reduced where it is read."""
    first = Window.partitionBy(*keys).orderBy(F.col(SEQ).desc())
    return rows.withColumn("_nth", F.row_number().over(first)).where("_nth = 1").drop("_nth", SEQ)


def _merged(spark: SparkSession, path: str, schema: T.StructType, keys: list[str], partition_col: str,
            numbers: list[int], touched: list[str]) -> DataFrame:
    """The rows of the partitions that the deltas of ``numbers`` touch, base and deltas together."""
    fresh = latest(_read_deltas(spark, path, schema, numbers), keys).select(*schema.names)
    if not tables.table_exists(spark, _base(path)):
        return fresh
    old = tables.in_partitions(tables.read_table(spark, _base(path), schema), partition_col, touched)
    replaced = _read_deltas(spark, path, schema, numbers).select(*[F.col(k).alias(f"_src_{k}") for k in keys]).distinct()
    same = [old[k].eqNullSafe(replaced[f"_src_{k}"]) for k in keys]
    kept = old.join(replaced, same, "left_anti")
    return kept.select(*schema.names).unionByName(fresh)


def read_merged(spark: SparkSession, path: str, schema: T.StructType, keys: list[str], partition_col: str) -> DataFrame:
    """The table: of each key the row of the latest load."""
    numbers = delta_numbers(spark, path)
    stored = tables.table_exists(spark, _base(path))
    base = tables.read_table(spark, _base(path), schema) if stored else spark.createDataFrame([], schema)
    if not numbers:
        return base
    touched = _touched(spark, path, partition_col, numbers)
    if not touched:
        return base
    merged = _merged(spark, path, schema, keys, partition_col, numbers, touched)
    if not stored:
        return merged
    names = [v for v in touched if v != tables.NULL_PARTITION]
    value = F.col(partition_col)
    rest = base.where(value.isNull() if not names else value.isNull() | ~value.cast("string").isin(names))
    if tables.NULL_PARTITION in touched:
        rest = rest.where(value.isNotNull())
    return rest.select(*schema.names).unionByName(merged)


def compact(spark: SparkSession, path: str, schema: T.StructType, keys: list[str], partition_col: str) -> list[str]:
    """Fold the deltas that are there now into the base; returns the partitions rewritten.

    The merged partitions replace their old ones when the job commits; then the folded
    deltas are removed."""
    numbers = delta_numbers(spark, path)
    touched = _touched(spark, path, partition_col, numbers)
    if touched:
        merged = _merged(spark, path, schema, keys, partition_col, numbers, touched)
        tables.write_table(merged, _base(path), partition_col)
    for n in numbers:
        tables.delete_path(spark, f"{_delta(path)}/{SEQ}={n}")
    return touched
