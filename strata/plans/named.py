"""Stored tables by name: external tables of the session's catalogue.

``declare`` names the Parquet folders of serving and Gold as tables of a database, with
their partitions and column statistics, so SQL finds them by name, prunes partitions in the
catalogue and has row counts and distinct values for its join order. Files stay where they
are; declaring again points the names at the folders anew.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from strata.operators import tables


def declare(spark: SparkSession, database: str, name: str, path: str, schema: T.StructType, partition_col: str | None = None,
            statistics: bool = True) -> str:
    """Name the Parquet table at ``path``; returns the qualified name. ``schema`` includes the partition column."""
    full = f"`{database}`.`{name}`"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    spark.sql(f"DROP TABLE IF EXISTS {full}")
    fields = [f for f in schema.fields if f.name != partition_col] + [f for f in schema.fields if f.name == partition_col]
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    by = f" PARTITIONED BY (`{partition_col}`)" if partition_col else ""
    place = path.replace("'", "\\'")
    spark.sql(f"CREATE TABLE {full} ({columns}) USING parquet{by} LOCATION '{place}'")
    if partition_col:
        spark.sql(f"MSCK REPAIR TABLE {full}")
    if statistics and tables.table_exists(spark, path):
        spark.sql(f"ANALYZE TABLE {full} COMPUTE STATISTICS FOR ALL COLUMNS")
    return f"{database}.{name}"
