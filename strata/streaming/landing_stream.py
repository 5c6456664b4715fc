"""Landing pick-up by file: a CSV file stream whose checkpoint keeps the files it has read.

Each run reads the files that came since the last one, never those before, and stages
their rows by day, a folder per batch (a replayed batch replaces its own). The rows are
those of a whole ``scan_csv`` and ``staged``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata import schemas
from strata.operators import tables
from strata.sources import bronze as bronze_src
from strata.sources.csv import DEFAULT_FILE_YEAR, FILE_YEAR_PATTERN
from strata.streaming.late import LateRows, drain


def with_file_year(rows: DataFrame, default_year: str = DEFAULT_FILE_YEAR) -> DataFrame:
    """``file_year`` of each row from its file's name (of its folder's, for Spark's own part files), as
    ``csv.file_year`` reads it."""
    parts = F.transform(F.split(F.col("_metadata.file_path"), "/"), F.url_decode)
    name = F.element_at(parts, -1)
    year = F.regexp_extract(F.when(name.startswith("part-"), F.element_at(parts, -2)).otherwise(name), FILE_YEAR_PATTERN, 1)
    return rows.withColumn("file_year", F.when(year == "", default_year).otherwise(year))


def landing_stream(spark: SparkSession, landing: str, schema: T.StructType = schemas.RAW_CLICKSTREAM,
                   max_files_per_trigger: int | None = None) -> DataFrame:
    """The CSV files below ``landing`` (in folders per period, or none) as a stream."""
    reader = spark.readStream.schema(schema).option("header", True).option("mode", "PERMISSIVE").option("recursiveFileLookup", True)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.csv(landing)


def stage_landing(spark: SparkSession, landing: str, staging: str, checkpoint: str, schema: T.StructType = schemas.RAW_CLICKSTREAM,
                  max_files_per_trigger: int | None = None, timeout_s: float | None = None) -> dict:
    """Stage the files that came since the last run with ``checkpoint``. Returns the rows ``read``
    and ``staged`` (the others have an unreadable time or another year than their file)."""
    staged: dict[int, int] = {}

    def write(batch: DataFrame, batch_id: int) -> None:
        folder = tables.partition_path(staging, "batch_id", batch_id)
        rows = bronze_src.staged(batch).hint("rebalance", *bronze_src.PARTS)
        rows.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*bronze_src.PARTS).parquet(folder)
        staged[batch_id] = read_staged(batch.sparkSession, staging, schema, batch_id).count()

    with LateRows(spark) as progress:
        query = with_file_year(landing_stream(spark, landing, schema, max_files_per_trigger)).writeStream.foreachBatch(write)
        drain(query.option("checkpointLocation", checkpoint).trigger(availableNow=True).start(), timeout_s)
    return {"read": progress.read, "staged": sum(staged.values())}


def read_staged(spark: SparkSession, staging: str, schema: T.StructType = schemas.RAW_CLICKSTREAM, batch_id: int | None = None) -> DataFrame:
    """The staged rows, of all batches or of one."""
    reader = spark.read.schema(T.StructType([*bronze_src.staged_schema(schema).fields, T.StructField("batch_id", T.LongType())]))
    path = staging if batch_id is None else tables.partition_path(staging, "batch_id", batch_id)
    return reader.option("basePath", staging).parquet(path).drop("batch_id")
