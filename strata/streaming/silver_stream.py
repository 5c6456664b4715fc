"""Structured Streaming forms of the Silver load.

* ``stream_silver`` — incremental pick-up of newly landed Bronze files
  (file source + checkpoint), each micro-batch going through the same
  parse → quarantine/clean → dedup → enrich → upsert code as the batch job
  (``foreachBatch``; Silver by key and quarantine by batch, so a replayed batch
  replaces what it wrote).
* ``stream_dedup`` — exact deduplication: each micro-batch is merged into the
  stored table (``tables.merge_distinct``), so late files and any order of files
  give the table of one load. The state is the table itself.
* ``dedup_stream`` — deduplication with bounded state, for sources known to be
  no later than the watermark: ``dropDuplicatesWithinWatermark`` drops later rows.
  ``stream_dedup_watermark`` runs it and counts what it drops, so that rows written,
  late rows and duplicates add up to the rows read.

``trigger(availableNow=True)`` drains what is there and stops — the daily
schedule of the batch job; a long-running trigger works the same way.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators import tables
from strata.operators.clean import DEDUP_KEYS, clean, parse
from strata.plans import daily
from strata.sources import bronze as bronze_src
from strata.streaming.late import LateRows, drain

WATERMARK = "2 days"


def bronze_stream(spark: SparkSession, bronze_root: str, schema: T.StructType,
                  max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(bronze_root)


def stream_silver(spark: SparkSession, bronze_root: str, P: daily.Paths, crm: DataFrame,
                  schema: T.StructType, checkpoint: str, max_files_per_trigger: int | None = None,
                  timeout_s: float | None = None, merge_on_read: bool = False):
    """Run the Bronze → Silver stream until the available files are drained. With
    ``merge_on_read`` a micro-batch appends its rows as a delta of its number and
    rewrites no stored day."""
    src = bronze_stream(spark, bronze_root, schema, max_files_per_trigger)

    def load(batch: DataFrame, batch_id: int) -> None:
        daily.bronze_to_silver(batch.sparkSession, P, crm, batch, observe=False, batch_id=batch_id,
                               delta=batch_id if merge_on_read else None)

    q = (src.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    drain(q, timeout_s)
    return q


def dedup_stream(bronze: DataFrame, delay: str = WATERMARK) -> DataFrame:
    """Cleaned rows, one per dedup key, with state bounded by the watermark."""
    rows = clean(parse(bronze)).drop(*[c for c in bronze_src.PARTS if c in bronze.columns])
    return rows.withWatermark("event_time", delay).dropDuplicatesWithinWatermark(DEDUP_KEYS)


def stream_dedup_watermark(spark: SparkSession, bronze_root: str, out_path: str, schema: T.StructType, checkpoint: str,
                           delay: str = WATERMARK, max_files_per_trigger: int | None = None,
                           timeout_s: float | None = None) -> dict:
    """Drain the files that are there through ``dedup_stream`` into ``out_path``, a folder per
    batch (a replayed batch replaces its own). Returns the rows ``written``, ``late`` (behind the
    watermark) and ``duplicates``: together the cleaned rows of those files, none lost uncounted."""
    written: dict[int, int] = {}

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        tables.replace_partitions(batch.sparkSession, out_path, rows, "batch_id", owned=[batch_id], observe=False)
        stored = tables.partition_path(out_path, "batch_id", batch_id)
        written[batch_id] = batch.sparkSession.read.parquet(stored).count() if tables.table_exists(batch.sparkSession, stored) else 0

    rows = dedup_stream(bronze_stream(spark, bronze_root, schema, max_files_per_trigger), delay)
    with LateRows(spark) as late:
        drain(rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start(), timeout_s)
    return {"written": sum(written.values()), "late": late.dropped, "duplicates": late.duplicates}


def stream_dedup(spark: SparkSession, bronze_root: str, out_path: str, schema: T.StructType,
                 checkpoint: str, max_files_per_trigger: int | None = None,
                 timeout_s: float | None = None):
    """Merge the cleaned stream into a Parquet table by day, one row per dedup key
    (the smallest by lineage id, where rows carry one)."""
    src = bronze_stream(spark, bronze_root, schema, max_files_per_trigger)
    order = ["event_id"] if "event_id" in schema.names else None

    def merge(batch: DataFrame, batch_id: int) -> None:
        rows = clean(parse(batch)).drop(*[c for c in bronze_src.PARTS if c in batch.columns])
        tables.merge_distinct(batch.sparkSession, out_path, rows, DEDUP_KEYS, "event_date", order_by=order)

    q = (src.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    drain(q, timeout_s)
    return q
