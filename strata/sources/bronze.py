"""Staging and Bronze: raw rows stored as Parquet partitioned by the
``year/month/day`` text of their event time."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata import schemas
from strata.operators.tables import observed

PARTS = ["year", "month", "day"]


def day_parts(run_date: str | _dt.date) -> dict[str, str]:
    d = str(run_date)
    return {"year": d[:4], "month": d[5:7], "day": d[8:10]}


def staged(raw_with_file_year: DataFrame) -> DataFrame:
    """Add year/month/day by position in the time text and keep rows whose
    year equals their file's year (drops unreadable times and strays)."""
    t = F.col("event_time")
    return (raw_with_file_year
            .withColumn("year", F.substring(t, 1, 4))
            .withColumn("month", F.substring(t, 6, 2))
            .withColumn("day", F.substring(t, 9, 2))
            .where(F.col("year") == F.col("file_year"))
            .drop("file_year"))


def stage_by_day(raw_with_file_year: DataFrame, staging_root: str, local_sort: bool = False) -> dict[str, int]:
    """Write staged rows partitioned by year/month/day in one job; the staging
    folder then holds these rows only. Returns the rows ``read`` and ``staged``,
    counted during the write: the others had an unreadable time or another year.

    Default: REBALANCE by day, so output files are sized by AQE whatever the
    landing layout (big days split over tasks, small ones merged) at the
    cost of one shuffle of the raw rows. ``local_sort=True`` skips the
    shuffle and sorts each input split by day instead (one file per split
    and day): the cheaper choice when landing files are time-ordered, such
    as one file per month.
    """
    read, kept = Observation("read"), Observation("staged")
    counted = raw_with_file_year.observe(read, F.count(F.lit(1)).alias("rows"))
    df = staged(counted).observe(kept, F.count(F.lit(1)).alias("rows"))
    df = df.sortWithinPartitions(*PARTS) if local_sort else df.hint("rebalance", *PARTS)
    (df.write.mode("overwrite").option("partitionOverwriteMode", "static")
       .partitionBy(*PARTS).parquet(staging_root))
    return {"read": observed(read, raw_with_file_year).get("rows", 0),
            "staged": observed(kept, df).get("rows", 0)}


def staged_schema(raw_schema: T.StructType = schemas.RAW_CLICKSTREAM) -> T.StructType:
    """Raw schema plus the string partition keys ('01' stays '01')."""
    return T.StructType(raw_schema.fields + [T.StructField(c, T.StringType(), True) for c in PARTS])


def scan_day(spark: SparkSession, root: str, run_date, schema: T.StructType | None = None) -> DataFrame:
    """One day of a year/month/day-partitioned table, read from its folder (the
    rest of the table is not listed)."""
    return scan_days(spark, root, [run_date], schema)


def day_folder(root: str, run_date) -> str:
    p = day_parts(run_date)
    return f"{root.rstrip('/')}/year={p['year']}/month={p['month']}/day={p['day']}"


def scan_days(spark: SparkSession, root: str, run_dates: list, schema: T.StructType | None = None) -> DataFrame:
    """Some days in one scan over their folders; a day without a folder has no rows."""
    jvm = spark.sparkContext._jvm
    base = jvm.org.apache.hadoop.fs.Path(root)
    fs = base.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    folders = [f for f in (day_folder(root, d) for d in run_dates) if fs.exists(jvm.org.apache.hadoop.fs.Path(f))]
    reader = spark.read.schema(schema or staged_schema())
    if not folders:
        return reader.parquet(root).limit(0) if fs.exists(base) else spark.createDataFrame([], schema or staged_schema())
    return reader.option("basePath", root).parquet(*folders)


def staged_days(spark: SparkSession, root: str) -> list[str]:
    """Days present in a year=/month=/day= folder tree, from the listing only."""
    jvm = spark.sparkContext._jvm
    base = jvm.org.apache.hadoop.fs.Path(root)
    fs = base.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = []
    for y in fs.globStatus(jvm.org.apache.hadoop.fs.Path(base, "year=*/month=*/day=*")):
        p = y.getPath()
        d, m, yy = p.getName(), p.getParent().getName(), p.getParent().getParent().getName()
        out.append(f"{yy.split('=')[1]}-{m.split('=')[1]}-{d.split('=')[1]}")
    return sorted(out)


def publish_day(spark: SparkSession, staging_root: str, bronze_root: str, run_date,
                schema: T.StructType | None = None) -> None:
    """Copy one staged day to Bronze; re-publishing replaces that day only.
    Raises when the day has no staged files."""
    publish_days(spark, staging_root, bronze_root, [run_date], schema)


def publish_days(spark: SparkSession, staging_root: str, bronze_root: str, run_dates: list,
                 schema: T.StructType | None = None) -> None:
    """Copy some staged days to Bronze in one job, replacing those days only.
    Raises, before any is copied, when one has no staged files."""
    jvm = spark.sparkContext._jvm
    for d in run_dates:
        path = jvm.org.apache.hadoop.fs.Path(day_folder(staging_root, d))
        fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        if not fs.exists(path) or not any(s.getPath().getName().endswith(".parquet") for s in fs.listStatus(path)):
            raise FileNotFoundError(f"no staged files for {d} at {path.toString()}")
    days = scan_days(spark, staging_root, run_dates, schema)
    (days.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(*PARTS).parquet(bronze_root))
