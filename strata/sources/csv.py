"""Landing CSV (gzip) scan and the CSV sink used to produce landing files."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata import schemas

# The year is the first 4-digit run in the file's name (in its
# folder's, for files in a folder per period); a file without one is taken as 2020,
# unless the caller says otherwise.
FILE_YEAR_PATTERN = r"(\d{4})"
DEFAULT_FILE_YEAR = "2020"


def landing_files(spark: SparkSession, path: str) -> list[str]:
    """Data files under ``path`` (a folder or a glob), from a listing only."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    statuses = list(fs.listStatus(p)) if fs.exists(p) and fs.getFileStatus(p).isDirectory() else list(fs.globStatus(p) or [])
    for st in [x for x in statuses if x.isDirectory() and not x.getPath().getName().startswith(("_", "."))]:
        statuses += list(fs.listStatus(st.getPath()))  # one folder per period
    return sorted(st.getPath().toString() for st in statuses
                  if st.isFile() and not st.getPath().getName().startswith(("_", ".")))


def file_year(path: str, default: str = DEFAULT_FILE_YEAR) -> str:
    """The year a landing file's name carries; Spark's own part files carry that of
    their folder's name."""
    folder, _, name = path.rpartition("/")
    if name.startswith("part-"):
        name = folder.rsplit("/", 1)[-1]
    m = re.search(FILE_YEAR_PATTERN, name)
    return m.group(1) if m else default


def scan_csv(spark: SparkSession, path: str, schema: T.StructType = schemas.RAW_CLICKSTREAM,
             default_year: str = DEFAULT_FILE_YEAR) -> DataFrame:
    """Read every CSV under ``path`` (a folder or glob) with a fixed schema (no
    inference pass; PERMISSIVE: bad numbers become NULL), adding ``file_year``
    from each file's name.

    The files are listed once and grouped by the year in their names; each
    group is one scan with the year as a literal, so no per-row work derives
    it. gzip files are not splittable (one task per file), so consumers that
    shuffle anyway (staging by day) rebalance after the scan.
    """
    files = landing_files(spark, path)
    if not files:
        raise FileNotFoundError(f"no landing files at {path}")
    by_year: dict[str, list[str]] = {}
    for f in files:
        by_year.setdefault(file_year(f, default_year), []).append(f)
    reader = spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE")
    scans = [reader.csv(group).withColumn("file_year", F.lit(year)) for year, group in sorted(by_year.items())]
    return reduce(DataFrame.unionByName, scans)


def write_csv(df: DataFrame, path: str, period: str | None = None, compression: str = "gzip") -> None:
    """Write landing files; with ``period`` (a column) one folder per value, which
    names the files' period. Rows are rebalanced by it, so a period is several files
    of one task each."""
    writer = (df.hint("rebalance", period) if period else df).write.mode("overwrite")
    writer = writer.option("header", True).option("compression", compression)
    (writer.partitionBy(period) if period else writer).csv(path)
