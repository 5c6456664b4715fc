"""Distinct counts that merge: one HyperLogLog sketch per day.

A day's sketch is a few KB whatever the day holds, made with partial aggregation. A count
over any days reads their sketches only and merges them; a value that occurs on several
days counts once. The relative standard error of a merged sketch of 2^lg_k registers is
``relative_error``; small sets are counted almost exactly.
"""

from __future__ import annotations

from math import sqrt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators import tables

LG_K = 14


def relative_error(lg_k: int = LG_K) -> float:
    """One standard error of a merged sketch (1.04 over the root of the registers)."""
    return 1.04 / sqrt(1 << lg_k)


def update_sketches(spark: SparkSession, path: str, rows: DataFrame, column: str, day: str, days: list[str], lg_k: int = LG_K) -> None:
    """Replace the sketches of ``days`` by those of their rows' ``column`` (NULLs don't count)."""
    wanted = rows.where(F.col(day).isin([F.lit(d).cast("date") for d in days]))
    made = wanted.groupBy(day).agg(F.hll_sketch_agg(F.col(column), F.lit(lg_k)).alias("sketch"), F.count(column).alias("rows"))
    tables.replace_partitions(spark, path, made, day, owned=days)


def merged_count(sketches: DataFrame, *by: str) -> DataFrame:
    """Estimated distinct values over all ``sketches``, or for each ``by``."""
    union = F.coalesce(F.hll_sketch_estimate(F.hll_union_agg("sketch")), F.lit(0)).cast("long").alias("estimate")
    return sketches.groupBy(*by).agg(union) if by else sketches.agg(union)
