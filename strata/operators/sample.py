"""Reproducible sampling and segmentation.

``bounded_sample`` keeps exactly the ``n`` keys with the smallest
``md5(key || seed)``: the same rows on every run, partitioning and engine.
It finds the n-th smallest hash by refining a hash-prefix histogram — the
driver only ever sees the counts of one level's buckets — and then filters with
one predicate. No global sort, no single-task limit.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of the seeding budget: row size estimate, safety buffer, floor.
BYTES_PER_ROW = 120
SAFETY_BUFFER = 50 * 1024 * 1024
MIN_ROWS = 1000

HEX_PER_LEVEL = 4          # 16^4 = 65,536 buckets per refinement level at most
HEX_DIGITS = 32            # of an md5


def row_budget(quota_bytes: int, used_bytes: int, buffer_bytes: int = SAFETY_BUFFER,
               bytes_per_row: int = BYTES_PER_ROW, floor_rows: int = MIN_ROWS) -> int:
    """Rows that fit in the remaining storage; ``floor_rows`` when none do."""
    usable = quota_bytes - used_bytes - buffer_bytes
    return floor_rows if usable <= 0 else int(usable // bytes_per_row)


def distinct_users(raw: DataFrame) -> DataFrame:
    return raw.select("user_id").where(F.col("user_id").isNotNull()).distinct()


def sample_hash(key: str, seed: str):
    return F.md5(F.concat(F.col(key).cast("string"), F.lit(seed)))


def _cut(keyed: DataFrame, n: int) -> str | None:
    """The n-th smallest ``_h`` (None when there are at most n rows)."""
    prefix, need = "", n
    while True:
        scope = keyed.where(F.col("_h").startswith(prefix)) if prefix else keyed
        width = len(prefix) + HEX_PER_LEVEL
        counts = sorted((r[0], r[1]) for r in
                        scope.groupBy(F.substring("_h", 1, width).alias("b")).count().collect())
        total = sum(c for _, c in counts)
        if total < need:
            return None
        for bucket, c in counts:
            if c < need:
                need -= c
                continue
            prefix = bucket
            break
        if c == need:  # the whole bucket
            return prefix.ljust(HEX_DIGITS, "f")
        if width >= HEX_DIGITS:  # keys are distinct: the whole hash is reached
            return prefix


def bounded_sample(df: DataFrame, n: int, key: str, seed: str) -> DataFrame:
    """The ``n`` rows of ``df`` with the smallest ``md5(key || seed)``; all rows when
    there are at most ``n``, none when ``n`` is not positive. NULL keys are left out,
    and of rows of the same key one is used."""
    if n <= 0:
        return df.limit(0)
    keyed = (df.where(F.col(key).isNotNull()).dropDuplicates([key]).withColumn("_h", sample_hash(key, seed)))
    probe = keyed.select("_h").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        cut = _cut(probe, n)
    finally:
        probe.unpersist()
    out = keyed if cut is None else keyed.where(F.col("_h") <= F.lit(cut))
    return out.drop("_h")
