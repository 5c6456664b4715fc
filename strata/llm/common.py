"""Shared helpers: materialisation in the shared folder, distributed ranks, components."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.session import checkpoint_dir

# Code points of `[\x20\x09-\x0D]`: the white space every contract here speaks of.
ASCII_SPACES = (" ", "\t", "\n", "\x0b", "\x0c", "\r")
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
WORD = r"[^\x20\x09-\x0D]+"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """What runs inside drops its shuffle files when it ends, not when the driver collects garbage."""
    before = spark.conf.get(DROP_SHUFFLES, "false")
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(DROP_SHUFFLES, before)


def materialise(df: DataFrame, drop_shuffles: bool = False) -> DataFrame:
    """Write ``df`` once to the session's shared checkpoint folder and cut its lineage.

    Used where a table is read by several jobs, or where ids assigned per partition
    must stay the same; a lost executor re-reads the files. With ``drop_shuffles`` the
    shuffle files of the write go as it ends: for steps that follow on each other."""
    checkpoint_dir(df.sparkSession)
    if not drop_shuffles:
        return df.checkpoint(eager=True)
    with shuffles_dropped(df.sparkSession):
        return df.select("*").checkpoint(eager=True)  # the setting is read where a query is made


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_mod(column: Column, n: int) -> Column:
    """crc32 of the id as text, modulo ``n`` (null id: the text is empty)."""
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % F.lit(n)


def unit_hash(*columns: Column, bits: int = 40) -> Column:
    """A seeded uniform double in [0, 1) from the columns' hash (``bits`` significant bits)."""
    return F.shiftrightunsigned(F.xxhash64(*columns), 64 - bits) / F.lit(float(1 << bits))


def bucket_count(rows: int, per_bucket: int = 50_000, at_least: int = 64) -> int:
    """Number of equal hash ranges so that one holds about ``per_bucket`` rows."""
    return max(at_least, -(-rows // per_bucket))


def with_prefix(df: DataFrame, group: list[str], bucket: str, order: list[Column],
                value: Column | None, out: str) -> DataFrame:
    """Running sum of ``value`` (exclusive; a rank from 0 without it) over ``group``,
    ordered by (``bucket``, ``order``), without gathering a group in one task.

    Rows are summed per (group, bucket); a running sum over those few sums gives each
    bucket its start, a window inside (group, bucket) gives the rest. Buckets must be
    ranges of the leading order value, so a large group is spread over all of them.
    Null group values form a group of their own. ``df`` is read twice: materialise it."""
    v = F.lit(1).cast("long") if value is None else value.cast("long")
    keys = [F.coalesce(F.col(g).cast("string"), F.lit("\x00")).alias(f"_g{i}") for i, g in enumerate(group)]
    names = [f"_g{i}" for i in range(len(group))]
    marked = df.select("*", *keys, v.alias("_v"))
    sums = marked.groupBy(*names, bucket).agg(F.sum("_v").alias("_s"))
    before = Window.partitionBy(*names).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(*names, bucket, F.coalesce(F.sum("_s").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy(*names, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (marked.withColumn("_in", F.coalesce(F.sum("_v").over(inside), F.lit(0)))
            .join(starts, [*names, bucket])
            .withColumn(out, F.col("_start") + F.col("_in"))
            .drop(*names, "_v", "_in", "_start"))


def range_rank(df: DataFrame, order: list[Column], out: str, partitions: int) -> DataFrame:
    """Global rank from 0 by ``order``: range partitions, sorted, plus each partition's
    start (one number per partition travels to the other tasks). Materialises ``df``."""
    placed = materialise(df.repartitionByRange(partitions, *order).sortWithinPartitions(*order)
                         .withColumn("_pid", F.spark_partition_id())
                         .withColumn("_at", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))))
    counts = placed.groupBy("_pid").agg(F.count("*").alias("_n"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    starts = counts.select("_pid", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_start"))
    return (placed.join(F.broadcast(starts), "_pid")
            .withColumn(out, F.col("_start") + F.col("_at")).drop("_pid", "_at", "_start"))


def connected_components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links(a, b)``; root is the smallest node reachable.

    Alternating large-star and small-star steps: each only takes a neighbourhood's
    minimum (combined before the shuffle) and joins it back, so a node with very many
    neighbours is never gathered; rounds grow with the logarithm of the longest chain."""
    parts = int(links.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # unions would add theirs up
    edges = materialise(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                        .filter("u <> v").distinct(), drop_shuffles=True)
    while True:
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").select("v", "m").filter("v <> m")
                 .select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        edges = materialise(small.coalesce(parts), drop_shuffles=True)
        # Done when all edges lead to a root at once: no node has an edge of its own and is another's end.
        ends = (edges.select(F.col("u").alias("node"), F.lit(1).alias("own"), F.lit(0).alias("end"))
                .unionByName(edges.select("v", F.lit(0), F.lit(1)).toDF("node", "own", "end")))
        twice = ends.groupBy("node").agg(F.sum("own").alias("own"), F.max("end").alias("end"))
        with shuffles_dropped(links.sparkSession):
            done = twice.filter("own > 1 or (own > 0 and end > 0)").isEmpty()
        if done:
            break
    return (edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
            .unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct())
