"""Sharding by proportional stratified interleaving.

Within each source the rows get a seeded random order and a rank; the fractional rank
``(rank + u_source) / rows_of_source`` spreads every source evenly over [0, 1), and
``u_source``, a seeded uniform number per source, spreads sources of one or two rows
too. All rows sorted by it and cut into equal runs give shards that each hold every
source in the mixture's proportion. Law ``rows``: shard sizes differ by one row at most.

No text is shuffled: a row is its id, size, checksum, source and two hashes. Ranks are
running sums over equal ranges of the hash, so a source holding most rows is spread
over all tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import bucket_count, materialise, unit_hash, with_prefix

SEED = 20240501
ROW_OVERHEAD = 16  # bytes a row takes beside its text, fixed by the size rule


def assign_shards(docs: DataFrame, shards: int = 40, *, id_col: str = "doc_id", text_col: str = "text",
                  source_col: str = "source", seed: int = SEED, per_bucket: int = 50_000) -> DataFrame:
    """One row per row of ``docs``: id, source, size, text_crc32, law, shard, slot, grown_shard.

    * null text: 0 bytes, checksum of the empty string; null source: a source of its own;
      null ids are allowed; repeated rows each get a place of their own (their order
      among themselves does not matter, as they are the same);
    * ``slot`` counts from 0 without a gap in each shard; shards beyond the number of
      rows stay empty; an empty table gives no row;
    * ``grown_shard`` is null: the law is ``rows``, not ``key``;
    * equal texts are not kept together: a group may be larger than a shard, and shards of
      equal numbers of rows would then have to split it;
    * texts of any length are read whole where they lie, ties of the hash go by id, then text;
    * other columns of ``docs`` are ignored, whatever their names.
    """
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    slim = materialise(
        docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"),
                    F.octet_length(text).cast("long").alias("_bytes"), F.crc32(text).alias("text_crc32"))
        .withColumn("size", F.col("_bytes") + ROW_OVERHEAD).drop("_bytes")
        .withColumn("_h", unit_hash(F.lit(seed), F.col("doc_id"), F.col("text_crc32"), F.col("size"))))
    total = slim.count()
    n = bucket_count(total, per_bucket)
    order = [F.col("_h"), F.col("doc_id"), F.col("text_crc32"), F.col("size")]
    ranked = with_prefix(slim.withColumn("_b", F.floor(F.col("_h") * n)), ["source"], "_b", order, None, "_rank")
    sizes = slim.groupBy("source").agg(F.count("*").alias("_n"),
                                       F.first(unit_hash(F.lit(seed + 1), F.col("source"))).alias("_u"))
    placed = materialise(
        ranked.join(sizes.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
        .withColumn("_f", (F.col("_rank") + F.col("_u")) / F.col("_n"))
        .withColumn("_b", F.least(F.floor(F.col("_f") * n), F.lit(n - 1)))
        .select("doc_id", "source", "size", "text_crc32", "_f", "_h", "_b"))
    cut = with_prefix(placed, [], "_b", [F.col("_f"), F.col("source"), F.col("_h"), F.col("doc_id"),
                                         F.col("text_crc32"), F.col("size")], None, "_pos")
    # Row p goes to shard floor(p * shards / total); that shard starts at ceil(shard * total / shards).
    return (cut.withColumn("shard", F.expr(f"cast((_pos * {shards}L) div {max(total, 1)}L as int)"))
            .withColumn("slot", F.expr(f"_pos - ((shard * {max(total, 1)}L + {shards - 1}L) div {shards}L)"))
            .select("doc_id", "source", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                    F.lit(None).cast("int").alias("grown_shard")))
