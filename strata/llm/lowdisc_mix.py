"""Mixing sources to target weights with a low-discrepancy source schedule.

1. *Targets.* Source weights share the words of all sources; a target stops at
   ``max_epochs`` times its source's words and the excess is shared again by weight.
2. *Blocks.* Each source's documents, in a seeded random order, form one line of words
   that is cut into equal blocks.
3. *Schedule.* Slot ``i`` of the mix takes the point ``i * golden ratio mod 1``; the
   points are mapped through the cumulative shares of the sources. Any run of slots
   therefore holds each source in its proportion, within a few blocks.
4. *Join.* The k-th slot of a source takes its block ``k mod blocks``.

All ranks are running sums over ranges of the slot number or of the order hash, so a
source holding most rows or slots is never gathered. No text is shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import WORD, bucket_count, materialise, range_rank, unit_hash, with_prefix

SEED = 20240502
WEIGHT_CYCLE = (1.0, 2.0, 3.0)
# The golden-ratio step as a fraction of 2^31: products with a slot number below 2^31
# stay below 2^62. Later slots repeat the same points, which are evenly spread.
GOLDEN_BITS = 31
GOLDEN_STEP = 1_327_217_885  # round(0.6180339887498949 * 2^31), odd


@dataclass
class Mix:
    """What the operator makes. ``sources``: key, source, weight, source_size, target,
    blocks, block_words. ``docs``: key, doc_id, uid, size, start (place in the source's
    line). ``schedule``: slot, key, rank, block. ``spans``: key, block, takes, uid,
    doc_id, begin, finish (words of the document in that block)."""

    sources: DataFrame
    docs: DataFrame
    schedule: DataFrame
    spans: DataFrame

    def taken(self) -> DataFrame:
        """Per document: doc_id, uid, size, source_size, target, taken (repeats counted)."""
        got = self.spans.groupBy("uid").agg(F.sum(F.col("takes") * (F.col("finish") - F.col("begin"))).alias("taken"))
        per_source = self.sources.select("key", "source", "source_size", "target")
        return (self.docs.join(got, "uid", "left").join(per_source, "key")
                .select("doc_id", "uid", "source", "size", "source_size", "target",
                        F.coalesce("taken", F.lit(0)).cast("long").alias("taken")))


def source_targets(sources: DataFrame, cycle=WEIGHT_CYCLE, max_epochs: float = 3.0) -> DataFrame:
    """Add ``weight`` and ``target`` to ``sources(key, source, source_size)``.

    Each round shares what is left by weight and closes the sources that reach their
    limit; only three sums come to the driver. Rounds end when none closes."""
    partitions = int(sources.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranked = range_rank(sources, [F.col("source").isNull(), F.col("source")], "_r", partitions)
    weights = F.array(*[F.lit(float(w)) for w in cycle])
    ranked = materialise(ranked.withColumn("weight", F.element_at(weights, (F.col("_r") % len(cycle) + 1).cast("int"))).drop("_r"))
    limit = F.col("source_size") * F.lit(float(max_epochs))
    total = ranked.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    level, closed = 0.0, -1
    while True:
        full = limit <= F.col("weight") * F.lit(level) if closed >= 0 else F.lit(False)
        n, used, open_weight = ranked.agg(
            F.coalesce(F.sum(F.when(full, 1).otherwise(0)), F.lit(0)),
            F.coalesce(F.sum(F.when(full, limit)), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0.0))).first()
        if n == closed:
            break
        closed, level = n, (max(0.0, total - used) / open_weight if open_weight else level)
    return ranked.withColumn("target", F.least(limit, F.col("weight") * F.lit(level)))


def mix_sources(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                cycle=WEIGHT_CYCLE, max_epochs: int = 3, block_words: int = 1024,
                least_blocks: int = 256, seed: int = SEED, per_bucket: int = 50_000) -> Mix:
    """Plan the mix of ``docs``. A block has ``block_words`` words, fewer in a source of
    under ``least_blocks`` such blocks (so that small sources come near their targets too).

    * a document's size is its number of words; null and empty texts have none and are
      never taken; a null source is a source of its own, last in the order;
    * no block is taken more than ``max_epochs`` times, so no document is either;
    * repeated rows are documents of their own; an empty table gives empty tables;
    * texts of any length are counted whole where they lie; a document longer than a block lies in several;
    * other columns of ``docs`` are ignored, whatever their names.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    slim = (docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"),
                        F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"), F.xxhash64(text).alias("_t"))
            .withColumn("key", F.coalesce(F.concat(F.lit("="), "source"), F.lit("null")))
            .withColumn("uid", F.monotonically_increasing_id())
            .withColumn("_h", unit_hash(F.lit(seed), F.col("doc_id"), F.col("_t"))))
    slim = materialise(slim)
    rows = slim.count()
    sizes = slim.groupBy("key", "source").agg(F.sum("size").alias("source_size"))
    sources = source_targets(sizes, cycle, max_epochs)
    sources = materialise(
        sources.withColumn("blocks", F.greatest(F.ceil(F.col("source_size") / block_words),
                                                F.least(F.col("source_size"), F.lit(least_blocks))).cast("long"))
        .withColumn("block_words", F.col("source_size") / F.greatest("blocks", F.lit(1)))
        .withColumn("_slots", F.when(F.col("blocks") > 0, F.col("target") / F.col("block_words")).otherwise(0.0)))

    # The documents' places in their source's line, and the blocks they touch.
    n = bucket_count(rows, per_bucket)
    lined = with_prefix(slim.withColumn("_b", F.floor(F.col("_h") * n)), ["key"], "_b",
                        [F.col("_h"), F.col("doc_id"), F.col("_t"), F.col("size"), F.col("uid")], F.col("size"), "start")
    placed = materialise(lined.select("key", "doc_id", "uid", "size", "start", F.col("_t").alias("text_hash")))

    # The schedule: cumulative shares in source order, found by cells of the unit interval.
    slots = int(round(sources.agg(F.coalesce(F.sum("_slots"), F.lit(0.0))).first()[0]))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Shares as whole numbers of 2^-31, running sum over sources in order: exact and distributed.
    unit = 1 << GOLDEN_BITS
    shared = range_rank(sources.filter("_slots > 0").select("key", "_slots"), [F.col("key")], "_r", parts)
    per = max(1, -(-sources.count() // 64))
    shared = materialise(shared.withColumn("_b", F.floor(F.col("_r") / per))
                         .withColumn("_w", F.round(F.col("_slots") * F.lit(unit / max(slots, 1))).cast("long")))
    shared = with_prefix(shared, [], "_b", [F.col("_r")], F.col("_w"), "_lo")
    cells = max(64, 4 * per * 64)
    width = -(-unit // cells)
    last = F.lit((unit - 1) // width)
    lookup = (shared.select("key", "_lo", (F.col("_lo") + F.col("_w")).alias("_hi")).filter("_hi > _lo")
              .withColumn("_cell", F.explode(F.sequence(F.least(F.floor(F.col("_lo") / width), last),
                                                        F.least(F.floor((F.col("_hi") - 1) / width), last)))))
    points = (spark.range(slots).withColumnRenamed("id", "slot")
              .withColumn("_p", F.expr(f"((slot % {unit}L) * {GOLDEN_STEP}L) % {unit}L"))
              .withColumn("_cell", F.floor(F.col("_p") / width)))
    chosen = (points.join(lookup, "_cell").filter("_p >= _lo and _p < _hi")
              .select("slot", "key", F.floor(F.col("slot") / per_bucket).alias("_b")))
    chosen = materialise(chosen)
    ranked = with_prefix(chosen, ["key"], "_b", [F.col("slot")], None, "rank")
    schedule = (ranked.join(sources.select("key", "blocks"), "key")
                .filter(F.col("rank") < F.col("blocks") * max_epochs)
                .select("slot", "key", "rank", (F.col("rank") % F.col("blocks")).alias("block")))

    takes = schedule.groupBy("key", "block").agg(F.count("*").alias("takes"))
    # Block b of a source covers words [floor(b * w), floor((b + 1) * w)) of its line.
    edge = "cast(({b} * cast(source_size as decimal(38,0))) div blocks as bigint)"
    spans = (placed.filter("size > 0").join(sources.select("key", "blocks", "source_size"), "key")
             .withColumn("_first", F.expr("cast((start * cast(blocks as decimal(38,0))) div source_size as bigint)"))
             .withColumn("_last", F.expr("cast(((start + size) * cast(blocks as decimal(38,0))) div source_size as bigint)"))
             .withColumn("block", F.explode(F.sequence("_first", F.least("_last", F.col("blocks") - 1))))
             .withColumn("_x", F.expr(edge.format(b="block"))).withColumn("_y", F.expr(edge.format(b="(block + 1)")))
             .withColumn("begin", F.greatest(F.col("_x") - F.col("start"), F.lit(0)))
             .withColumn("finish", F.least(F.col("_y") - F.col("start"), F.col("size")))
             .filter("finish > begin")
             .join(takes, ["key", "block"])
             .select("key", "block", "takes", "uid", "doc_id", "begin", "finish"))
    return Mix(sources, placed, schedule, spans)


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix as rows of documents: every column of ``docs``, one row for each time a
    document is taken, its text cut to the words taken.

    A source's line is taken whole some times and once more up to a point, so the t-th
    taking of a document is a prefix of it; only the document at that point is cut (after
    a word; white space inside is kept). Documents of no words are not in the mix. Rows
    equal in id, source and text share one row's other columns."""
    id_col, text_col = options.get("id_col", "doc_id"), options.get("text_col", "text")
    source_col = options.get("source_col", "source")
    mix = mix_sources(docs, **options)
    runs = (mix.spans.withColumn("_t", F.explode(F.sequence(F.lit(1), F.col("takes").cast("int"))))
            .groupBy("uid", "_t").agg(F.max("finish").alias("_to")))
    runs = runs.join(mix.docs.select("uid", F.col("doc_id").alias("_id"), F.col("key").alias("_key"),
                                     F.col("text_hash").alias("_th"), F.col("size").alias("_size")), "uid")
    text = F.col(f"`{text_col}`")
    keyed = (docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
                         F.col(f"`{id_col}`").alias("_did"),
                         F.coalesce(F.concat(F.lit("="), F.col(f"`{source_col}`").cast("string")), F.lit("null")).alias("_dkey"),
                         F.xxhash64(F.coalesce(text, F.lit(""))).alias("_dth"))
             .dropDuplicates(["_did", "_dkey", "_dth"]))
    joined = keyed.join(runs, F.col("_did").eqNullSafe(F.col("_id")) & (F.col("_dkey") == F.col("_key"))
                        & (F.col("_dth") == F.col("_th")))
    words = F.regexp_extract_all(F.col(f"_row.`{text_col}`"), F.lit(r"[\x20\x09-\x0D]*" + WORD), F.lit(0))
    cut = F.when(F.col("_to") >= F.col("_size"), F.col(f"_row.`{text_col}`")).otherwise(
        F.array_join(F.slice(words, F.lit(1), F.col("_to").cast("int")), ""))
    return joined.select(*[cut.alias(c) if c == text_col else F.col(f"_row.`{c}`").alias(c) for c in docs.columns])
