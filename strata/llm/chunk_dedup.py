"""Exact deduplication over content-defined chunk recipes (DataFrame functions only).

A text without its white space is cut where its content says so: after at least
``MIN_CHUNK`` characters, behind the next pair of characters from a fixed class. Equal
stretches of different documents so become equal chunks, wherever they lie. Each chunk
is replaced by an identifier, its 64-bit hash; the chunks themselves are shuffled once,
reduced to distinct ones before and after, to verify that no identifier stands for two
texts. Where one does, the texts get numbers and the recipes that hold it carry them.
Documents are then compared by their ordered identifier lists: a long document moves as
eight bytes a chunk, and equality is exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import ASCII_SPACES, materialise

MIN_CHUNK, MAX_CHUNK = 512, 4096
# Boundary characters: ASCII code points that are 5 modulo 8 (about one letter in five).
BOUNDARY = "".join(f"\\x{c:02x}" for c in range(0x25, 0x7F, 8))


def normalise(text: Column) -> Column:
    """Delete every character of ``[\\x20\\x09-\\x0D]``; null counts as empty."""
    out = F.coalesce(text, F.lit(""))
    for space in ASCII_SPACES:
        out = F.replace(out, F.lit(space), F.lit(""))
    return out


def chunks(normalised: Column, least: int = MIN_CHUNK, most: int = MAX_CHUNK) -> Column:
    """Content-defined chunks of a text, in order; their concatenation is the text."""
    pattern = f"(?s).{{{least},{most - 2}}}?[{BOUNDARY}]{{2}}|.{{1,{most}}}"
    return F.regexp_extract_all(normalised, F.lit(pattern), F.lit(0))


def decide(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
           identify=F.xxhash64, least: int = MIN_CHUNK, most: int = MAX_CHUNK) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256,
    n_code_points, n_chunks, uid.

    Texts are equal if they are after white space is deleted. Of equal texts the row of
    most code points (white space included) stays, then the one of the smallest id (null
    ids last); of repeated rows one stays. Null and empty texts, and those of white space
    only, are equal to each other. Texts of any length are cut whole. An empty table gives no row; other columns are
    ignored. ``identify`` maps a chunk to its identifier; any function will do, as
    identifiers are verified.
    """
    norm = normalise(F.col(f"`{text_col}`"))
    base = docs.select(F.col(f"`{id_col}`").alias("doc_id"),
                       F.length(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))).cast("long").alias("n_code_points"),
                       norm.alias("_norm"))
    cut = base.select("doc_id", "n_code_points", "_norm", chunks(F.col("_norm"), least, most).alias("_chunks"))
    # Verify: distinct (identifier, chunk) pairs; an identifier of several chunks is a clash.
    distinct = (cut.select(F.explode("_chunks").alias("chunk")).select(identify("chunk").alias("ident"), "chunk")
                .groupBy("ident", "chunk").agg(F.count("*").alias("uses")))
    shared = materialise(distinct.groupBy("ident").agg(F.count("*").alias("_n")).filter("_n > 1").select("ident"))
    slim = materialise(
        cut.select("doc_id", "n_code_points", F.sha2(F.col("_norm").cast("binary"), 256).alias("text_sha256"),
                   F.transform("_chunks", lambda c: identify(c)).alias("recipe"))
        .withColumn("uid", F.monotonically_increasing_id()))
    variants = F.lit("")
    if not shared.isEmpty():
        clash = distinct.join(shared, "ident").select("ident", "chunk", F.row_number().over(
            Window.partitionBy("ident").orderBy("chunk")).alias("variant"))
        # Number the clashing chunks of each document, in order; read the texts again only here.
        numbered = (cut.select(F.sha2(F.col("_norm").cast("binary"), 256).alias("text_sha256"),
                            F.posexplode("_chunks").alias("pos", "chunk"))
                    .join(clash, "chunk").filter(identify("chunk") == F.col("ident"))
                    .select("text_sha256", "pos", "variant").distinct()
                    .groupBy("text_sha256").agg(F.array_join(F.array_sort(F.collect_set(
                        F.format_string("%012d:%d", "pos", "variant"))), ",").alias("_variants")))
        slim = materialise(slim.join(numbered, "text_sha256", "left"))
        variants = F.coalesce(F.col("_variants"), F.lit(""))
    slim = slim.withColumn("variants", variants)
    first = F.min(F.struct((-F.col("n_code_points")).alias("c"), F.col("doc_id").isNull().alias("z"),
                           F.col("doc_id").alias("d"), F.col("uid").alias("u")))
    groups = slim.groupBy("recipe", "variants").agg(first.alias("_first"), F.count("*").alias("group_size"))
    return (slim.join(groups, ["recipe", "variants"])
            .select("doc_id", F.col("_first.d").alias("keep_id"), "group_size",
                    (F.col("uid") == F.col("_first.u")).alias("kept"), "text_sha256", "n_code_points",
                    F.size("recipe").alias("n_chunks"), "uid"))


def deduplicate(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns (one row of each group)."""
    kept = (decide(docs, id_col=id_col, text_col=text_col, **options).filter("kept")
            .select(F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_sha"), F.col("n_code_points").alias("_n")))
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
                        F.col(f"`{id_col}`").alias("_did"),
                        F.sha2(normalise(F.col(f"`{text_col}`")).cast("binary"), 256).alias("_dsha"),
                        F.length(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))).cast("long").alias("_dn"))
    same = (F.col("_dsha") == F.col("_sha")) & (F.col("_dn") == F.col("_n")) & F.col("_did").eqNullSafe(F.col("_id"))
    return (keyed.join(kept, same, "left_semi").dropDuplicates(["_dsha", "_dn", "_did"])
            .select(*[F.col(f"_row.`{c}`").alias(c) for c in docs.columns]))
