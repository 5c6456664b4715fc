"""Corpus pipeline: documents to packed training sequences.

quality classifier -> exact dedup -> MinHash near-dedup -> mixing -> best-fit packing.
Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept and
returns rows with the columns of ``documents`` (the last one: packed pieces). Between
stages the rows are written as Parquet to the shared folder and read again.

In all stages: a null text counts as an empty one; texts of any length are read whole; null
and repeated ids are rows like others, decided by their own text; an empty table gives an
empty one; columns beside ``doc_id``, ``text`` and ``source``, of any name, are carried along and
decide nothing (the last stage returns its own columns).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import bestfit_packing, chunk_dedup, lowdisc_mix, minhash_bayes, quality_qda
from strata.llm.common import crc_mod, table
from strata.llm.queries import prepare, tokenizer_path
from strata.session import work_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the rows whose text the classifier does not reject (a score of one half stays). It
    learns from the labels that the operator's query learns from; without any all rows stay.
    Empty texts are scored as texts of no words; repeated rows go or stay together."""
    prepare(spark)
    return quality_qda.accepted(docs, table(spark, sf_dir, "labels"), learn=crc_mod(F.col("doc_id"), 3) != 1)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each group of texts equal but for white space: the longest, of those the one
    of the smallest id (null last), of repeated rows one. Empty texts are one group."""
    prepare(spark)
    return chunk_dedup.deduplicate(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near-duplicates (five words, similarity 0.8): the one of
    the smallest id (null last), ties by the text's hash, of repeated rows one. Texts without words all stay."""
    prepare(spark)
    return minhash_bayes.deduplicate(docs, shingle_words=5, threshold_percent=80)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row for each time a document is taken; the last taking may be a part of it. A null
    source is a source; texts without words are never taken."""
    prepare(spark)
    mixed = lowdisc_mix.mixed_documents(docs)
    return mixed.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else mixed


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack all rows into sequences of 4096 tokens: packed pieces, each row packed once; pieces of
    equal length in any order."""
    prepare(spark)
    return bestfit_packing.pack_documents(docs, tokenizer_path())


STAGES = [
    ("quality classifier", quality),
    ("exact dedup", exact_dedup),
    ("MinHash near-dedup", near_dedup),
    ("mixing sources", mixing),
    ("best-fit packing", packing),
]

#: The classifier, the schedule and the tokenizer are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the packed pieces."""
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        path = work_path(spark, f"pipeline-{number}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
