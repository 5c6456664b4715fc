"""Sampling exactness and data-quality checks."""

import hashlib

import pytest
from pyspark.sql import functions as F

from strata.operators import quality, sample


def test_row_budget():
    mb = 1024 * 1024
    assert sample.row_budget(512 * mb, 100 * mb) == (362 * mb) // 120
    assert sample.row_budget(512 * mb, 500 * mb) == 1000


@pytest.mark.parametrize("n", [1, 37, 500, 2000])
def test_bounded_sample_is_exact_smallest_hashes(spark, monkeypatch, n):
    monkeypatch.setattr(sample, "HEX_PER_LEVEL", 1)   # several refinement levels
    df = spark.range(1000).select(F.col("id").cast("int").alias("user_id"))
    got = sorted(r.user_id for r in sample.bounded_sample(df, n, "user_id", "s").collect())
    want = sorted(sorted(range(1000), key=lambda i: hashlib.md5(f"{i}s".encode()).hexdigest())[:n])
    assert got == want


def test_bounded_sample_edges(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (2, "d")], "k int, v string")
    assert sample.bounded_sample(df, 0, "k", "s").count() == 0
    assert sample.bounded_sample(df, -3, "k", "s").count() == 0
    assert sorted(r.k for r in sample.bounded_sample(df, 10, "k", "s").collect()) == [1, 2]
    assert sample.bounded_sample(df, 1, "k", "s").count() == 1


def test_weighted_bucket_proportions(spark):
    from strata.functions.buckets import hash_fraction, weighted_bucket
    df = spark.range(20000).select(weighted_bucket("id", ["a", "b"], [0.25, 0.75], "x").alias("l"),
                                   hash_fraction("id", "x").alias("u"))
    share = df.where("l = 'a'").count() / 20000
    assert 0.23 < share < 0.27
    r = df.agg(F.min("u"), F.max("u")).first()
    assert 0.0 <= r[0] and r[1] < 1.0


def test_quality_checks_and_gate(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (2, "b"), (None, "c")], "k int, v string")
    nn = {r.column: r.failures for r in quality.not_null(df, "t", ["k", "v"]).collect()}
    assert nn == {"k": 1, "v": 1}
    assert quality.unique(df, "t", "k").first().failures == 1
    parent = spark.createDataFrame([(1,)], "k int")
    assert quality.relationships(df, "t", "k", parent, "k", "p").first().failures == 1
    report = quality.union_all([quality.unique(df, "t", "k")])
    with pytest.raises(AssertionError):
        quality.enforce(report)
    quality.enforce(quality.unique(parent, "p", "k"))


def test_dq_report_passes_on_fixture(spark):
    from strata import catalog
    report = catalog.QUERIES["dq_report"](spark, "/root/testdata/sf0.001")
    rows = report.collect()
    assert len(rows) == 20
    quality.enforce(report)
