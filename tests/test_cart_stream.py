"""Cart abandonment as an outer stream-stream join; counted late rows and duplicates."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata import catalog
from strata.operators import tables
from strata.plans import daily, gold, serving, silver
from strata.sources import bronze as bronze_src
from strata.streaming import cart_stream, silver_stream

SF = "/root/testdata/sf0.001"
SCHEMA = T.StructType([T.StructField("event_id", T.LongType()), *bronze_src.staged_schema().fields])
CRM = "user_id int, loyalty_tier string, signup_date date, acquisition_channel string"


def events(spark, rows):
    """Raw events from (id, day of January 2024, hour, type, product, session)."""
    made = []
    for i, day, hour, kind, product, session in rows:
        t = dt.datetime(2024, 1, 1) + dt.timedelta(days=day - 1, hours=hour)
        made.append((i, t.strftime("%Y-%m-%d %H:%M:%S UTC"), kind, product, "1", "a.b", "x", 1.0, 5, session, *t.strftime("%Y %m %d").split()))
    return spark.createDataFrame(made, SCHEMA)


def land(spark, path, *drops):
    for drop in drops:
        drop.coalesce(1).write.mode("append").partitionBy(*bronze_src.PARTS).parquet(path)


def run(spark, P, crm, **options):
    return cart_stream.stream_cart_abandonment(spark, P.bronze, P.fact, crm, SCHEMA, P.ckpt, timeout_s=600, **options)


def batch_fact(raw, crm):
    fact = gold.fact_cart_abandonment(serving.serving(silver.silver(raw.drop(*bronze_src.PARTS), crm)))
    return sorted(tuple(r) for r in fact.collect())


def stored(spark, P):
    if not tables.table_exists(spark, P.fact):
        return []
    return sorted(tuple(r) for r in cart_stream.read_stream_fact(spark, P.fact).collect())


@pytest.fixture()
def crm(spark):
    return spark.createDataFrame([(5, "VIP", dt.date(2020, 1, 1), "Google")], CRM)


def test_files_in_any_order_within_the_watermark_equal_the_batch_fact(spark, workdir):
    L = catalog.Layers(spark, SF)
    P = daily.Paths(workdir)
    bronze_src.stage_by_day(L.raw.withColumn("file_year", F.lit("2024")), P.staging)
    schema = bronze_src.staged_schema(L.raw.schema)
    staged = spark.read.schema(schema).parquet(P.staging)
    staged.repartition(3, F.xxhash64("event_id")).write.partitionBy(*bronze_src.PARTS).parquet(P.bronze)
    closing = cart_stream.closing_events(spark, schema, dt.datetime(2024, 1, 31), delay="31 days")
    closing.write.mode("append").partitionBy(*bronze_src.PARTS).parquet(P.bronze)
    got = cart_stream.stream_cart_abandonment(spark, P.bronze, P.fact, L.crm, schema, P.ckpt, delay="31 days",
                                              max_files_per_trigger=30, timeout_s=600)
    assert got["late"] == 0 and got["undecided"] <= 2
    want = sorted(tuple(r) for r in L.fact_carts.collect())
    assert len(want) > 50 and stored(spark, P) == want


def test_a_cart_is_decided_once_its_time_is_over(spark, workdir, crm):
    P = daily.Paths(workdir)
    options = {"delay": "1 day", "horizon": "3 days"}
    first = [(1, 1, 0, "cart", 1, "s"), (2, 1, 1, "cart", 2, "s"), (3, 1, 2, "cart", 3, None), (4, 2, 0, "purchase", 2, "s"),
             (5, 2, 1, "cart", 4, "s"), (5, 2, 1, "cart", 4, "s"), (6, 2, 2, "purchase", 3, None)]
    land(spark, P.bronze, events(spark, first))
    assert run(spark, P, crm, **options)["undecided"] == 6 and stored(spark, P) == []  # a purchase without a session isn't held
    # the purchase of cart 1 comes before its cart's time is over; day 7 moves the watermark past carts 1 to 3
    second = [(7, 3, 23, "purchase", 1, "s"), (8, 7, 0, "cart", 9, "t"), (9, 7, 0, "purchase", 8, "t")]
    land(spark, P.bronze, events(spark, second))
    run(spark, P, crm, **options)
    products = sorted(r[3] for r in stored(spark, P))
    assert products == [3, 4]
    # rows of day 1 are late now: counted, and no cart or purchase of them counts
    land(spark, P.bronze, events(spark, [(10, 1, 5, "cart", 6, "s"), (11, 1, 6, "purchase", 4, "s"), (12, 7, 1, "purchase", 9, "t")]))
    assert run(spark, P, crm, **options)["late"] == 2
    land(spark, P.bronze, cart_stream.closing_events(spark, SCHEMA, dt.datetime(2024, 1, 8), **options))
    run(spark, P, crm, **options)
    assert sorted(r[3] for r in stored(spark, P)) == [3, 4]
    assert run(spark, P, crm, **options) == {"late": 0, "undecided": 0}


def test_the_fact_equals_the_batch_fact_of_small_cases(spark, workdir, crm):
    P = daily.Paths(workdir)
    rows = [(1, 1, 0, "cart", 1, None), (2, 1, 0, "cart", 1, None), (3, 1, 0, "cart", 1, "s"), (4, 2, 0, "cart", 1, "s"),
            (5, 3, 0, "purchase", 1, "t"), (6, 3, 1, "cart", 1, "t"), (7, 3, 1, "view", 2, "t"), (8, 4, 0, "cart", 2, "u"),
            (9, 4, 0, "cart", None, "u"), (10, 5, 0, "purchase", 2, "u"), (11, 5, 0, "purchase", 2, "u"), (12, 5, 1, "cart", 7, "u")]
    drops = [events(spark, rows[k::3]) for k in range(3)]
    land(spark, P.bronze, *drops)
    land(spark, P.bronze, cart_stream.closing_events(spark, SCHEMA, dt.datetime(2024, 1, 6), delay="10 days"))
    assert run(spark, P, crm, delay="10 days", max_files_per_trigger=2)["late"] == 0
    assert stored(spark, P) == batch_fact(events(spark, rows), crm)


def test_bounded_dedup_accounts_for_every_row(spark, workdir):
    P = daily.Paths(workdir)
    days = [(i, 1 + i % 6, i % 24, "view", i, "s") for i in range(60)]
    land(spark, P.bronze, events(spark, days), events(spark, days[:7]))
    got = silver_stream.stream_dedup_watermark(spark, P.bronze, P.out, SCHEMA, P.ckpt, delay="1 day", timeout_s=600)
    assert got == {"written": 60, "late": 0, "duplicates": 7}
    again = events(spark, days)
    land(spark, P.bronze, again)
    more = silver_stream.stream_dedup_watermark(spark, P.bronze, P.out, SCHEMA, P.ckpt, delay="1 day", timeout_s=600)
    assert more["written"] == 0 and more["late"] > 0 and more["duplicates"] > 0 and sum(more.values()) == 60
    assert tables.read_table(spark, P.out).count() == 60
