"""Storage operators: upsert idempotence, NULL-safe keys, partition replace,
insert-if-absent, lookback."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from strata.operators import tables

SCHEMA = "k string, t int, v string, d date"
D1, D2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)


def rows(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def snapshot(spark, path):
    return sorted((r.k or "", r.t, r.v, r.d) for r in tables.read_table(spark, path).collect())


def test_upsert_replaces_matches_inserts_new_and_is_idempotent(spark, workdir):
    p = workdir + "/t"
    tables.upsert(spark, p, rows(spark, [("a", 1, "old", D1), (None, 2, "old", D1), ("b", 3, "keep", D2)]),
                  ["k", "t"], "d")
    src = rows(spark, [("a", 1, "new", D1), (None, 2, "new", D1), ("c", 4, "ins", D1)])
    tables.upsert(spark, p, src, ["k", "t"], "d")
    once = snapshot(spark, p)
    tables.upsert(spark, p, src, ["k", "t"], "d")
    assert snapshot(spark, p) == once
    assert once == [("", 2, "new", D1), ("a", 1, "new", D1), ("b", 3, "keep", D2), ("c", 4, "ins", D1)]


def test_upsert_keeps_other_rows_of_the_null_partition(spark, workdir):
    p = workdir + "/n"
    tables.upsert(spark, p, rows(spark, [("a", 1, "old", None), ("b", 2, "old", None)]), ["k", "t"], "d")
    tables.upsert(spark, p, rows(spark, [("z", 9, "new", None), ("a", 1, "new", None)]), ["k", "t"], "d")
    assert snapshot(spark, p) == [("a", 1, "new", None), ("b", 2, "old", None), ("z", 9, "new", None)]


def test_merge_distinct_in_any_order(spark, workdir):
    loads = [[("a", 5, "x", D1), ("b", 1, "x", D2)], [("a", 3, "y", D1), ("c", 1, "y", None)], [("a", 9, "z", D1)]]
    want = [("a", 3, "y", D1), ("b", 1, "x", D2), ("c", 1, "y", None)]
    for i, order in enumerate(([0, 1, 2], [2, 0, 1, 1], [1, 2, 0])):
        p = f"{workdir}/m{i}"
        for k in order:
            tables.merge_distinct(spark, p, rows(spark, loads[k]), ["k"], "d", order_by=["t"])
        assert snapshot(spark, p) == want


def test_replace_partitions_clears_empty_owned_day(spark, workdir):
    p = workdir + "/s"
    tables.replace_partitions(spark, p, rows(spark, [("a", 1, "x", D1), ("b", 2, "y", D2)]), "d")
    tables.replace_partitions(spark, p, rows(spark, [("c", 3, "z", D2)]), "d", owned=[D2])
    assert snapshot(spark, p) == [("a", 1, "x", D1), ("c", 3, "z", D2)]
    counts = tables.replace_partitions(spark, p, rows(spark, []), "d", owned=[D1])
    assert counts == {str(D1): 0}
    assert snapshot(spark, p) == [("c", 3, "z", D2)]


def test_insert_absent_never_overwrites(spark, workdir):
    p = workdir + "/crm"
    tables.insert_absent(spark, p, spark.createDataFrame([(1, "VIP")], "user_id int, tier string"), "user_id")
    src = spark.createDataFrame([(1, "Regular"), (2, "Gold"), (2, "Silver"), (None, "x")], "user_id int, tier string")
    tables.insert_absent(spark, p, src, "user_id", order_by=["tier"])
    got = sorted(tuple(r) for r in tables.read_table(spark, p).collect())
    assert got == [(1, "VIP"), (2, "Gold")]


def test_lookback_bound_and_window(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 10, 12),), (dt.datetime(2024, 1, 8, 12),),
                                (dt.datetime(2024, 1, 8, 11, 59, 59),)], "t timestamp")
    b = tables.lookback_bound(df, "t", 2)
    assert b.startswith("2024-01-08 12:00:00")
    assert tables.within_lookback(df, "t", b).count() == 2
    assert tables.lookback_bound(df.where("false"), "t", 2) is None
    assert tables.within_lookback(df, "t", None).count() == 3


def test_publish_day_requires_files(spark, workdir):
    from strata.sources import bronze
    with pytest.raises(FileNotFoundError):
        bronze.publish_day(spark, workdir + "/nostage", workdir + "/bronze", "2024-01-01")


def test_csv_scan_takes_year_from_file_name(spark, workdir):
    from strata.sources import csv as csv_src
    df = spark.createDataFrame([("2020-02-01 00:00:00 UTC", "view", 1, "c", "a.b", "x", 1.5, 7, "s")],
                               "event_time string, event_type string, product_id int, category_id string, "
                               "category_code string, brand string, price double, user_id int, user_session string")
    csv_src.write_csv(df.withColumn("period", F.lit("2019-Oct")), workdir + "/landing", "period")
    got = csv_src.scan_csv(spark, workdir + "/landing").first()
    assert got.file_year == "2019" and got.price == 1.5 and got.user_id == 7
    from strata.sources.bronze import stage_by_day, staged
    assert staged(csv_src.scan_csv(spark, workdir + "/landing")).count() == 0
    assert csv_src.file_year("/x/2021-Jan-7.csv.gz") == "2021" and csv_src.file_year("/x/events.csv", "1999") == "1999"
    assert csv_src.file_year("/x/period=undated/part-00001-20234.csv.gz") == csv_src.DEFAULT_FILE_YEAR
    # rows that are not staged are counted; staging again leaves nothing of the first
    two = df.unionByName(df.withColumn("event_time", F.lit("2019-03-01 00:00:00 UTC"))).withColumn("file_year", F.lit("2019"))
    assert stage_by_day(two, workdir + "/st") == {"read": 2, "staged": 1}
    assert stage_by_day(two.withColumn("file_year", F.lit("2020")), workdir + "/st") == {"read": 2, "staged": 1}
    from strata.sources.bronze import staged_days
    assert staged_days(spark, workdir + "/st") == ["2020-02-01"]


def test_partitioned_lookback_reads_newest_partition(spark, workdir):
    p = workdir + "/f"
    df = spark.createDataFrame([(dt.datetime(2024, 1, 3, 5),), (dt.datetime(2024, 1, 9, 23, 30),),
                                (dt.datetime(2024, 1, 9, 1),)], "t timestamp").selectExpr("t", "to_date(t) AS d")
    tables.write_table(df, p, "d")
    assert tables.partitioned_lookback_bound(spark, p, "t", "d", 2) == tables.lookback_bound(df, "t", 2)
    assert tables.partitioned_lookback_bound(spark, p, "t", "d", 2).startswith("2024-01-07 23:30:00")
    assert tables.partitioned_lookback_bound(spark, workdir + "/missing", "t", "d", 2) is None


def test_stage_local_sort_equals_rebalance(spark, workdir):
    from pyspark.sql import functions as F
    from strata import catalog
    from strata.sources import bronze
    L = catalog.Layers(spark, "/root/testdata/sf0.001")
    rows = L.raw.withColumn("file_year", F.lit("2024"))
    bronze.stage_by_day(rows, workdir + "/a")
    bronze.stage_by_day(rows, workdir + "/b", local_sort=True)
    schema = bronze.staged_schema(L.raw.schema)
    a = sorted(tuple(r) for r in spark.read.schema(schema).parquet(workdir + "/a").collect())
    b = sorted(tuple(r) for r in spark.read.schema(schema).parquet(workdir + "/b").collect())
    assert a == b and len(a) == rows.where("event_time <> 'not-a-time'").count()


def test_incremental_fact_after_an_empty_first_load(spark, workdir):
    from strata import catalog
    from strata.plans import daily, gold
    L = catalog.Layers(spark, "/root/testdata/sf0.001")
    path = workdir + "/sales"
    daily.fact_sales_incremental(spark, path, L.serving.where("false"))
    assert daily.read_fact(spark, path, "sale_date").count() == 0
    daily.fact_sales_incremental(spark, path, L.serving)
    assert daily.read_fact(spark, path, "sale_date").count() == gold.fact_sales(L.serving).count()
