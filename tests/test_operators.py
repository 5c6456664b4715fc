"""Operator semantics on tiny literal frames: NULL keys, ties, one-level
categories, bad timestamps, NULL parts in keys, skewed groups."""

import datetime as dt

from pyspark.sql import functions as F

from strata.functions.keys import hash_key, key_text
from strata.functions.parse import category_level, parse_event_time
from strata.operators import ordinal as ordinal_mod
from strata.operators.clean import clean, dedup, parse, quarantine
from strata.operators.enrich import enrich
from strata.operators.joins import anti_join
from strata.schemas import RAW_CLICKSTREAM, conform


def raw(spark, rows):
    return spark.createDataFrame(rows, RAW_CLICKSTREAM)


def test_parse_bad_and_good_times(spark):
    df = spark.createDataFrame([("2020-01-01 10:00:00 UTC",), ("not-a-time",), (None,)], "t string")
    got = [r[0] for r in df.select(parse_event_time("t")).collect()]
    assert got[0] == dt.datetime(2020, 1, 1, 10, 0, 0)
    assert got[1] is None and got[2] is None


def test_category_levels(spark):
    df = spark.createDataFrame([("a.b",), ("a",), (None,), ("a.b.c",)], "c string")
    rows = df.select(category_level("c", 0).alias("x"), category_level("c", 1).alias("y")).collect()
    assert [(r.x, r.y) for r in rows] == [("a", "b"), ("a", None), (None, None), ("a", "b")]


def test_quarantine_and_clean_are_complements(spark):
    rows = [
        ("2020-01-01 00:00:00 UTC", "view", 1, "c", "x.y", "b", 1.0, 1, "s"),
        ("bad", "view", 1, "c", "x.y", "b", 1.0, 1, "s"),
        ("2020-01-01 00:00:00 UTC", None, 1, "c", "x", None, 1.0, 1, "s"),
        ("2020-01-01 00:00:00 UTC", "cart", None, "c", None, None, 1.0, 1, "s"),
        ("2020-01-01 00:00:00 UTC", "cart", 2, "c", "x", None, None, 1, "s"),
        ("2020-01-01 00:00:00 UTC", "cart", 2, "c", "x", None, 2.0, None, "s"),
        ("2020-01-01 00:00:00 UTC", "cart", 2, "c", "x", None, 2.0, 3, None),
    ]
    p = parse(raw(spark, rows))
    q, c = quarantine(p), clean(p)
    assert q.count() == 5 and c.count() == 2
    assert set(q.columns) == set(RAW_CLICKSTREAM.fieldNames())
    last = c.where(F.col("user_session").isNull()).first()
    assert (last.brand, last.category, last.sub_category) == ("unknown", "x", "unknown")
    assert last.event_date == dt.date(2020, 1, 1)


def test_dedup_null_keys_equal_and_survivor_deterministic(spark):
    df = spark.createDataFrame(
        [(None, 1, "cart", 5, 9.0), (None, 1, "cart", 3, 8.0), ("s", 1, "cart", 7, 1.0), ("s", 2, "cart", 1, 1.0)],
        "user_session string, event_time int, event_type string, event_id int, price double")
    got = dedup(df.withColumn("product_id", F.lit(1)), order_by=["event_id"])
    rows = sorted((r.user_session or "", r.event_time, r.event_id) for r in got.collect())
    assert rows == [("", 1, 3), ("s", 1, 7), ("s", 2, 1)]


def test_enrich_defaults_for_unknown_users(spark):
    clean_df = spark.createDataFrame([(1,), (2,), (None,)], "user_id int")
    crm = spark.createDataFrame([(1, "VIP", dt.date(2019, 1, 1), "Google")],
                                "user_id int, loyalty_tier string, signup_date date, acquisition_channel string")
    got = {r.user_id: (r.loyalty_tier, r.acquisition_channel) for r in enrich(clean_df, crm).collect()}
    assert got == {1: ("VIP", "Google"), 2: ("Regular", "Organic"), None: ("Regular", "Organic")}


def test_hash_key_null_parts_keep_separator(spark):
    df = spark.createDataFrame([(None, 5, "x")], "a string, b int, c string")
    r = df.select(key_text("a", "b", "c").alias("t"), hash_key("a", "b", "c").alias("h")).first()
    assert r.t == "-5-x"
    import hashlib
    assert r.h == hashlib.md5(b"-5-x").hexdigest()


def test_anti_join_keeps_null_keys_and_unmatched(spark):
    left = spark.createDataFrame([("s1", 1), ("s1", 2), (None, 1), ("s2", None)], "user_session string, product_id int")
    right = spark.createDataFrame([("s1", 1), (None, 1), ("s2", None)], "user_session string, product_id int")
    got = sorted((r.user_session or "", r.product_id or 0) for r in anti_join(left, right, ["user_session", "product_id"]).collect())
    assert got == [("", 1), ("s1", 2), ("s2", 0)]


def test_ordinal_numbers_copies_and_ties(spark):
    df = spark.createDataFrame([("k", 1), ("k", 1), ("k", 2), ("j", 5)], "k string, v int")
    got = sorted((r.k, r.v, r.rn) for r in ordinal_mod.ordinal(df, ["k"], ["v"]).collect())
    assert got == [("j", 5, 1), ("k", 1, 1), ("k", 1, 2), ("k", 2, 3)]


def test_ordinal_is_one_window_over_a_hot_key(spark):
    df = spark.range(100).select(F.lit("hot").alias("k"), F.lit(1).alias("v")).unionByName(
        spark.createDataFrame([("hot", 2), ("cold", 1)], "k string, v int"))
    got = ordinal_mod.ordinal(df, ["k"], ["v"])
    hot = sorted(r.rn for r in got.where("k = 'hot'").collect())
    assert hot == list(range(1, 102))
    assert got.where("k = 'hot' AND v = 2").first().rn == 101
    assert got.where("k = 'cold'").first().rn == 1


def test_conform_orders_casts_and_rejects_missing(spark):
    import pytest
    from strata.schemas import DIM_PRODUCTS
    df = spark.createDataFrame([("b", "c", "s", 1)], "brand string, category string, sub_category string, product_id long")
    out = conform(df, DIM_PRODUCTS)
    assert out.columns == ["product_id", "category", "sub_category", "brand"]
    assert dict(out.dtypes)["product_id"] == "int"
    with pytest.raises(ValueError):
        conform(df.drop("brand"), DIM_PRODUCTS)


def test_anti_join_spreads_null_key_rows(spark):
    # most rows carry a NULL key: they must all survive and must not meet in one partition
    hot = spark.range(0, 20000, 1, 16).selectExpr("CAST(NULL AS string) AS s", "CAST(id % 5 AS int) AS p", "id")
    rest = spark.range(0, 6000, 1, 16).selectExpr("CAST(id % 50 AS string) AS s", "CAST(id % 5 AS int) AS p", "id")
    left = hot.unionByName(rest)
    right = spark.range(100).selectExpr("CAST(id % 25 AS string) AS s", "CAST(id % 5 AS int) AS p")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        out = anti_join(left, right, ["s", "p"])
        sizes = [r[1] for r in out.where("s IS NULL").groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 20000 and max(sizes) <= 20000 / 8
        assert out.count() == left.join(right.distinct(), ["s", "p"], "left_anti").count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_hot_user_is_split_in_the_crm_join(spark):
    # with the CRM too large to broadcast, AQE splits the join of a user holding most rows
    from strata.operators.enrich import enrich
    events = spark.range(0, 200000, 1, 8).selectExpr("CAST(if(id % 10 < 9, 1, id) AS int) AS user_id", "id", "sha2(CAST(id AS string), 256) AS pad")
    crm = spark.range(0, 200000).selectExpr("CAST(id AS int) AS user_id", "'VIP' AS loyalty_tier", "'Google' AS acquisition_channel")
    confs = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
             "spark.sql.adaptive.advisoryPartitionSizeInBytes": "200k",
             "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "300k"}
    old = {k: spark.conf.get(k, None) for k in confs}
    try:
        for k, v in confs.items():
            spark.conf.set(k, v)
        sizes = [r[1] for r in enrich(events, crm).groupBy(F.spark_partition_id()).agg(F.count("pad")).collect()]
        assert sum(sizes) == 200000 and max(sizes) < 100000
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_enforced_contract_rejects_nulls_and_long_texts(spark):
    import datetime

    import pytest
    from strata import schemas
    good = [(1, "VIP", datetime.date(2020, 1, 1), "Google")]
    cols = "user_id int, loyalty_tier string, signup_date date, acquisition_channel string"
    assert schemas.enforced(spark.createDataFrame(good, cols), schemas.CRM, schemas.CRM_LENGTHS).count() == 1
    for bad in ((None, "VIP", good[0][2], "x"), (1, "VIP", None, "x"), (1, "V" * 21, good[0][2], "x")):
        with pytest.raises(Exception, match="contract"):
            schemas.enforced(spark.createDataFrame([bad], cols), schemas.CRM, schemas.CRM_LENGTHS).collect()


def test_parse_fast_path_equals_pattern_parser(spark):
    from strata.functions.parse import EVENT_TIME_FORMAT, parse_event_time_sql
    vals = ["2024-02-30 10:00:00 UTC", "2024-01-01 24:00:00 UTC", "2024-01-01T10:00:00 UTC",
            "+024-01-01 10:00:00 UTC", "2024-1-01 10:00:00 UTC", "2024-01-01 10:00:00 PST", "not-a-time",
            "2024-01-01 10:00:60 UTC", "0000-01-01 00:00:00 UTC", "2024-12-31 23:59:59 UTC",
            "2024-01-01 10:00:00 UTC ", " 2024-01-01 10:00:00 UTC", "2024-01-01 10:00:00 utc",
            "9999-12-31 23:59:59 UTC", "2024-13-01 00:00:00 UTC", None]
    df = spark.createDataFrame([(v,) for v in vals], "t string")
    got = df.selectExpr(f"try_to_timestamp(t, '{EVENT_TIME_FORMAT}') <=> ({parse_event_time_sql('t')}) AS same")
    assert all(r.same for r in got.collect())


def test_cluster_conf_sizes_partitions():
    from strata.session import cluster_conf
    c = cluster_conf(300 * (1 << 30))
    assert c["spark.sql.shuffle.partitions"] == "1200"
    assert cluster_conf(1)["spark.sql.shuffle.partitions"] == "200"
