"""Plan assertions: the physical plans have the shape we want at scale."""

from strata import catalog


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


SF = "/root/testdata/sf0.001"


def test_no_cartesian_product_anywhere(spark):
    for name, fn in catalog.QUERIES.items():
        if name in catalog.STORAGE_QUERIES:
            continue
        p = plan(fn(spark, SF))
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, name


def test_dedup_is_reduced_map_side(spark):
    p = plan(catalog.QUERIES["silver_dedup"](spark, SF))
    assert "WindowGroupLimit" in p and "Partial" in p


def test_cart_abandonment_uses_anti_join(spark):
    p = plan(catalog.QUERIES["fact_cart_abandonment"](spark, SF))
    assert "LeftAnti" in p


def test_scan_prunes_columns_and_pushes_filters(spark):
    p = plan(catalog.QUERIES["fact_sales"](spark, SF))
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string,value:double,props:string>" in p
    assert "p_retailprice" not in p
    assert "PushedFilters: [IsNotNull(p_partkey)" in p


def test_dims_use_partial_aggregation(spark):
    p = plan(catalog.QUERIES["dim_products"](spark, SF))
    assert "partial_max" in p
    p = plan(catalog.QUERIES["dim_users_loyalty"](spark, SF))
    assert "partial_count" in p or "partial_min" in p


def test_top_brands_is_take_ordered(spark):
    from strata.plans import kpi
    assert "TakeOrderedAndProject" in plan(kpi.top_brands(catalog.Layers(spark, SF).fact_sales))


def test_day_read_prunes_partitions(spark, workdir):
    from strata.plans import daily
    from strata.operators import tables
    from strata.plans import serving as serving_plan
    L = catalog.Layers(spark, SF)
    P = daily.Paths(workdir)
    tables.upsert(spark, P.silver, L.silver, ["user_session", "event_time", "product_id", "event_type"], "event_date")
    df = daily.read_silver(spark, P)
    p = plan(serving_plan.serving(df, "2024-01-05"))
    assert "PartitionFilters: [isnotnull(event_date" in p and "2024-01-05" in p.split("PartitionFilters")[1][:200]


def test_anti_join_is_a_single_join(spark):
    from strata.operators.joins import anti_join
    L = catalog.Layers(spark, SF)
    from strata.plans import gold
    p = plan(anti_join(gold.cart_rows(L.serving), L.serving.select("user_session", "product_id"),
                       ["user_session", "product_id"]))
    assert p.count("LeftAnti") == 1


def test_ordinal_is_one_shuffle(spark):
    from strata.operators.ordinal import ordinal
    df = spark.range(100).selectExpr("id % 7 AS k", "id % 3 AS v")
    p = plan(ordinal(df, ["k"], ["v"]))
    assert p.count("Exchange") == 1 and p.count("Window ") == 1


def test_part_is_read_whole(spark):
    # no literal filter on the product key: every part can be met
    p = plan(catalog.QUERIES["dim_products"](spark, SF))
    filters = [x.split("]")[0] for x in p.split("PushedFilters: [")[1:]]
    assert all(">" not in f and "<" not in f for f in filters if "p_partkey" in f)
    small = catalog.QUERIES["dim_products"](spark, SF).count()
    assert catalog.QUERIES["dim_products"](spark, "/root/testdata/sf0.01").count() > 2 * small
