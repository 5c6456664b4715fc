"""Re-run safety: loading days twice, in other batches or orders, gives the
one-shot result; incremental facts re-run cleanly; retraction option."""

from pyspark.sql import functions as F

from strata import catalog
from strata.operators import tables
from strata.plans import daily, gold
from strata.sources import bronze as bronze_src

SF = "/root/testdata/sf0.001"


def staged(spark, L, P):
    rows = L.raw.withColumn("file_year", F.lit("2024"))
    bronze_src.stage_by_day(rows, P.staging)
    return bronze_src.staged_days(spark, P.staging)


def silver_rows(spark, P):
    return sorted(tuple(r) for r in daily.read_silver(spark, P).collect())


def test_silver_batches_in_any_order_equal_one_load(spark, workdir):
    L = catalog.Layers(spark, SF)
    P1, P2 = daily.Paths(workdir + "/one"), daily.Paths(workdir + "/many")
    stage = daily.Paths(workdir + "/stage")
    days = staged(spark, L, stage)
    schema = bronze_src.staged_schema(L.raw.schema)
    daily.bronze_to_silver(spark, P1, L.crm, daily.bronze_days(spark, stage.staging, days, schema))
    late, early = days[len(days) // 2:], days[: len(days) // 2 + 3]
    for batch in (late, early, late):          # out of order, overlapping, repeated
        daily.bronze_to_silver(spark, P2, L.crm, daily.bronze_days(spark, stage.staging, batch, schema))
    assert silver_rows(spark, P1) == silver_rows(spark, P2)
    assert len(silver_rows(spark, P1)) == L.silver.count()


def test_serving_day_reload_twice_equals_once(spark, workdir):
    L = catalog.Layers(spark, SF)
    P = daily.Paths(workdir)
    tables.upsert(spark, P.silver, L.silver, ["user_session", "event_time", "product_id", "event_type"], "event_date")
    daily.silver_to_serving(spark, P, None)
    once = sorted(tuple(r) for r in daily.read_serving(spark, P).collect())
    # a stored day that Silver no longer has goes when all days are loaded
    stale = daily.read_serving(spark, P).limit(1).withColumn("event_date", F.lit("2031-01-01").cast("date"))
    tables.replace_partitions(spark, P.serving, stale, "event_date")
    daily.silver_to_serving(spark, P, None)
    assert sorted(tuple(r) for r in daily.read_serving(spark, P).collect()) == once
    n1 = daily.silver_to_serving(spark, P, ["2024-01-05"])
    n2 = daily.silver_to_serving(spark, P, ["2024-01-05"])
    assert n1 == n2 > 0
    assert sorted(tuple(r) for r in daily.read_serving(spark, P).collect()) == once


def test_incremental_facts_rerun_and_retract(spark, workdir):
    L = catalog.Layers(spark, SF)
    serving = L.serving
    first = serving.where("to_date(event_time) <= DATE'2024-01-20'")
    path_s, path_c, path_r = workdir + "/sales", workdir + "/carts", workdir + "/carts_retract"
    for _ in range(2):
        daily.fact_sales_incremental(spark, path_s, first)
    daily.fact_sales_incremental(spark, path_s, serving)
    daily.fact_sales_incremental(spark, path_s, serving)
    got = sorted(r.sale_id for r in daily.read_fact(spark, path_s, "sale_date").collect())
    assert got == sorted(r.sale_id for r in gold.fact_sales(serving).collect())

    daily.fact_cart_abandonment_incremental(spark, path_c, first)
    daily.fact_cart_abandonment_incremental(spark, path_c, serving)
    plain = {r.abandonment_id for r in daily.read_fact(spark, path_c, "cart_date").collect()}
    daily.fact_cart_abandonment_incremental(spark, path_r, first)
    daily.fact_cart_abandonment_incremental(spark, path_r, serving, retract=True)
    retracted = {r.abandonment_id for r in daily.read_fact(spark, path_r, "cart_date").collect()}
    full = {r.abandonment_id for r in gold.fact_cart_abandonment(serving).collect()}
    assert retracted <= plain
    assert full - plain == set() or full <= plain | retracted
    # every retracted-away cart has a purchase of the same product in the same session
    gone = plain - retracted
    pairs = {(r.user_session, r.product_id) for r in serving.where("event_type = 'purchase'").collect()}
    carts = {r.abandonment_id: (r.user_session, r.product_id)
             for r in daily.read_fact(spark, path_c, "cart_date").collect()}
    assert all(carts[g] in pairs for g in gone)


def test_loading_a_day_without_data(spark, workdir):
    L = catalog.Layers(spark, SF)
    P = daily.Paths(workdir)
    stage = daily.Paths(workdir + "/stage")
    staged(spark, L, stage)
    schema = bronze_src.staged_schema(L.raw.schema)
    m = daily.bronze_to_silver(spark, P, L.crm, daily.bronze_days(spark, stage.staging, ["2030-01-01"], schema),
                               run_dates=["2030-01-01"])
    assert m == {"quarantined": 0, "silver_rows": 0}
    empty = L.raw.where("false")
    assert daily.bronze_to_silver(spark, P, L.crm, empty)["silver_rows"] == 0
    assert daily.silver_to_serving(spark, P, ["2030-01-01"]) == 0


def test_retract_reaches_untouched_days_and_loads_without_carts(spark, workdir):
    import datetime as dt
    from strata.schemas import SERVING

    def rows(*events):
        return spark.createDataFrame([(1, e, 7, "c", "s", "b", 1.0, s, t, "VIP", "Google") for e, s, t in events], SERVING)

    path = workdir + "/carts"
    day = lambda d, h=1: dt.datetime(2024, 1, d, h)
    carts = [("cart", "s1", day(9)), ("cart", "s2", day(10))]
    daily.fact_cart_abandonment_incremental(spark, path, rows(*carts))
    bought = rows(*carts, ("purchase", "s1", day(10, 5)))
    daily.fact_cart_abandonment_incremental(spark, path, bought, retract=True)
    assert [r.user_session for r in daily.read_fact(spark, path, "cart_date").collect()] == ["s2"]
    daily.fact_cart_abandonment_incremental(spark, path, rows(("purchase", "s2", day(10, 6))), retract=True)
    assert daily.read_fact(spark, path, "cart_date").count() == 0
