"""Gold and KPI semantics on literal serving rows."""

import datetime as dt

from strata.plans import gold, kpi
from strata.schemas import SERVING


def serving(spark, rows):
    return spark.createDataFrame(rows, SERVING)


T0 = dt.datetime(2024, 1, 1, 10, 0, 0)
T1 = dt.datetime(2024, 1, 1, 11, 0, 0)


def row(etype, session, product, t=T0, user=1, brand="b", price=1.0, tier="VIP", channel="Google"):
    return (user, etype, product, "c", "s", brand, price, session, t, tier, channel)


def test_cart_abandonment_semantics(spark):
    df = serving(spark, [
        row("cart", "s1", 1), row("purchase", "s1", 1, T1),        # bought later -> not abandoned
        row("cart", "s1", 2),                                       # abandoned
        row("purchase", "s2", 3), row("cart", "s2", 3, T1),         # bought before the cart -> not abandoned
        row("cart", None, 4), row("purchase", None, 4),             # NULL session never matches -> abandoned
        row("cart", "s3", 5, tier=None, channel=None),              # defaults
        row("cart", "s3", 5, tier=None, channel=None),              # identical copy -> rn 2
    ])
    got = gold.fact_cart_abandonment(df).collect()
    assert sorted((r.user_session or "", r.product_id) for r in got) == [("", 4), ("s1", 2), ("s3", 5), ("s3", 5)]
    assert len({r.abandonment_id for r in got}) == 4
    s3 = [r for r in got if r.user_session == "s3"]
    assert {(r.loyalty_tier, r.acquisition_channel) for r in s3} == {("Regular", "Organic")}


def test_fact_sales_keeps_every_purchase(spark):
    df = serving(spark, [row("purchase", "s1", 1), row("purchase", "s1", 1), row("cart", "s1", 1)])
    got = gold.fact_sales(df).collect()
    assert len(got) == 2 and len({r.sale_id for r in got}) == 2


def test_dim_products_greatest_and_prefer_known(spark):
    df = serving(spark, [row("cart", "s", 1, brand="unknown"), row("cart", "s", 1, brand="apple")])
    assert gold.dim_products(df).first().brand == "unknown"
    assert gold.dim_products(df, prefer_known=True).first().brand == "apple"


def test_dim_users_loyalty_missing_crm_user(spark):
    df = serving(spark, [row("cart", "s1", 1, user=1), row("cart", "s2", 1, T1, user=1), row("cart", "s9", 1, user=9)])
    crm = spark.createDataFrame([(1, "Gold", dt.date(2019, 1, 1), "TikTok")],
                                "user_id int, loyalty_tier string, signup_date date, acquisition_channel string")
    got = {r.user_id: r for r in gold.dim_users_loyalty(df, crm).collect()}
    assert got[1].total_sessions == 2 and got[1].loyalty_tier == "Gold"
    assert got[9].loyalty_tier is None and got[9].total_sessions == 1


def test_kpis(spark):
    df = serving(spark, [row("purchase", "s1", 1, price=1.10), row("purchase", "s1", 2, price=2.20),
                         row("cart", "s2", 3)])
    sales, carts = gold.fact_sales(df), gold.fact_cart_abandonment(df)
    r = kpi.kpi_revenue(sales).first()
    assert r.revenue == 3.3 and r.items_sold == 2
    a = kpi.kpi_abandonment_rate(carts, sales).first()
    assert (a.abandoned_carts, a.purchased_sessions) == (1, 1) and a.abandonment_rate == 50.0
    empty = sales.where("false")
    z = kpi.kpi_abandonment_rate(carts.where("false"), empty).first()
    assert z.abandonment_rate == 0.0
    assert kpi.kpi_revenue(empty).first().revenue == 0.0
    top = kpi.top_brands(sales).collect()
    assert [t.brand for t in top] == ["b"] and top[0].volume == 2


def test_abandonment_rate_approx_option(spark):
    rows = [row("purchase", f"s{i}", 1) for i in range(200)] + [row("cart", "z", 2)]
    df = serving(spark, rows)
    sales, carts = gold.fact_sales(df), gold.fact_cart_abandonment(df)
    exact = kpi.kpi_abandonment_rate(carts, sales).first()
    approx = kpi.kpi_abandonment_rate(carts, sales, approx_rsd=0.02).first()
    assert exact.purchased_sessions == 200
    assert abs(approx.purchased_sessions - 200) <= 12


def test_revenue_keeps_parts_of_cents_and_large_prices(spark):
    df = serving(spark, [row("purchase", "s1", 1, price=0.004), row("purchase", "s1", 2, price=0.004),
                         row("purchase", "s1", 3, price=0.004)])
    assert kpi.kpi_revenue(gold.fact_sales(df)).first().revenue == 0.012
    big = serving(spark, [row("purchase", "s1", 1, price=1e17), row("purchase", "s1", 2, price=0.5)])
    assert kpi.kpi_revenue(gold.fact_sales(big)).first().revenue == 1e17
