"""Dashboard KPIs and chart queries over the Gold tables — one Spark query
each, no driver-side arithmetic.

Money sums are exact: prices are summed as DECIMAL(38,10), so no price below a
cent is lost and every partitioning gives the same total; returned as DOUBLE.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MONEY = "decimal(38,10)"
TOP_BRANDS = 10


def money_sum(c: str):
    return F.sum(F.col(c).cast(MONEY)).cast("double")


def kpi_revenue(fact_sales: DataFrame) -> DataFrame:
    return fact_sales.agg(F.coalesce(money_sum("price"), F.lit(0.0)).alias("revenue"),
                          F.count(F.lit(1)).alias("items_sold"))


def kpi_customers(dim_users_loyalty: DataFrame) -> DataFrame:
    return dim_users_loyalty.agg(F.count(F.lit(1)).alias("total_customers"))


def kpi_abandonment_rate(fact_cart_abandonment: DataFrame, fact_sales: DataFrame,
                         approx_rsd: float | None = None) -> DataFrame:
    """abandoned rows / (abandoned rows + purchasing sessions) × 100, 0 when
    both are 0. Both inputs feed one aggregation over their union, so the two
    counts need no join.

    ``approx_rsd`` switches the session count to HyperLogLog++
    (``approx_count_distinct`` with that relative standard deviation): a
    fixed-size sketch merged map-side instead of a shuffle by session."""
    a = fact_cart_abandonment.select(F.lit(True).alias("_is_cart"), F.lit(None).cast("string").alias("_s"))
    s = fact_sales.select(F.lit(False).alias("_is_cart"), F.col("user_session").alias("_s"))
    counts = a.unionByName(s).agg(
        F.count(F.when(F.col("_is_cart"), F.lit(1))).alias("abandoned_carts"),
        (F.countDistinct(F.when(~F.col("_is_cart"), F.col("_s"))) if approx_rsd is None
         else F.approx_count_distinct(F.when(~F.col("_is_cart"), F.col("_s")), approx_rsd))
        .alias("purchased_sessions"))
    total = F.col("abandoned_carts") + F.col("purchased_sessions")
    rate = F.when(total > 0, F.col("abandoned_carts").cast("double") / total.cast("double") * F.lit(100.0)) \
            .otherwise(F.lit(0.0))
    return counts.select("abandoned_carts", "purchased_sessions", rate.alias("abandonment_rate"))


def users_by(dim_users_loyalty: DataFrame, column: str) -> DataFrame:
    return dim_users_loyalty.groupBy(column).agg(F.count(F.lit(1)).alias("count"))


def users_by_tier(dim_users_loyalty: DataFrame) -> DataFrame:
    return users_by(dim_users_loyalty, "loyalty_tier")


def users_by_channel(dim_users_loyalty: DataFrame) -> DataFrame:
    return users_by(dim_users_loyalty, "acquisition_channel")


def top_brands(fact_sales: DataFrame, n: int = TOP_BRANDS) -> DataFrame:
    """Top ``n`` brands by revenue (a top-k report: the limit is the feature);
    brand name breaks ties so the cut is deterministic. Planned as
    ``TakeOrderedAndProject`` over the per-brand aggregate: each task keeps
    only its own top n."""
    return (fact_sales.groupBy("brand")
            .agg(money_sum("price").alias("sales"), F.count(F.lit(1)).alias("volume"))
            .orderBy(F.col("sales").desc(), F.col("brand").asc_nulls_first())
            .limit(n))
