"""Gold star schema built from the serving events: three dimensions and two
facts, as DataFrame plans.

Dimensions aggregate per key with partial (map-side) aggregation, so a hot
user or product is reduced before the shuffle. Facts compute the ordinal that
feeds their surrogate key with the ``ordinal`` operator.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.keys import hash_key_sql
from strata.operators.enrich import DEFAULT_CHANNEL, DEFAULT_TIER
from strata.operators.joins import anti_join
from strata.operators.ordinal import ordinal
from strata.operators.clean import UNKNOWN

SALE_KEYS = ["event_time", "user_id", "product_id", "user_session"]
CART_KEYS = ["user_session", "product_id", "cart_time"]
PAIR_KEYS = ["user_session", "product_id"]


def _tiebreak(df: DataFrame) -> list[str]:
    # A lineage id, when the input carries one, orders rows that tie on time.
    return ["event_id"] if "event_id" in df.columns else []


def _attrs() -> list[str]:
    return [f"coalesce(loyalty_tier, '{DEFAULT_TIER}') AS loyalty_tier",
            f"coalesce(acquisition_channel, '{DEFAULT_CHANNEL}') AS acquisition_channel"]


def dim_users(serving: DataFrame) -> DataFrame:
    return (serving.where(F.col("user_id").isNotNull())
            .groupBy("user_id")
            .agg(F.countDistinct("user_session").alias("total_sessions"),
                 F.min("event_time").alias("first_seen"),
                 F.max("event_time").alias("last_seen")))


def dim_products(serving: DataFrame, prefer_known: bool = False) -> DataFrame:
    """One row per product: the greatest (category, sub_category, brand) in
    descending binary order of the NULL→'' values.

    ``max(struct)`` is an aggregate (partial per map task) instead of a
    ranked window, so a popular product never gathers its rows in one task.
    ``prefer_known=True`` ranks the 'unknown' default below real values.
    """
    parts = []
    for c in ("category", "sub_category", "brand"):
        if prefer_known:
            parts.append(f"coalesce({c}, '') <> '{UNKNOWN}' AS _k_{c}")
        parts.append(f"coalesce({c}, '') AS _o_{c}")
    best = F.expr(f"max(struct({', '.join(parts)}, category, sub_category, brand))")
    return (serving.where("product_id IS NOT NULL")
            .groupBy("product_id").agg(best.alias("_b"))
            .selectExpr("product_id", "_b.category AS category", "_b.sub_category AS sub_category",
                        "_b.brand AS brand"))


def dim_users_loyalty(serving: DataFrame, crm: DataFrame) -> DataFrame:
    """Activity per user joined to the CRM's current attributes.

    The CRM key is unique, so aggregating events per user *before* the left
    join gives the same groups while joining one row per user instead of one
    per event. Users missing from the CRM keep NULL attributes.
    """
    act = (serving.groupBy("user_id")
           .agg(F.countDistinct("user_session").alias("total_sessions"),
                F.min("event_time").alias("first_active_time"),
                F.max("event_time").alias("last_active_time")))
    side = crm.select("user_id", "loyalty_tier", "signup_date", "acquisition_channel")
    return (act.join(side, "user_id", "left")
            .select("user_id", "loyalty_tier", "signup_date", "acquisition_channel",
                    "total_sessions", "first_active_time", "last_active_time"))


def sales_rows(serving: DataFrame) -> DataFrame:
    """Purchase rows of the fact, before the key (input of the ordinal)."""
    extra = _tiebreak(serving)
    return (serving.where("event_type = 'purchase'")
            .selectExpr("event_time", "user_id", "product_id", "brand", "price", "user_session",
                        *_attrs(), *extra))


def fact_sales(serving: DataFrame) -> DataFrame:
    """Every purchase (nothing filtered); ``rn`` among identical
    (time, user, product, session) rows only makes ``sale_id`` unique."""
    rows = ordinal(sales_rows(serving), SALE_KEYS, order_by=_tiebreak(serving))
    return rows.selectExpr(
        f"{hash_key_sql('event_time', 'user_id', 'product_id', 'user_session', 'rn')} AS sale_id",
        "event_time", "user_id", "product_id", "brand", "price", "user_session",
        "loyalty_tier", "acquisition_channel")


def cart_rows(serving: DataFrame) -> DataFrame:
    extra = _tiebreak(serving)
    return (serving.where("event_type = 'cart'")
            .selectExpr("user_id", "user_session", "product_id", "brand", "price",
                        "event_time AS cart_time", *_attrs(), *extra))


def purchased_pairs(serving: DataFrame) -> DataFrame:
    """Distinct (session, product) pairs that were bought."""
    return serving.where("event_type = 'purchase'").select(*PAIR_KEYS).distinct()


def abandoned(carts: DataFrame, purchases: DataFrame) -> DataFrame:
    """Carts with no purchase of the same product in the same session (a cart
    with a NULL session never matches, so it counts as abandoned), keyed."""
    left = anti_join(carts, purchases, PAIR_KEYS)
    return keyed_carts(ordinal(left, CART_KEYS, order_by=[c for c in ("event_id",) if c in carts.columns]))


def keyed_carts(rows: DataFrame) -> DataFrame:
    """The fact's columns, with the key, of carts that have their ordinal."""
    return rows.selectExpr(
        f"{hash_key_sql('user_session', 'product_id', 'cart_time', 'rn')} AS abandonment_id",
        "user_id", "user_session", "product_id", "brand", "price", "cart_time",
        "loyalty_tier", "acquisition_channel")


def fact_cart_abandonment(serving: DataFrame) -> DataFrame:
    purchases = serving.where("event_type = 'purchase'").select(*PAIR_KEYS)
    return abandoned(cart_rows(serving), purchases)
