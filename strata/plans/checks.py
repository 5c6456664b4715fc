"""The checks of the stored tables: NOT NULL columns, keys, references."""

from __future__ import annotations

from pyspark.sql import DataFrame

from strata.operators import quality

# The tested columns of each table.
NOT_NULL = {
    "ecommerce_events": ["event_time", "event_type", "user_id", "product_id", "price"],
    "user_loyalty": ["user_id", "loyalty_tier"],
    "dim_users_loyalty": ["user_id"],
    "dim_products": ["product_id"],
    "fact_sales": ["sale_id"],
    "fact_cart_abandonment": ["abandonment_id"],
}
UNIQUE = {
    "user_loyalty": "user_id",
    "dim_users_loyalty": "user_id",
    "dim_products": "product_id",
    "fact_sales": "sale_id",
    "fact_cart_abandonment": "abandonment_id",
}
REFERENTIAL = [
    ("fact_sales", "product_id", "dim_products", "product_id"),
    ("fact_sales", "user_id", "dim_users_loyalty", "user_id"),
    ("fact_cart_abandonment", "product_id", "dim_products", "product_id"),
    ("fact_cart_abandonment", "user_id", "dim_users_loyalty", "user_id"),
]


def dq_not_null(t: dict[str, DataFrame]) -> DataFrame:
    return quality.union_all([quality.not_null(t[name], name, cols) for name, cols in NOT_NULL.items()])


def dq_unique(t: dict[str, DataFrame]) -> DataFrame:
    return quality.union_all([quality.unique(t[name], name, col) for name, col in UNIQUE.items()])


def dq_referential(t: dict[str, DataFrame]) -> DataFrame:
    by_parent: dict[tuple[str, str], list] = {}
    for child, column, parent, parent_column in REFERENTIAL:
        by_parent.setdefault((parent, parent_column), []).append((t[child], child, column))
    return quality.union_all([quality.relationships_to(t[parent], column, parent, children)
                              for (parent, column), children in by_parent.items()])


def dq_report(t: dict[str, DataFrame]) -> DataFrame:
    return quality.union_all([dq_not_null(t), dq_unique(t), dq_referential(t)])
