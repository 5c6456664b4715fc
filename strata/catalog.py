"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame`` and the
matching DuckDB oracle SQL.

Every query reads the provided tables of ``sf_dir`` in full and derives its
input layers from them (fixture mapping → Silver → serving → Gold). Storage
queries (``strata.catalog_storage``) additionally write and re-read tables
below the session's shared checkpoint folder.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property
from itertools import accumulate

from pyspark.sql import DataFrame, SparkSession

from strata import fixtures, oracle, schemas
from strata.functions.buckets import weighted_bucket
from strata.functions.keys import hash_key, key_text
from strata.operators import sample
from strata.operators.sample import distinct_users
from strata.operators.tables import lookback_bound, within_lookback
from strata.plans import checks, gold
from strata.plans import serving as serving_plan
from strata.plans import silver as silver_plan

QueryFn = Callable[[SparkSession, str], DataFrame]

# Shares of the split that the weighted draw assigns to customers.
SPLITS = ["test", "valid", "train"]
SPLIT_WEIGHTS = [0.05, 0.15, 0.80]
SPLIT_SALT = "split"
LOOKBACK_DAYS = 2

SAMPLE_SEED = "crm-seed"
SAMPLE_ROWS = 100


@dataclass
class Layers:
    """Lazily built DataFrame plans of every layer for one scale folder."""

    spark: SparkSession
    sf_dir: str

    @cached_property
    def inputs(self):
        return fixtures.load(self.spark, self.sf_dir)

    @property
    def raw(self) -> DataFrame:
        return self.inputs[0]

    @property
    def crm(self) -> DataFrame:
        return self.inputs[1]

    @cached_property
    def silver(self) -> DataFrame:
        return silver_plan.silver(self.raw, self.crm)

    @cached_property
    def serving(self) -> DataFrame:
        return serving_plan.serving(self.silver)

    @cached_property
    def fact_sales(self) -> DataFrame:
        return gold.fact_sales(self.serving)

    @cached_property
    def fact_carts(self) -> DataFrame:
        return gold.fact_cart_abandonment(self.serving)

    @cached_property
    def dim_users_loyalty(self) -> DataFrame:
        return gold.dim_users_loyalty(self.serving, self.crm)

    @cached_property
    def dim_products(self) -> DataFrame:
        return gold.dim_products(self.serving)

    @cached_property
    def dim_users(self) -> DataFrame:
        return gold.dim_users(self.serving)


QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}
STORAGE_QUERIES: set[str] = set()   # queries that write tables (filled by catalog_storage)


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = lambda spark, sf_dir: fn(Layers(spark, sf_dir))
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def out(df: DataFrame) -> DataFrame:
    """Timestamps as wall-clock (NTZ) values, like the oracle's TIMESTAMP."""
    return schemas.ntz(df)


w = oracle.with_ctes

# ---------------------------------------------------------------- Silver layer


@register("quarantine", w("SELECT * FROM quarantined"))
def q_quarantine(L: Layers) -> DataFrame:
    return silver_plan.quarantined(L.raw)


@register("silver_clean", w("SELECT * FROM cleaned"))
def q_silver_clean(L: Layers) -> DataFrame:
    return out(silver_plan.silver_clean(L.raw))


@register("silver_dedup", w("SELECT * FROM deduped"))
def q_silver_dedup(L: Layers) -> DataFrame:
    return out(silver_plan.silver_dedup(L.raw))


@register("silver_enriched", w("SELECT * FROM silver"))
def q_silver_enriched(L: Layers) -> DataFrame:
    return out(L.silver)


@register("serving_daily", w("SELECT * FROM serving"))
def q_serving_daily(L: Layers) -> DataFrame:
    return out(L.serving)


# ---------------------------------------------------------------- Gold layer


@register("dim_users", w("SELECT * FROM d_users"))
def q_dim_users(L: Layers) -> DataFrame:
    return out(L.dim_users)


@register("dim_products", w("SELECT * FROM d_products"))
def q_dim_products(L: Layers) -> DataFrame:
    return L.dim_products


@register("dim_users_loyalty", w("SELECT * FROM d_users_loyalty"))
def q_dim_users_loyalty(L: Layers) -> DataFrame:
    return out(L.dim_users_loyalty)


@register("fact_sales", w("SELECT * FROM f_sales"))
def q_fact_sales(L: Layers) -> DataFrame:
    return out(L.fact_sales)


@register("fact_cart_abandonment", w("SELECT * FROM f_carts"))
def q_fact_cart_abandonment(L: Layers) -> DataFrame:
    return out(L.fact_carts)


@register("purchased_pairs",
          w("SELECT DISTINCT user_session, product_id FROM serving WHERE event_type = 'purchase'"))
def q_purchased_pairs(L: Layers) -> DataFrame:
    return gold.purchased_pairs(L.serving)


@register("surrogate_keys", w("""
    SELECT event_id,
           concat(user_session, '-', CAST(product_id AS VARCHAR), '-', CAST(event_time AS VARCHAR), '-', brand) AS key_text,
           md5(concat(user_session, '-', CAST(product_id AS VARCHAR), '-', CAST(event_time AS VARCHAR), '-', brand)) AS key
    FROM silver"""))
def q_surrogate_keys(L: Layers) -> DataFrame:
    parts = ("user_session", "product_id", "event_time", "brand")
    return L.silver.select("event_id", key_text(*parts).alias("key_text"), hash_key(*parts).alias("key"))


@register("lookback_window", w(f"""
    SELECT * FROM f_sales
    WHERE event_time >= (SELECT max(event_time) - INTERVAL {LOOKBACK_DAYS} DAY FROM f_sales)"""))
def q_lookback_window(L: Layers) -> DataFrame:
    bound = lookback_bound(L.fact_sales, "event_time", LOOKBACK_DAYS)
    return out(within_lookback(L.fact_sales, "event_time", bound))


# ---------------------------------------------------------------- users, draws


@register("distinct_users", w("SELECT DISTINCT user_id FROM raw_clickstream WHERE user_id IS NOT NULL"))
def q_distinct_users(L: Layers) -> DataFrame:
    return distinct_users(L.raw)


@register("data_end_date", w("SELECT last_day(max(event_date)) AS data_end_date FROM silver"))
def q_data_end_date(L: Layers) -> DataFrame:
    return serving_plan.data_end_date(L.silver)


@register("bounded_sample", w(f"""
    SELECT user_id FROM (SELECT DISTINCT user_id FROM raw_clickstream WHERE user_id IS NOT NULL)
    ORDER BY md5(CAST(user_id AS VARCHAR) || '{SAMPLE_SEED}') LIMIT {SAMPLE_ROWS}"""))
def q_bounded_sample(L: Layers) -> DataFrame:
    return sample.bounded_sample(distinct_users(L.raw), SAMPLE_ROWS, "user_id", SAMPLE_SEED)


def _bounds(weights: list[float]) -> list[float]:
    total = float(sum(weights))
    return [x / total for x in accumulate(weights)]


@register("weighted_bucket", w(f"""
    SELECT user_id, loyalty_tier, {oracle.bucket_sql('user_id', SPLITS, _bounds(SPLIT_WEIGHTS), SPLIT_SALT)} AS split
    FROM user_loyalty"""))
def q_weighted_bucket(L: Layers) -> DataFrame:
    """Every CRM row with its split, drawn by weight from the row's key."""
    return L.crm.select("user_id", "loyalty_tier", weighted_bucket("user_id", SPLITS, SPLIT_WEIGHTS, SPLIT_SALT).alias("split"))


# ---------------------------------------------------------------- data quality

DQ_VIEWS = {
    "ecommerce_events": "serving", "user_loyalty": "user_loyalty", "dim_users_loyalty": "d_users_loyalty",
    "dim_products": "d_products", "fact_sales": "f_sales", "fact_cart_abandonment": "f_carts",
}


def gold_tables(L: Layers) -> dict[str, DataFrame]:
    """The checked tables as plans over the provided tables (not stored)."""
    return {"ecommerce_events": L.serving, "user_loyalty": L.crm, "dim_users_loyalty": L.dim_users_loyalty,
            "dim_products": L.dim_products, "fact_sales": L.fact_sales, "fact_cart_abandonment": L.fact_carts}


def _sql_not_null() -> str:
    parts = []
    for name, cols in checks.NOT_NULL.items():
        for c in cols:
            parts.append(f"SELECT '{name}' AS \"table\", '{c}' AS \"column\", 'not_null' AS \"check\", "
                         f"CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS failures FROM {DQ_VIEWS[name]}")
    return "\nUNION ALL ".join(parts)


def _sql_unique() -> str:
    parts = []
    for name, c in checks.UNIQUE.items():
        parts.append(f"SELECT '{name}' AS \"table\", '{c}' AS \"column\", 'unique' AS \"check\", "
                     f"CAST(count(*) AS BIGINT) AS failures FROM (SELECT {c} FROM {DQ_VIEWS[name]} "
                     f"WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1)")
    return "\nUNION ALL ".join(parts)


def _sql_referential() -> str:
    parts = []
    for c, cc, p, pc in checks.REFERENTIAL:
        parts.append(f"SELECT '{c}' AS \"table\", '{cc}' AS \"column\", 'relationships:{p}.{pc}' AS \"check\", "
                     f"CAST(count(*) AS BIGINT) AS failures FROM {DQ_VIEWS[c]} x WHERE x.{cc} IS NOT NULL "
                     f"AND NOT EXISTS (SELECT 1 FROM {DQ_VIEWS[p]} y WHERE y.{pc} = x.{cc})")
    return "\nUNION ALL ".join(parts)


SQL_NOT_NULL, SQL_UNIQUE, SQL_REFERENTIAL = _sql_not_null(), _sql_unique(), _sql_referential()


# The storage and streaming queries register themselves on import.
from strata import catalog_storage  # noqa: E402,F401
