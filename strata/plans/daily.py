"""The batch jobs with storage: landing → staging → Bronze → Silver (upsert)
+ quarantine → serving (day replace) → Gold (dims overwrite, facts
incremental upsert). Each job takes the days it loads; any scheduler can call
them, and re-running a job for the same days gives the same tables.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata import schemas
from strata.operators import deltas, tables
from strata.operators.clean import DEDUP_KEYS
from strata.plans import gold
from strata.plans import serving as serving_plan
from strata.plans import silver as silver_plan
from strata.sources import bronze as bronze_src

LOOKBACK_DAYS = 2


@dataclass(frozen=True)
class Paths:
    root: str

    def __getattr__(self, name: str) -> str:  # landing, staging, bronze, silver, ...
        if name.startswith("_"):
            raise AttributeError(name)
        return f"{self.root.rstrip('/')}/{name}"


def silver_schema(with_id: bool) -> T.StructType:
    fields = list(schemas.SILVER.fields)
    if with_id:
        fields.append(T.StructField("event_id", T.LongType(), True))
    return T.StructType(fields)


def serving_schema(with_id: bool) -> T.StructType:
    fields = list(schemas.SERVING.fields)
    if with_id:
        fields.append(T.StructField("event_id", T.LongType(), True))
    return T.StructType(fields + [T.StructField("event_date", T.DateType(), True)])


# ---------------------------------------------------------------- Bronze → Silver

def bronze_days(spark: SparkSession, bronze_root: str, run_dates: list[str],
                schema: T.StructType) -> DataFrame:
    """Rows of the given days, read from their folders; the rest of the tree isn't listed."""
    return bronze_src.scan_days(spark, bronze_root, run_dates, schema)


def bronze_to_silver(spark: SparkSession, P: Paths, crm: DataFrame, raw: DataFrame, observe: bool = True,
                     run_dates: list[str] | None = None, batch_id: int | None = None, delta: int | None = None) -> dict:
    """Quarantine (replaced per load day) and Silver (upsert) for the raw rows
    of some days. Returns the row counts observed during the writes.

    With ``batch_id`` (a micro-batch) the quarantine is kept per batch instead,
    below ``quarantine_stream``: a day may come in many batches, and a replayed
    batch replaces its own rows only.

    Both outputs come from one parse; quarantine is a scan + filter job, the
    Silver job does the shuffles (dedup, join, merge). ``observe=False``
    inside ``foreachBatch`` (micro-batch plans do not report observations).
    ``run_dates`` are the load days this call owns: their quarantine
    partitions are replaced even when a re-run quarantines nothing.

    With ``delta`` (the load's number) Silver is a merge-on-read table
    (``operators.deltas``): the rows are appended as that delta, and no stored day is
    read or rewritten.
    """
    q_obs, s_obs = Observation("quarantine"), Observation("silver")
    q, s = silver_plan.silver_parts(raw, crm)
    q_src, s_src = q, s
    if all(c in q.columns for c in bronze_src.PARTS):
        load_day = F.concat_ws("-", *[F.col(c) for c in bronze_src.PARTS]).cast("date")
        q = q.withColumn("run_date", load_day).drop(*bronze_src.PARTS)
    else:
        q = q.withColumn("run_date", F.current_date())
    if observe:
        q = q.observe(q_obs, F.count(F.lit(1)).alias("rows"))
        s = s.observe(s_obs, F.count(F.lit(1)).alias("rows"))
    if batch_id is None:
        tables.replace_partitions(spark, P.quarantine, q, "run_date", owned=run_dates)
    else:
        tables.replace_partitions(spark, P.quarantine_stream, q.withColumn("batch_id", F.lit(batch_id).cast("bigint")),
                                  "batch_id", owned=[batch_id])
    if delta is None:
        tables.upsert(spark, P.silver, s, DEDUP_KEYS, "event_date", schema=silver_schema("event_id" in s.columns))
    else:
        deltas.append_delta(spark, P.silver, s, "event_date", delta)
    if not observe:
        return {}
    return {"quarantined": tables.observed(q_obs, q_src).get("rows", 0),
            "silver_rows": tables.observed(s_obs, s_src).get("rows", 0)}


# ---------------------------------------------------------------- Silver → serving

def read_silver(spark: SparkSession, P: Paths, with_id: bool = True) -> DataFrame:
    """Silver as stored: a table, or base and deltas merged."""
    if tables.table_exists(spark, f"{P.silver}/delta") or tables.table_exists(spark, f"{P.silver}/base"):
        return deltas.read_merged(spark, P.silver, silver_schema(with_id), DEDUP_KEYS, "event_date")
    return tables.read_table(spark, P.silver, silver_schema(with_id))


def compact_silver(spark: SparkSession, P: Paths, with_id: bool = True) -> list[str]:
    return deltas.compact(spark, P.silver, silver_schema(with_id), DEDUP_KEYS, "event_date")


def silver_to_serving(spark: SparkSession, P: Paths, run_dates: list[str] | None,
                      with_id: bool = True) -> int:
    """Replace the serving days ``run_dates`` (every Silver day when None)
    with Silver's non-view rows of those days; a day without rows is cleared. A row that
    breaks the serving contract fails the job, and the stored days stay as they were."""
    silver = read_silver(spark, P, with_id)
    if run_dates is not None:
        silver = silver.where(F.col("event_date").isin([F.lit(d).cast("date") for d in run_dates]))
    rows = schemas.enforced(serving_plan.serving(silver), schemas.SERVING, schemas.SERVING_LENGTHS, keep_extra=silver_plan.LINEAGE)
    rows = rows.withColumn("event_date", F.to_date("event_time"))
    obs = Observation("serving")
    source = rows
    rows = rows.observe(obs, F.count(F.lit(1)).alias("rows"))
    if run_dates is None:
        tables.write_table(rows, P.serving, "event_date", whole=True)
    else:
        tables.replace_partitions(spark, P.serving, rows, "event_date", owned=run_dates)
    return tables.observed(obs, source).get("rows", 0)


def read_serving(spark: SparkSession, P: Paths, with_id: bool = True) -> DataFrame:
    return tables.read_table(spark, P.serving, serving_schema(with_id))


# ---------------------------------------------------------------- Gold

def fact_sales_incremental(spark: SparkSession, path: str, serving: DataFrame,
                           lookback_days: int = LOOKBACK_DAYS, full_refresh: bool = False) -> list[str]:
    """Upsert by ``sale_id`` the sales at or after (high-water − lookback).

    An empty or missing table (NULL high-water) loads everything;
    ``full_refresh`` reloads everything (backfills older than the window).
    """
    src = serving
    if tables.table_exists(spark, path) and not full_refresh:
        bound = tables.partitioned_lookback_bound(spark, path, "event_time", "sale_date", lookback_days)
        src = tables.within_lookback(serving, "event_time", bound)
    fact = gold.fact_sales(src).withColumn("sale_date", F.to_date("event_time"))
    return tables.upsert(spark, path, fact, ["sale_id"], "sale_date")


def fact_cart_abandonment_incremental(spark: SparkSession, path: str, serving: DataFrame,
                                      lookback_days: int = LOOKBACK_DAYS, full_refresh: bool = False,
                                      retract: bool = False) -> list[str]:
    """Upsert by ``abandonment_id`` the carts at or after (high-water −
    lookback), judged against purchases inside the same window.

    By default a stored cart is never removed when its purchase arrives in a
    later load (upsert only). ``retract=True`` also deletes every stored cart
    of the window whose (session, product) has a purchase in the window, on
    whatever day it is stored and also when no new cart came.
    """
    bound = None
    carts = gold.cart_rows(serving)
    purchases = serving.where(F.col("event_type") == "purchase")
    if tables.table_exists(spark, path) and not full_refresh:
        bound = tables.partitioned_lookback_bound(spark, path, "cart_time", "cart_date", lookback_days)
        carts = tables.within_lookback(carts, "cart_time", bound)
        purchases = tables.within_lookback(purchases, "event_time", bound)
    pairs = purchases.select(*gold.PAIR_KEYS)
    fact = gold.abandoned(carts, pairs).withColumn("cart_date", F.to_date("cart_time"))
    touched = tables.upsert(spark, path, fact, ["abandonment_id"], "cart_date")
    if retract and tables.table_exists(spark, path):
        stored = tables.read_table(spark, path, FACT_SCHEMAS["cart_date"])
        window = tables.within_lookback(stored, "cart_time", bound)
        bought = window.join(pairs.distinct(), gold.PAIR_KEYS, "left_semi")
        days = [tables.NULL_PARTITION if r[0] is None else str(r[0]) for r in bought.select("cart_date").distinct().collect()]
        if days:
            ids = bought.select("abandonment_id").distinct()
            keep = tables.in_partitions(stored, "cart_date", days).join(ids, "abandonment_id", "left_anti")
            tables.replace_partitions(spark, path, keep.select(*stored.columns), "cart_date", owned=days)
    return touched


FACT_SCHEMAS = {
    "sale_date": T.StructType(schemas.FACT_SALES.fields + [T.StructField("sale_date", T.DateType(), True)]),
    "cart_date": T.StructType(schemas.FACT_CART_ABANDONMENT.fields + [T.StructField("cart_date", T.DateType(), True)]),
}


def read_fact(spark: SparkSession, path: str, partition_col: str) -> DataFrame:
    """A stored fact table without its partition column (declared schema, so
    an empty table reads as empty rather than failing inference)."""
    return tables.read_table(spark, path, FACT_SCHEMAS.get(partition_col)).drop(partition_col)


def build_dims(spark: SparkSession, P: Paths, serving: DataFrame, crm: DataFrame) -> None:
    """Full-refresh dimensions (overwrite)."""
    tables.write_table(gold.dim_users(serving), P.dim_users)
    tables.write_table(gold.dim_products(serving), P.dim_products)
    tables.write_table(gold.dim_users_loyalty(serving, crm), P.dim_users_loyalty)
