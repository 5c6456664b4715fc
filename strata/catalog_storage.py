"""Registered storage and streaming queries.

Each runs the real jobs into a fresh folder below the session's shared
checkpoint folder (``spark.checkpoint.dir``) and returns the final table read
back; the oracle is the SQL of the one-shot result the runs must equal.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata import catalog, oracle, schemas
from strata.catalog import QUERIES, STORAGE_QUERIES, Layers, out, register
from strata.operators import hot_keys, tables
from strata.plans import checks, daily, gold, kpi, named, publish, sketches, states
from strata.plans import silver as silver_plan
from strata.session import work_path
from strata.sources import bronze as bronze_src
from strata.sources import csv as csv_src
from strata.sources.crm import scan_crm
from strata.streaming import cart_stream, landing_stream, silver_stream

FIRST_BATCH_END = "2024-01-20"        # batch 1: days up to here
SECOND_BATCH_START = "2024-01-15"     # batch 2 re-loads an overlap from here on
RELOAD_DAY = "2024-01-10"

RAW_WITH_ID = T.StructType([T.StructField("event_id", T.LongType(), True)] + schemas.RAW_CLICKSTREAM.fields)
STAGED_WITH_ID = bronze_src.staged_schema(RAW_WITH_ID)

w = oracle.with_ctes
_BEFORE = set(QUERIES)
RAW_SELECT = oracle.RAW_COLS
# Landing files are named by the period of their rows; those of unreadable times carry
# none, count as of the default year and are not staged.
DATED = "try_strptime(event_time, '%Y-%m-%d %H:%M:%S UTC') IS NOT NULL"
STAGED_SQL = (f"SELECT {RAW_SELECT}, substring(event_time, 1, 4) AS year, substring(event_time, 6, 2) AS month, "
              f"substring(event_time, 9, 2) AS day FROM raw_clickstream WHERE {DATED}")


def workspace(L: Layers, name: str) -> daily.Paths:
    return daily.Paths(work_path(L.spark, name))


def by_month(raw: DataFrame) -> DataFrame:
    """Rows with the ``period`` their landing file is named by."""
    month = F.when(F.col("event_time").rlike("^[0-9]{4}-[0-9]{2}-"), F.substring("event_time", 1, 7)).otherwise("undated")
    return raw.withColumn("period", month)


def land(L: Layers, P: daily.Paths) -> str:
    """Write the raw clickstream as gzip CSV landing files, one folder per month."""
    csv_src.write_csv(by_month(L.raw), P.landing, "period")
    return P.landing


def stage(L: Layers, P: daily.Paths) -> str:
    land(L, P)
    bronze_src.stage_by_day(csv_src.scan_csv(L.spark, P.landing, RAW_WITH_ID), P.staging)
    return P.staging


def staged_table(L: Layers, root: str) -> DataFrame:
    return L.spark.read.schema(STAGED_WITH_ID).parquet(root)


# ---------------------------------------------------------------- landing, staging, Bronze


@register("scan_csv_raw", w(
    f"SELECT {RAW_SELECT}, CASE WHEN {DATED} THEN substring(event_time, 1, 4) ELSE '{csv_src.DEFAULT_FILE_YEAR}' END "
    "AS file_year FROM raw_clickstream"))
def q_scan_csv_raw(L: Layers) -> DataFrame:
    P = workspace(L, "scan_csv_raw")
    land(L, P)
    return csv_src.scan_csv(L.spark, P.landing, RAW_WITH_ID)


@register("stage_by_day", w(f"SELECT year, month, day, CAST(count(*) AS BIGINT) AS n FROM ({STAGED_SQL}) "
                            f"GROUP BY year, month, day"))
def q_stage_by_day(L: Layers) -> DataFrame:
    P = workspace(L, "stage_by_day")
    stage(L, P)
    return staged_table(L, P.staging).groupBy(*bronze_src.PARTS).agg(F.count(F.lit(1)).alias("n"))


@register("bronze_publish_day", w(STAGED_SQL))
def q_bronze_publish_day(L: Layers) -> DataFrame:
    """Publish every staged day in one job; one day again, as the daily job does."""
    P = workspace(L, "bronze_publish_day")
    stage(L, P)
    days = bronze_src.staged_days(L.spark, P.staging)
    bronze_src.publish_days(L.spark, P.staging, P.bronze, days, STAGED_WITH_ID)
    bronze_src.publish_day(L.spark, P.staging, P.bronze, days[0], STAGED_WITH_ID)
    return staged_table(L, P.bronze)


@register("scan_bronze_day", w(STAGED_SQL))
def q_scan_bronze_day(L: Layers) -> DataFrame:
    """The day reader over every staged day's folder, together covering the table."""
    P = workspace(L, "scan_bronze_day")
    stage(L, P)
    return bronze_src.scan_days(L.spark, P.staging, bronze_src.staged_days(L.spark, P.staging), STAGED_WITH_ID)


# ---------------------------------------------------------------- CRM


@register("scan_crm", w("SELECT user_id, loyalty_tier, acquisition_channel FROM user_loyalty"))
def q_scan_crm(L: Layers) -> DataFrame:
    P = workspace(L, "scan_crm")
    tables.write_table(schemas.enforced(L.crm, schemas.CRM, schemas.CRM_LENGTHS), P.crm)
    return scan_crm(L.spark, path=P.crm)


@register("crm_insert_absent", w("""
    SELECT user_id, CASE WHEN user_id % 3 = 0 THEN upper(loyalty_tier) ELSE loyalty_tier END AS loyalty_tier,
           signup_date, acquisition_channel
    FROM user_loyalty"""))
def q_crm_insert_absent(L: Layers) -> DataFrame:
    """Two overlapping slices that together are all customers: what the first stored
    stays as it was, though the second brings it with another tier."""
    P = workspace(L, "crm_insert_absent")
    crm = schemas.conform(L.crm, schemas.CRM)
    tables.write_table(crm.where("user_id % 3 <> 0"), P.crm)
    tables.insert_absent(L.spark, P.crm, crm.where("user_id % 3 <> 1").withColumn("loyalty_tier", F.upper("loyalty_tier")),
                         "user_id")
    return tables.read_table(L.spark, P.crm)


# ---------------------------------------------------------------- Silver and serving storage


def _days(first: str | None, last: str | None, days: list[str]) -> list[str]:
    return [d for d in days if (first is None or d >= first) and (last is None or d <= last)]


@register("silver_upsert", w("SELECT * FROM silver"))
def q_silver_upsert(L: Layers) -> DataFrame:
    """Two overlapping Bronze loads merged into Silver equal one load."""
    P = workspace(L, "silver_upsert")
    stage(L, P)
    days = bronze_src.staged_days(L.spark, P.staging)
    for batch in (_days(None, FIRST_BATCH_END, days), _days(SECOND_BATCH_START, None, days)):
        raw = daily.bronze_days(L.spark, P.staging, batch, STAGED_WITH_ID)
        daily.bronze_to_silver(L.spark, P, L.crm, raw, run_dates=batch)
    return out(daily.read_silver(L.spark, P))


@register("silver_merge_on_read", w("SELECT * FROM silver"))
def q_silver_merge_on_read(L: Layers) -> DataFrame:
    """Silver as base and deltas: a load, its compaction, an overlapping load and one
    that comes again under its number; read merged, it equals one load."""
    P = workspace(L, "silver_merge_on_read")
    stage(L, P)
    days = bronze_src.staged_days(L.spark, P.staging)
    first, second = _days(None, FIRST_BATCH_END, days), _days(SECOND_BATCH_START, None, days)
    daily.bronze_to_silver(L.spark, P, L.crm, daily.bronze_days(L.spark, P.staging, first, STAGED_WITH_ID), run_dates=first, delta=1)
    daily.compact_silver(L.spark, P)
    for _ in range(2):
        raw = daily.bronze_days(L.spark, P.staging, second, STAGED_WITH_ID)
        daily.bronze_to_silver(L.spark, P, L.crm, raw, run_dates=second, delta=2)
    return out(daily.read_silver(L.spark, P))


@register("stream_silver_deltas", w("SELECT * FROM silver"))
def q_stream_silver_deltas(L: Layers) -> DataFrame:
    """The stream of Bronze files into base and deltas: each micro-batch writes its own rows
    only; compacted once, then read merged."""
    P = workspace(L, "stream_silver_deltas")
    stage(L, P)
    silver_stream.stream_silver(L.spark, P.staging, P, L.crm, STAGED_WITH_ID, P.stream_checkpoint, max_files_per_trigger=8,
                                merge_on_read=True)
    daily.compact_silver(L.spark, P)
    return out(daily.read_silver(L.spark, P))


def _silver_in_storage(L: Layers, name: str) -> daily.Paths:
    P = workspace(L, name)
    tables.upsert(L.spark, P.silver, L.silver, ["user_session", "event_time", "product_id", "event_type"],
                  "event_date")
    return P


@register("serving_replace_day", w("SELECT * FROM serving"))
def q_serving_replace_day(L: Layers) -> DataFrame:
    """Load every day, clear one day with an empty load, reload it."""
    P = _silver_in_storage(L, "serving_replace_day")
    daily.silver_to_serving(L.spark, P, None)
    empty = daily.read_serving(L.spark, P).where(F.lit(False))
    tables.replace_partitions(L.spark, P.serving, empty, "event_date", owned=[RELOAD_DAY])
    daily.silver_to_serving(L.spark, P, [RELOAD_DAY])
    return out(daily.read_serving(L.spark, P).drop("event_date"))


@register("serving_contract", w(
    "SELECT user_id, event_type, product_id, category, sub_category, brand, price, user_session, "
    "event_time, loyalty_tier, acquisition_channel FROM serving"))
def q_serving_contract(L: Layers) -> DataFrame:
    P = _silver_in_storage(L, "serving_contract")
    daily.silver_to_serving(L.spark, P, None)
    return out(schemas.enforced(daily.read_serving(L.spark, P), schemas.SERVING, schemas.SERVING_LENGTHS))


@register("run_metrics", w(f"""
    SELECT 'quarantined' AS step, CAST(count(*) AS BIGINT) AS rows FROM quarantined
      WHERE {DATED}
    UNION ALL SELECT 'silver_rows', CAST(count(*) AS BIGINT) FROM silver
    UNION ALL SELECT 'serving_rows', CAST(count(*) AS BIGINT) FROM serving"""))
def q_run_metrics(L: Layers) -> DataFrame:
    """Row counts observed while the jobs write (no extra counting pass)."""
    P = workspace(L, "run_metrics")
    stage(L, P)
    days = bronze_src.staged_days(L.spark, P.staging)
    m = daily.bronze_to_silver(L.spark, P, L.crm, daily.bronze_days(L.spark, P.staging, days, STAGED_WITH_ID),
                               run_dates=days)
    m["serving_rows"] = daily.silver_to_serving(L.spark, P, days)
    rows = [(k, int(m[k])) for k in ("quarantined", "silver_rows", "serving_rows")]
    return L.spark.createDataFrame(rows, "step string, rows bigint")


# ---------------------------------------------------------------- incremental facts


def _serving_in_storage(L: Layers, name: str) -> tuple[daily.Paths, DataFrame]:
    P = _silver_in_storage(L, name)
    daily.silver_to_serving(L.spark, P, None)
    return P, daily.read_serving(L.spark, P)


@register("fact_sales_incremental", w("SELECT * FROM f_sales"))
def q_fact_sales_incremental(L: Layers) -> DataFrame:
    P, serving = _serving_in_storage(L, "fact_sales_incremental")
    first = serving.where(F.col("event_date") <= F.lit(FIRST_BATCH_END).cast("date"))
    daily.fact_sales_incremental(L.spark, P.fact_sales, first)
    daily.fact_sales_incremental(L.spark, P.fact_sales, serving)
    return out(daily.read_fact(L.spark, P.fact_sales, "sale_date"))


_EARLY = f"CAST({{}}event_time AS DATE) <= DATE '{FIRST_BATCH_END}'"
_RECENT = "{}event_time >= (SELECT bound FROM hw)"
_BATCHES = {
    "b1": oracle.open_carts_sql("serving", _EARLY.format("c."), _EARLY.format("bought.")),
    "hw": "SELECT max(cart_time) - INTERVAL 2 DAY AS bound FROM b1",
    "b2": oracle.open_carts_sql("serving", _RECENT.format("c."), _RECENT.format("bought.")),
}
_MERGED = "SELECT * FROM b1 WHERE abandonment_id NOT IN (SELECT abandonment_id FROM b2) UNION ALL SELECT * FROM b2"
CARTS_INCREMENTAL_SQL = w(_MERGED, extra=_BATCHES)
CARTS_RETRACTED_SQL = w(f"""
    SELECT * FROM ({_MERGED}) m WHERE NOT (m.cart_time >= (SELECT bound FROM hw) AND EXISTS (
      FROM serving p WHERE p.event_type = 'purchase' AND p.event_time >= (SELECT bound FROM hw)
      AND p.user_session = m.user_session AND p.product_id = m.product_id))""", extra=_BATCHES)


@register("fact_cart_abandonment_incremental", CARTS_INCREMENTAL_SQL)
def q_fact_cart_abandonment_incremental(L: Layers) -> DataFrame:
    """Two loads; carts bought only in the later load stay (no retraction)."""
    P, serving = _serving_in_storage(L, "fact_cart_abandonment_incremental")
    first = serving.where(F.col("event_date") <= F.lit(FIRST_BATCH_END).cast("date"))
    daily.fact_cart_abandonment_incremental(L.spark, P.fact_carts, first)
    daily.fact_cart_abandonment_incremental(L.spark, P.fact_carts, serving)
    return out(daily.read_fact(L.spark, P.fact_carts, "cart_date"))


@register("fact_cart_abandonment_retracted", CARTS_RETRACTED_SQL)
def q_fact_cart_abandonment_retracted(L: Layers) -> DataFrame:
    """Two loads; carts of the window bought only in the later load go. The later load's
    own window is loaded with its days, then once more with nothing new."""
    P, serving = _serving_in_storage(L, "fact_cart_abandonment_retracted")
    first = serving.where(F.col("event_date") <= F.lit(FIRST_BATCH_END).cast("date"))
    daily.fact_cart_abandonment_incremental(L.spark, P.fact_carts, first)
    daily.fact_cart_abandonment_incremental(L.spark, P.fact_carts, serving, retract=True)
    return out(daily.read_fact(L.spark, P.fact_carts, "cart_date"))


# ---------------------------------------------------------------- KPIs and checks on stored tables


def stored_gold(L: Layers, name: str, only: tuple[str, ...] = ()) -> dict[str, DataFrame]:
    """Write serving, CRM, dimensions and facts (``only`` some of them) as tables
    (Gold is built from the *stored* serving table, as in production) and return
    them read back. KPIs and checks then scan stored tables with column pruning
    instead of re-deriving every layer."""
    P = workspace(L, name)
    tables.write_table(L.serving, P.serving)
    serving = tables.read_table(L.spark, P.serving)
    tables.write_table(schemas.enforced(L.crm, schemas.CRM, schemas.CRM_LENGTHS), P.crm)
    crm = tables.read_table(L.spark, P.crm)
    built = {
        "dim_users_loyalty": gold.dim_users_loyalty(serving, crm),
        "dim_products": gold.dim_products(serving),
        "fact_sales": gold.fact_sales(serving),
        "fact_cart_abandonment": gold.fact_cart_abandonment(serving),
    }
    out_tables = {"ecommerce_events": serving, "user_loyalty": crm}
    for t, df in ((t, df) for t, df in built.items() if not only or t in only):
        path = f"{P.root}/{t}"
        tables.write_table(df, path)
        out_tables[t] = tables.read_table(L.spark, path)
    return out_tables


@register("kpi_revenue", w(f"""
    SELECT coalesce({oracle.money('price')}, 0.0) AS revenue, CAST(count(*) AS BIGINT) AS items_sold
    FROM f_sales"""))
def q_kpi_revenue(L: Layers) -> DataFrame:
    return kpi.kpi_revenue(stored_gold(L, "kpi_revenue", ("fact_sales",))["fact_sales"])


@register("kpi_customers", w("SELECT CAST(count(*) AS BIGINT) AS total_customers FROM d_users_loyalty"))
def q_kpi_customers(L: Layers) -> DataFrame:
    return kpi.kpi_customers(stored_gold(L, "kpi_customers", ("dim_users_loyalty",))["dim_users_loyalty"])


@register("kpi_abandonment_rate", w("""
    SELECT a AS abandoned_carts, s AS purchased_sessions,
           CASE WHEN a + s > 0 THEN CAST(a AS DOUBLE) / CAST(a + s AS DOUBLE) * 100.0 ELSE 0.0 END
             AS abandonment_rate
    FROM (SELECT (SELECT CAST(count(*) AS BIGINT) FROM f_carts) AS a,
                 (SELECT CAST(count(DISTINCT user_session) AS BIGINT) FROM f_sales) AS s)"""))
def q_kpi_abandonment_rate(L: Layers) -> DataFrame:
    t = stored_gold(L, "kpi_abandonment_rate", ("fact_sales", "fact_cart_abandonment"))
    return kpi.kpi_abandonment_rate(t["fact_cart_abandonment"], t["fact_sales"])


@register("users_by_tier", w(
    "SELECT loyalty_tier, CAST(count(*) AS BIGINT) AS count FROM d_users_loyalty GROUP BY loyalty_tier"))
def q_users_by_tier(L: Layers) -> DataFrame:
    return kpi.users_by_tier(stored_gold(L, "users_by_tier", ("dim_users_loyalty",))["dim_users_loyalty"])


@register("users_by_channel", w(
    "SELECT acquisition_channel, CAST(count(*) AS BIGINT) AS count FROM d_users_loyalty "
    "GROUP BY acquisition_channel"))
def q_users_by_channel(L: Layers) -> DataFrame:
    return kpi.users_by_channel(stored_gold(L, "users_by_channel", ("dim_users_loyalty",))["dim_users_loyalty"])


@register("top_brands", w(f"""
    SELECT brand, {oracle.money('price')} AS sales, CAST(count(*) AS BIGINT) AS volume
    FROM f_sales GROUP BY brand ORDER BY sales DESC, brand ASC NULLS FIRST LIMIT {kpi.TOP_BRANDS}"""))
def q_top_brands(L: Layers) -> DataFrame:
    return kpi.top_brands(stored_gold(L, "top_brands", ("fact_sales",))["fact_sales"])


register("dq_not_null", w(catalog.SQL_NOT_NULL))(lambda L: checks.dq_not_null(stored_gold(L, "dq_not_null")))
register("dq_unique", w(catalog.SQL_UNIQUE))(lambda L: checks.dq_unique(stored_gold(L, "dq_unique")))
register("dq_referential", w(catalog.SQL_REFERENTIAL))(
    lambda L: checks.dq_referential(stored_gold(L, "dq_referential")))
register("dq_report", w(f"{catalog.SQL_NOT_NULL}\nUNION ALL {catalog.SQL_UNIQUE}\nUNION ALL {catalog.SQL_REFERENTIAL}"))(
    lambda L: checks.dq_report(stored_gold(L, "dq_report")))


# ---------------------------------------------------------------- states by day, sketches, names


def _serving_by_day(L: Layers, name: str) -> tuple[daily.Paths, DataFrame, list[str]]:
    P, serving = _serving_in_storage(L, name)
    return P, serving, [d for d in tables.list_partitions(L.spark, P.serving, "event_date") if d != tables.NULL_PARTITION]


def _by_weeks(state: states.DayState, serving: DataFrame, days: list[str]) -> None:
    """Load the days week by week, the last day of each again with the next; fold the first half."""
    for k in range(0, len(days), 7):
        state.update(serving, days[max(0, k - 1):k + 7])
        if k == 14:
            state.fold(days[k - 2])


@register("dim_users_incremental", w("SELECT * FROM d_users"))
def q_dim_users_incremental(L: Layers) -> DataFrame:
    """The user dimension from visits by day: every day is loaded by itself, some twice."""
    P, serving, days = _serving_by_day(L, "dim_users_incremental")
    state = states.DayState(L.spark, P.visits, states.VISITS)
    _by_weeks(state, serving, days)
    return out(states.dim_users(state))


@register("dim_users_loyalty_incremental", w("SELECT * FROM d_users_loyalty"))
def q_dim_users_loyalty_incremental(L: Layers) -> DataFrame:
    P, serving, days = _serving_by_day(L, "dim_users_loyalty_incremental")
    state = states.DayState(L.spark, P.visits, states.VISITS)
    _by_weeks(state, serving, days)
    return out(states.dim_users_loyalty(state, L.crm))


@register("dim_products_incremental", w("SELECT * FROM d_products"))
def q_dim_products_incremental(L: Layers) -> DataFrame:
    P, serving, days = _serving_by_day(L, "dim_products_incremental")
    state = states.DayState(L.spark, P.products, states.PRODUCTS)
    _by_weeks(state, serving, days)
    return states.dim_products(state)


@register("kpi_sessions_sketch", w("""
    SELECT CAST(date_trunc('week', event_time) AS DATE) AS week, CAST(count(DISTINCT user_session) AS BIGINT) AS sessions, true AS close
    FROM f_sales GROUP BY ALL
    UNION ALL SELECT NULL, CAST(count(DISTINCT user_session) AS BIGINT), true FROM f_sales"""))
def q_kpi_sessions_sketch(L: Layers) -> DataFrame:
    """Purchasing sessions by week and over all weeks (null) from one sketch a day, beside the exact
    count; ``close``: the estimate is within four standard errors of it, and one session."""
    P, serving, days = _serving_by_day(L, "kpi_sessions_sketch")
    bought = serving.where("event_type = 'purchase'")
    for part in (days[:10], days[8:]):
        sketches.update_sketches(L.spark, P.session_sketches, bought, "user_session", "event_date", part)
    kept = tables.read_table(L.spark, P.session_sketches).withColumn("week", F.date_trunc("week", "event_date").cast("date"))
    whole = sketches.merged_count(kept).select(F.lit(None).cast("date").alias("week"), "estimate")
    told = sketches.merged_count(kept, "week").unionByName(whole)
    exact = bought.groupBy(F.date_trunc("week", "event_time").cast("date").alias("week")).agg(F.countDistinct("user_session").alias("sessions"))
    exact = exact.unionByName(bought.agg(F.lit(None).cast("date").alias("week"), F.countDistinct("user_session").alias("sessions")))
    both = exact.withColumnRenamed("week", "_w").join(told, F.col("_w").eqNullSafe(F.col("week")))
    near = F.abs(F.col("estimate") - F.col("sessions")) <= F.lit(4 * sketches.relative_error()) * F.col("sessions") + 1
    return both.select("week", "sessions", near.alias("close"))


@register("silver_enriched_hot", w("SELECT * FROM silver"))
def q_silver_enriched_hot(L: Layers) -> DataFrame:
    """Silver with the users of a hundredth of the rows or more, as a sketch finds them, joined apart."""
    hot = hot_keys.hot_keys(silver_plan.silver_clean(L.raw), "user_id", 0.01)
    return out(silver_plan.silver_parts(L.raw, L.crm, hot_users=hot)[1])


@register("gold_by_name", w("""
    SELECT CAST(s.event_time AS DATE) AS day, p.category, u.loyalty_tier, CAST(count(*) AS BIGINT) AS sales,
           CAST(sum(CAST(s.price AS DECIMAL(38,10))) AS DOUBLE) AS revenue
    FROM f_sales s JOIN d_products p USING (product_id) JOIN d_users_loyalty u ON u.user_id = s.user_id
    WHERE s.event_time >= TIMESTAMP '2024-01-08' GROUP BY ALL"""))
def q_gold_by_name(L: Layers) -> DataFrame:
    """Plain SQL over tables of the catalogue: names, partitions and statistics, no path."""
    P, serving = _serving_in_storage(L, "gold_by_name")
    rows = serving.drop("event_date")
    daily.build_dims(L.spark, P, rows, L.crm)
    daily.fact_sales_incremental(L.spark, P.fact_sales, rows)
    db = f"strata_{P.root.rsplit('-', 1)[-1]}"  # a database for each run
    named.declare(L.spark, db, "fact_sales", P.fact_sales, daily.FACT_SCHEMAS["sale_date"], "sale_date")
    named.declare(L.spark, db, "dim_products", P.dim_products, schemas.DIM_PRODUCTS)
    named.declare(L.spark, db, "dim_users_loyalty", P.dim_users_loyalty, schemas.DIM_USERS_LOYALTY)
    return L.spark.sql(f"""
        SELECT s.sale_date AS day, p.category, u.loyalty_tier, count(*) AS sales,
               CAST(sum(CAST(s.price AS DECIMAL(38,10))) AS DOUBLE) AS revenue
        FROM {db}.fact_sales s JOIN {db}.dim_products p ON p.product_id = s.product_id
        JOIN {db}.dim_users_loyalty u ON u.user_id = s.user_id
        WHERE s.sale_date >= DATE '2024-01-08' GROUP BY s.sale_date, p.category, u.loyalty_tier""")


# ---------------------------------------------------------------- published versions


@register("gold_published", w("""
    SELECT 'fact_sales' AS name, sale_id AS key, CAST(price AS VARCHAR) AS value FROM f_sales
    UNION ALL SELECT 'fact_cart_abandonment', abandonment_id, loyalty_tier FROM f_carts
    UNION ALL SELECT 'dim_products', CAST(product_id AS VARCHAR), category FROM d_products
    UNION ALL SELECT 'dim_users', CAST(user_id AS VARCHAR), CAST(total_sessions AS VARCHAR) FROM d_users
    UNION ALL SELECT 'dim_users_loyalty', CAST(user_id AS VARCHAR), loyalty_tier FROM d_users_loyalty"""))
def q_gold_published(L: Layers) -> DataFrame:
    """Gold published twice, then a draft with a broken dimension that its checks stop: what
    is read is the second version, its facts made of days of both."""
    P, serving = _serving_in_storage(L, "gold_published")
    tables.write_table(schemas.enforced(L.crm, schemas.CRM, schemas.CRM_LENGTHS), P.crm)
    crm, store = tables.read_table(L.spark, P.crm), publish.GoldStore(L.spark, P.gold)
    rows = serving.drop("event_date")

    def audit(draft: publish.Draft) -> DataFrame:
        return checks.dq_report({"ecommerce_events": rows, "user_loyalty": crm, **{
            n: draft.read(n) for n in ("dim_users_loyalty", "dim_products", "fact_sales", "fact_cart_abandonment")}})

    first = serving.where(F.col("event_date") <= F.lit(FIRST_BATCH_END).cast("date")).drop("event_date")
    publish.build(store, first, crm).publish(audit)
    draft = publish.build(store, rows, crm)
    # Carts whose purchase came later than the lookback are judged again.
    draft.load("fact_cart_abandonment", lambda path: daily.fact_cart_abandonment_incremental(
        L.spark, path, rows, full_refresh=True), full_refresh=True)
    draft.publish(audit)
    broken = store.draft()
    broken.write("dim_products", store.read("dim_products").where("product_id % 2 = 0"))
    try:
        broken.publish(audit)
    except AssertionError:
        pass
    else:
        raise RuntimeError("a broken draft passed its checks")
    shown = {"fact_sales": ("sale_id", "price"), "fact_cart_abandonment": ("abandonment_id", "loyalty_tier"),
             "dim_products": ("product_id", "category"), "dim_users": ("user_id", "total_sessions"),
             "dim_users_loyalty": ("user_id", "loyalty_tier")}
    parts = [store.read(n).select(F.lit(n).alias("name"), F.col(k).cast("string").alias("key"), F.col(v).cast("string").alias("value"))
             for n, (k, v) in shown.items()]
    return reduce(DataFrame.unionByName, parts)


# ---------------------------------------------------------------- streaming


@register("stream_silver", w("SELECT * FROM silver"))
def q_stream_silver(L: Layers) -> DataFrame:
    """Bronze files picked up by a file stream, a few day files per
    micro-batch, each upserted into Silver."""
    P = workspace(L, "stream_silver")
    stage(L, P)
    silver_stream.stream_silver(L.spark, P.staging, P, L.crm, STAGED_WITH_ID, P.stream_checkpoint,
                                max_files_per_trigger=8)
    return out(daily.read_silver(L.spark, P))


@register("stream_landing", w(STAGED_SQL))
def q_stream_landing(L: Layers) -> DataFrame:
    """Landing files in two drops, each picked up by the file stream when it is there."""
    P = workspace(L, "stream_landing")
    land(L, P)
    files = csv_src.landing_files(L.spark, P.landing)
    fs, _, jvm = tables._fs(L.spark, P.landing)
    for drop in (files[::2], files[1::2]):
        for f in drop:  # a folder per period, as they were landed
            folder, name = f.rsplit("/", 2)[-2:]
            target = jvm.org.apache.hadoop.fs.Path(f"{P.drops}/{folder}/{name}")
            fs.mkdirs(target.getParent())
            fs.rename(jvm.org.apache.hadoop.fs.Path(f), target)
        landing_stream.stage_landing(L.spark, P.drops, P.staging, P.stream_checkpoint, RAW_WITH_ID)
    return landing_stream.read_staged(L.spark, P.staging, RAW_WITH_ID)


@register("stream_dedup", w("SELECT * FROM deduped"))
def q_stream_dedup(L: Layers) -> DataFrame:
    """Day files written by several tasks, found in no order of time."""
    P = workspace(L, "stream_dedup")
    stage(L, P)
    staged_table(L, P.staging).repartition(4, F.xxhash64("event_id")).write.partitionBy(*bronze_src.PARTS).parquet(P.bronze)
    silver_stream.stream_dedup(L.spark, P.bronze, P.dedup, STAGED_WITH_ID, P.stream_checkpoint,
                               max_files_per_trigger=40)
    return out(tables.read_table(L.spark, P.dedup))


_WATERMARK_AT = "(SELECT max(event_time) - INTERVAL 2 DAY FROM cleaned WHERE event_date <= DATE '2024-01-25')"


@register("stream_dedup_watermark", w(f"""
    SELECT 'read' AS rows, CAST(count(*) FILTER (event_date <= DATE '2024-01-25') + count(*) FILTER (event_date >= DATE '2024-01-15') AS BIGINT) AS n FROM cleaned
    UNION ALL SELECT 'late', CAST(count(*) AS BIGINT) FROM cleaned WHERE event_date >= DATE '2024-01-15' AND event_time <= {_WATERMARK_AT}
    UNION ALL SELECT 'written', CAST(count(*) AS BIGINT) FROM deduped
    UNION ALL SELECT 'duplicates', CAST((SELECT count(*) FROM cleaned WHERE event_date <= DATE '2024-01-25')
      + (SELECT count(*) FROM cleaned WHERE event_date >= DATE '2024-01-15' AND event_time > {_WATERMARK_AT}) - (SELECT count(*) FROM deduped) AS BIGINT)
    """))
def q_stream_dedup_watermark(L: Layers) -> DataFrame:
    """Two drops of day files that overlap by ten days into one deduplicating stream: rows of
    the second drop behind the watermark are late, the others of the overlap duplicates."""
    P = workspace(L, "stream_dedup_watermark")
    stage(L, P)
    days, counts = bronze_src.staged_days(L.spark, P.staging), {"read": 0, "late": 0, "written": 0, "duplicates": 0}
    for drop, (first, last) in enumerate([(None, "2024-01-25"), ("2024-01-15", None)]):
        rows = bronze_src.scan_days(L.spark, P.staging, _days(first, last, days), STAGED_WITH_ID)
        rows.write.mode("append").partitionBy(*bronze_src.PARTS).parquet(P.bronze)
        got = silver_stream.stream_dedup_watermark(L.spark, P.bronze, P.dedup, STAGED_WITH_ID, P.stream_checkpoint)
        counts = {k: n + got.get(k, 0) for k, n in counts.items()}
        counts["read"] += sum(got.values())
    stored = tables.read_table(L.spark, P.dedup).agg(F.lit("written").alias("rows"), F.count(F.lit(1)).alias("n"))
    told = L.spark.createDataFrame([(k, n) for k, n in counts.items() if k != "written"], "rows string, n bigint")
    return told.unionByName(stored)


@register("stream_quarantine", w(f"SELECT {RAW_SELECT}, CAST(strptime(event_time, '%Y-%m-%d %H:%M:%S UTC') AS DATE) "
                                 f"AS run_date FROM quarantined WHERE {DATED}"))
def q_stream_quarantine(L: Layers) -> DataFrame:
    """The quarantine of a stream whose days are split over many micro-batches."""
    P = workspace(L, "stream_quarantine")
    stage(L, P)
    # Several files a day, found in no order of time.
    staged_table(L, P.staging).repartition(6, F.xxhash64("event_id")).write.partitionBy(*bronze_src.PARTS).parquet(P.bronze)
    silver_stream.stream_silver(L.spark, P.bronze, P, L.crm, STAGED_WITH_ID, P.stream_checkpoint, max_files_per_trigger=40)
    return tables.read_table(L.spark, P.quarantine_stream).drop("batch_id")


@register("stream_cart_abandonment", w("SELECT * FROM f_carts"))
def q_stream_cart_abandonment(L: Layers) -> DataFrame:
    """Carts and purchases in day files of several tasks, found in no order of time, joined
    as streams; sessions last a month, so rows may come a month late and still count."""
    P = workspace(L, "stream_cart_abandonment")
    stage(L, P)
    staged = staged_table(L, P.staging)
    staged.repartition(4, F.xxhash64("event_id")).write.partitionBy(*bronze_src.PARTS).parquet(P.bronze)
    last = staged.agg(F.max(F.try_to_timestamp(F.substring("event_time", 1, 19)))).first()[0]
    closing = cart_stream.closing_events(L.spark, STAGED_WITH_ID, last, delay=cart_stream.HORIZON)
    closing.write.mode("append").partitionBy(*bronze_src.PARTS).parquet(P.bronze)
    got = cart_stream.stream_cart_abandonment(L.spark, P.bronze, P.fact_carts, L.crm, STAGED_WITH_ID, P.stream_checkpoint,
                                              delay=cart_stream.HORIZON, max_files_per_trigger=50)
    if got["late"]:
        raise RuntimeError(f"{got['late']} rows came behind the watermark")
    return out(cart_stream.read_stream_fact(L.spark, P.fact_carts))


STORAGE_QUERIES.update(set(QUERIES) - _BEFORE)
