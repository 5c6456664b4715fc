"""Map the provided tables (events, part, customer) to clickstream and CRM input.

The mapping is the one in FIXTURES.md: the same rules run here on Spark and,
as SQL text, in the DuckDB oracle (``strata.oracle``). It injects repeatable
faults (bad time text, NULL critical fields, exact copies, NULL brand and
session) so every cleaning branch is exercised.

Fixed values (must equal FIXTURES.md for identical rows on both engines):
  bad time text            event_id % 89 = 0  -> 'not-a-time'
  NULL event_type          event_id % 97 = 0
  NULL product_id          event_id % 101 = 0
  NULL brand               event_id % 7 = 0
  NULL price               event_id % 103 = 0
  NULL user_id             event_id % 107 = 0
  NULL user_session        event_id % 109 = 0
  exact second copy        event_id % 13 = 0
  product                  (user_id * 100 + first integer in props) % rows of part, joined to part.p_partkey
  category_code            p_partkey % 5: 0 -> NULL, 1 -> lower(p_type),
                           else lower(p_type) || '.' || second word of p_name
  event_type               'click' -> 'cart', 'purchase' -> 'purchase', else 'view'
  session                  user_id || '-' || first day of the event's month
  user unknown to the CRM  user_id % 10 = 9 -> user_id + 1000000000 (no such customer)
  loyalty_tier             MACHINERY VIP, BUILDING Gold, AUTOMOBILE Silver, else Regular
  signup_date              2018-01-01 + (c_custkey % 790) days
  acquisition_channel      c_nationkey % 6: Google, Facebook, Organic, TikTok,
                           Instagram, Referral
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHANNELS = ["Google", "Facebook", "Organic", "TikTok", "Instagram", "Referral"]


# Explicit input schemas: no footer-inference pass at plan time.
INPUT_SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
}

RAW_EXPRS = [
    "event_id",
    "CASE WHEN event_id % 89 = 0 THEN 'not-a-time' "
    "ELSE concat(substring(cast(ts AS string), 1, 19), ' UTC') END AS event_time",
    "CASE WHEN event_id % 97 = 0 THEN NULL WHEN event_type = 'click' THEN 'cart' "
    "WHEN event_type = 'purchase' THEN 'purchase' ELSE 'view' END AS event_type",
    "CASE WHEN event_id % 101 = 0 THEN NULL ELSE cast(p_partkey AS int) END AS product_id",
    "cast(p_size AS string) AS category_id",
    "CASE p_partkey % 5 WHEN 0 THEN NULL WHEN 1 THEN lower(p_type) "
    "ELSE concat(lower(p_type), '.', split_part(p_name, ' ', 2)) END AS category_code",
    "CASE WHEN event_id % 7 = 0 THEN NULL ELSE lower(p_brand) END AS brand",
    "CASE WHEN event_id % 103 = 0 THEN NULL ELSE value END AS price",
    "CASE WHEN event_id % 107 = 0 THEN NULL WHEN user_id % 10 = 9 THEN cast(user_id + 1000000000 AS int) "
    "ELSE cast(user_id AS int) END AS user_id",
    "CASE WHEN event_id % 109 = 0 THEN NULL "
    "ELSE concat(cast(user_id AS string), '-', cast(cast(date_trunc('month', ts) AS date) AS string)) END "
    "AS user_session",
]

CRM_EXPRS = [
    "cast(c_custkey AS int) AS user_id",
    "CASE c_mktsegment WHEN 'MACHINERY' THEN 'VIP' WHEN 'BUILDING' THEN 'Gold' "
    "WHEN 'AUTOMOBILE' THEN 'Silver' ELSE 'Regular' END AS loyalty_tier",
    "date_add(DATE'2018-01-01', cast(c_custkey % 790 AS int)) AS signup_date",
    "CASE c_nationkey % 6 WHEN 0 THEN 'Google' WHEN 1 THEN 'Facebook' WHEN 2 THEN 'Organic' "
    "WHEN 3 THEN 'TikTok' WHEN 4 THEN 'Instagram' ELSE 'Referral' END AS acquisition_channel",
]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read
    if name in INPUT_SCHEMAS:
        reader = reader.schema(INPUT_SCHEMAS[name])
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def raw_clickstream(events: DataFrame, part: DataFrame) -> DataFrame:
    """Clickstream rows with text times, as a landing CSV would carry them."""
    products = part.count()  # from the file footers; part keys run from 0
    ev = events.selectExpr("event_id", "ts", "user_id", "event_type", "value",
                           "(user_id * 100 + try_cast(regexp_extract(props, '[0-9]+', 0) AS bigint)) "
                           f"% {max(products, 1)} AS _pk")
    parts = part.select("p_partkey", "p_name", "p_brand", "p_type", "p_size")
    j = ev.join(parts, F.expr("_pk = p_partkey"), "inner")
    # Exact second copy of every 13th event: a generator, not a join.
    j = j.selectExpr("*", "explode(CASE WHEN event_id % 13 = 0 THEN array(0, 1) ELSE array(0) END) AS _copy")
    return j.selectExpr(*RAW_EXPRS)


def user_loyalty(customer: DataFrame) -> DataFrame:
    """CRM table: one row per customer (user_id unique)."""
    return customer.selectExpr(*CRM_EXPRS)


def load(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(raw clickstream, CRM) from a scale-factor folder."""
    events = read_table(spark, sf_dir, "events")
    part = read_table(spark, sf_dir, "part")
    customer = read_table(spark, sf_dir, "customer")
    return raw_clickstream(events, part), user_loyalty(customer)
