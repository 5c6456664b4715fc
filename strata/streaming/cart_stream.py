"""Cart abandonment as a stream: an outer stream-stream join with bounded state.

Events arrive as files in any order that the watermark allows. Carts are joined (left
outer) with the purchases of the same session and product at most ``horizon`` before or
after them. Spark keeps both sides in its state store and drops a cart once the watermark
has passed its time plus ``horizon``; a cart that met no purchase until then leaves the
join without one: it is abandoned, and final. A purchase leaves the state likewise.

* A cart without a session can never be bought, yet it waits for its time as well. Such
  carts are keyed by their product and time, so they don't gather in one partition.
* Carts of one (session, product, time) are decided by the same batch, because only their
  time decides when. So deduplication and the ordinal of the key are exact inside a batch.
* Each batch replaces the rows it wrote itself (a folder per batch), so a replayed batch
  changes nothing, and a decided cart is written once.
* The watermark follows the slowest of both sides; ``closing_events`` are a cart and a
  purchase of ``HEARTBEAT`` that move it on when a source falls silent.
* Rows the watermark drops as late are counted (``late.LateRows``).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators import tables
from strata.operators.clean import clean, dedup, parse
from strata.operators.enrich import enrich
from strata.operators.ordinal import ordinal
from strata.plans import daily, gold
from strata.streaming.late import LateRows, drain
from strata.streaming.silver_stream import bronze_stream

HEARTBEAT = "heartbeat"   # session and type of the closing events
DELAY = "2 days"          # how much later than the newest event a row may come
HORIZON = "31 days"       # how far apart a cart and its purchase may lie: a session's longest time
EVENT_KEYS = ["user_session", "cart_time", "product_id"]


def cart_events(raw: DataFrame, crm: DataFrame) -> DataFrame:
    """Valid carts with CRM attributes, as the fact's rows before their key (one row at a time, no state)."""
    rows = clean(parse(raw)).where("event_type = 'cart'")
    return gold.cart_rows(enrich(rows, crm))


def purchase_events(raw: DataFrame) -> DataFrame:
    """Sessions, products and times of valid purchases that have a session."""
    bought = clean(parse(raw)).where("event_type = 'purchase' AND user_session IS NOT NULL")
    return bought.selectExpr("user_session AS _p_session", "product_id AS _p_product", "event_time AS _p_time")


def undecided_join(carts: DataFrame, purchases: DataFrame, delay: str = DELAY, horizon: str = HORIZON) -> DataFrame:
    """The streaming join: every cart once with each purchase that cancels it, or once with none."""
    c = carts.withWatermark("cart_time", delay).withColumn(
        "_c_session", F.expr("coalesce(user_session, concat('\\0', product_id, '/', cart_time))"))
    p = purchases.withWatermark("_p_time", delay)
    on = F.expr(f"_c_session = _p_session AND product_id = _p_product AND _p_time >= cart_time - INTERVAL {horizon} "
                f"AND _p_time <= cart_time + INTERVAL {horizon}")
    return c.join(p, on, "left_outer").drop("_c_session", "_p_session", "_p_product")


def abandoned_rows(decided: DataFrame) -> DataFrame:
    """The fact's rows from the carts a batch decided."""
    extra = ["event_id"] if "event_id" in decided.columns else []
    open_carts = decided.where(f"_p_time IS NULL AND NOT user_session <=> '{HEARTBEAT}'").drop("_p_time")
    rows = ordinal(dedup(open_carts, keys=EVENT_KEYS, order_by=extra), gold.CART_KEYS, order_by=extra)
    return gold.keyed_carts(rows)


def closing_events(spark: SparkSession, schema: T.StructType, after: dt.datetime, delay: str = DELAY,
                   horizon: str = HORIZON) -> DataFrame:
    """A raw cart and purchase late enough that every event up to ``after`` is decided once
    they are read (with ``year``, ``month``, ``day`` where the schema has them)."""
    when = spark.range(1).select((F.lit(after) + F.expr(f"INTERVAL {delay} + INTERVAL {horizon} + INTERVAL 1 day")).alias("t"))
    text = when.select(F.date_format("t", "yyyy-MM-dd HH:mm:ss").alias("t"), F.explode(F.array(F.lit("cart"), F.lit("purchase"))).alias("type"))
    given = {"event_time": F.concat("t", F.lit(" UTC")), "event_type": F.col("type"), "user_session": F.lit(HEARTBEAT),
             "product_id": F.lit(0), "user_id": F.lit(0), "price": F.lit(0.0), "year": F.substring("t", 1, 4),
             "month": F.substring("t", 6, 2), "day": F.substring("t", 9, 2)}
    return text.select(*[given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields])


def stream_cart_abandonment(spark: SparkSession, bronze_root: str, out_path: str, crm: DataFrame, schema: T.StructType,
                            checkpoint: str, delay: str = DELAY, horizon: str = HORIZON,
                            max_files_per_trigger: int | None = None, timeout_s: float | None = None) -> dict:
    """Drain the files that are there into the fact of decided carts below ``out_path``
    (partitioned by ``batch_id``). Returns ``late``: rows dropped behind the watermark, and ``undecided``:
    the rows that both sides of the join still hold."""
    def source() -> DataFrame:
        return bronze_stream(spark, bronze_root, schema, max_files_per_trigger)

    joined = undecided_join(cart_events(source(), crm), purchase_events(source()), delay, horizon)

    def write(batch: DataFrame, batch_id: int) -> None:
        fact = abandoned_rows(batch).withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        tables.replace_partitions(batch.sparkSession, out_path, fact, "batch_id", owned=[batch_id], observe=False)

    with LateRows(spark) as late:
        query = joined.writeStream.outputMode("append").foreachBatch(write).option("checkpointLocation", checkpoint)
        drain(query.trigger(availableNow=True).start(), timeout_s)
    return {"late": late.dropped, "undecided": late.held}


def read_stream_fact(spark: SparkSession, path: str) -> DataFrame:
    schema = T.StructType(daily.FACT_SCHEMAS["cart_date"].fields[:-1] + [T.StructField("batch_id", T.LongType(), True)])
    return tables.read_table(spark, path, schema).drop("batch_id")
