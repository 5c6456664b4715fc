"""Table contracts (StructTypes) and ``conform``.

A contract is the column list, order and type a layer promises. ``conform``
selects and casts to it in one projection (no extra pass) and fails early on a
missing column, the DataFrame equivalent of ``CREATE TABLE IF NOT EXISTS``
with a fixed DDL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

S, I, D, L = T.StringType(), T.IntegerType(), T.DoubleType(), T.LongType()
TS, DT = T.TimestampType(), T.DateType()


def _struct(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


# Raw / Bronze clickstream: every field nullable, event_time still text.
RAW_CLICKSTREAM = _struct(
    ("event_time", S, True), ("event_type", S, True), ("product_id", I, True),
    ("category_id", S, True), ("category_code", S, True), ("brand", S, True),
    ("price", D, True), ("user_id", I, True), ("user_session", S, True),
)

# Staging / Bronze add the string partition keys taken from the time text.
STAGED_CLICKSTREAM = T.StructType(
    RAW_CLICKSTREAM.fields + [T.StructField(c, S, True) for c in ("year", "month", "day")])

CRM = _struct(
    ("user_id", I, False), ("loyalty_tier", S, False),
    ("signup_date", DT, False), ("acquisition_channel", S, False),
)

SILVER = _struct(
    ("user_id", I, True), ("event_time", TS, True), ("event_type", S, True),
    ("product_id", I, True), ("category_id", S, True), ("brand", S, True),
    ("price", D, True), ("user_session", S, True), ("event_date", DT, True),
    ("category", S, True), ("sub_category", S, True),
    ("loyalty_tier", S, True), ("acquisition_channel", S, True),
)

# What makes an event (its time, type, user, product and price) is never NULL.
SERVING = _struct(
    ("user_id", I, False), ("event_type", S, False), ("product_id", I, False),
    ("category", S, True), ("sub_category", S, True), ("brand", S, True),
    ("price", D, False), ("user_session", S, True), ("event_time", TS, False),
    ("loyalty_tier", S, True), ("acquisition_channel", S, True),
)

DIM_USERS = _struct(("user_id", I, True), ("total_sessions", L, False),
                    ("first_seen", TS, True), ("last_seen", TS, True))

DIM_PRODUCTS = _struct(("product_id", I, True), ("category", S, True),
                       ("sub_category", S, True), ("brand", S, True))

DIM_USERS_LOYALTY = _struct(
    ("user_id", I, True), ("loyalty_tier", S, True), ("signup_date", DT, True),
    ("acquisition_channel", S, True), ("total_sessions", L, False),
    ("first_active_time", TS, True), ("last_active_time", TS, True),
)

FACT_SALES = _struct(
    ("sale_id", S, True), ("event_time", TS, True), ("user_id", I, True),
    ("product_id", I, True), ("brand", S, True), ("price", D, True),
    ("user_session", S, True), ("loyalty_tier", S, True), ("acquisition_channel", S, True),
)

FACT_CART_ABANDONMENT = _struct(
    ("abandonment_id", S, True), ("user_id", I, True), ("user_session", S, True),
    ("product_id", I, True), ("brand", S, True), ("price", D, True),
    ("cart_time", TS, True), ("loyalty_tier", S, True), ("acquisition_channel", S, True),
)

DQ_RESULT = _struct(("table", S, False), ("column", S, False),
                    ("check", S, False), ("failures", L, False))


# Longest texts of the contracts' text columns (fixed values).
CRM_LENGTHS = {"loyalty_tier": 20, "acquisition_channel": 50}
SERVING_LENGTHS = {"event_type": 20, "category": 100, "sub_category": 100, "brand": 100, "user_session": 50,
                   "loyalty_tier": 20, "acquisition_channel": 50}


def enforced(df: DataFrame, schema: T.StructType, lengths: dict[str, int] | None = None,
             keep_extra: list[str] | None = None) -> DataFrame:
    """``conform``, and the job fails on a NULL in a column the contract declares not
    nullable or on a text longer than ``lengths`` allows (checked row by row while the
    rows are written, no extra pass). Keys are checked by ``quality.unique``."""
    lengths = lengths or {}
    out = []
    for f in schema.fields:
        col, value = F.col(f.name), F.col(f.name)
        if f.name in lengths:
            said = F.lit(f"contract: {f.name} is longer than {lengths[f.name]}")
            value = F.when(F.length(col) > lengths[f.name], F.raise_error(said).cast(f.dataType)).otherwise(value)
        if not f.nullable:
            value = F.when(col.isNull(), F.raise_error(F.lit(f"contract: {f.name} is NULL")).cast(f.dataType)).otherwise(value)
        out.append(value.alias(f.name))
    rows = conform(df, schema, keep_extra)
    return rows.select(*out, *[c for c in (keep_extra or []) if c in rows.columns])


def conform(df: DataFrame, schema: T.StructType, keep_extra: list[str] | None = None) -> DataFrame:
    """Project ``df`` onto ``schema`` (order + types); raise if a column is missing.

    ``keep_extra`` names columns outside the contract to carry along at the end
    (e.g. a lineage id used as a deterministic tie-break).
    """
    have = dict(df.dtypes)
    missing = [f.name for f in schema.fields if f.name not in have]
    if missing:
        raise ValueError(f"missing columns for contract: {missing}")
    exprs = [f.name if have[f.name] == f.dataType.simpleString()
             else f"CAST({f.name} AS {f.dataType.simpleString()}) AS {f.name}" for f in schema.fields]
    exprs += [c for c in (keep_extra or []) if c in have]
    return df.selectExpr(*exprs)


def ntz(df: DataFrame) -> DataFrame:
    """Cast every TIMESTAMP (LTZ) column to TIMESTAMP_NTZ.

    Results compared with an engine whose TIMESTAMP has no zone are rendered as
    wall-clock values in the (UTC) session zone.
    """
    return df.selectExpr(*[f"CAST({name} AS timestamp_ntz) AS {name}" if t == "timestamp" else name
                           for name, t in df.dtypes])
