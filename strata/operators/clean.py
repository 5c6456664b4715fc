"""Bronze → Silver cleaning: parse, classify, quarantine, clean, dedup.

One parse feeds both branches (quarantine and clean) through a single
``is_valid`` column, so the validity rule is written once and the two outputs
are exact complements.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from strata.functions.parse import category_level_sql, parse_event_time_sql

# Fields whose NULL sends a row to quarantine, the dedup key,
# and the defaults for missing descriptive text.
CRITICAL = ["event_time_parsed", "event_type", "user_id", "product_id", "price"]
DEDUP_KEYS = ["user_session", "event_time", "product_id", "event_type"]
UNKNOWN = "unknown"
TEXT_DEFAULTS = {"brand": UNKNOWN, "category": UNKNOWN, "sub_category": UNKNOWN}


def _valid_sql() -> str:
    return " AND ".join(f"{c} IS NOT NULL" for c in CRITICAL)


def parse(raw: DataFrame) -> DataFrame:
    """Add the parsed time, its UTC date and the validity flag (one projection)."""
    return raw.selectExpr(
        "*", f"{parse_event_time_sql('event_time')} AS event_time_parsed",
        f"to_date({parse_event_time_sql('event_time')}) AS event_date",
    ).selectExpr("*", f"({_valid_sql()}) AS is_valid")


def quarantine(parsed: DataFrame) -> DataFrame:
    """Rows missing a critical field (or with unreadable time), raw columns."""
    keep = [c for c in parsed.columns if c not in ("event_time_parsed", "event_date", "is_valid")]
    return parsed.where("NOT is_valid").select(*keep)


def clean(parsed: DataFrame) -> DataFrame:
    """Valid rows with typed time, category split into two levels, defaults filled."""
    cols = parsed.columns
    exprs = []
    for c in cols:
        if c in ("event_time_parsed", "category_code", "is_valid"):
            continue
        if c == "event_time":
            exprs.append("event_time_parsed AS event_time")
        elif c in TEXT_DEFAULTS:
            exprs.append(f"coalesce({c}, '{TEXT_DEFAULTS[c]}') AS {c}")
        else:
            exprs.append(c)
    for level, name in ((0, "category"), (1, "sub_category")):
        exprs.append(f"coalesce({category_level_sql('category_code', level)}, '{TEXT_DEFAULTS[name]}') AS {name}")
    return parsed.where("is_valid").selectExpr(*exprs)


def dedup(df: DataFrame, keys: list[str] | None = None, order_by: list[str] | None = None) -> DataFrame:
    """One row per key (NULL keys compare equal); the survivor is the first by
    ``order_by`` then by every remaining column, so the result is deterministic.

    ``row_number() = 1`` is planned with a partial ``WindowGroupLimit`` before
    the shuffle: each map task forwards at most one row per key, so a key with
    huge numbers of copies is reduced map-side instead of landing in one task.
    """
    keys = keys or DEDUP_KEYS
    order = list(order_by or [])
    order += [c for c in df.columns if c not in keys and c not in order]
    rn = (f"row_number() OVER (PARTITION BY {', '.join(keys)} "
          f"ORDER BY {', '.join(f'{c} ASC NULLS FIRST' for c in order)}) AS _rn")
    cols = df.columns
    return df.selectExpr("*", rn).where("_rn = 1").select(*cols)
