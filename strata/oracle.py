"""DuckDB SQL oracle: for each registered query, an independent SQL text that
computes the same result from the provided tables (pre-registered views
``events``, ``part``, ``customer``, ...).

The CTE chain mirrors the data layers: fixture mapping → parse → clean →
dedup → enrich (Silver) → serving → Gold. Facts number their rows by ordered
lists, dimensions add up per-session rows, carts use NOT EXISTS: other ways to
the results than the Spark plans take.
"""

from __future__ import annotations

from strata.fixtures import CHANNELS
from strata.functions.buckets import TWO_POW_32

RAW_CLICKSTREAM = """
SELECT event_id, event_time, event_type, product_id, category_id, category_code, brand, price, user_id, user_session FROM (
  SELECT e.event_id,
    CASE WHEN e.event_id % 89 = 0 THEN 'not-a-time' ELSE substring(cast(e.ts AS string),1,19) || ' UTC' END AS event_time,
    CASE WHEN e.event_id % 97 = 0 THEN NULL WHEN e.event_type = 'click' THEN 'cart' WHEN e.event_type = 'purchase' THEN 'purchase' ELSE 'view' END AS event_type,
    CASE WHEN e.event_id % 101 = 0 THEN NULL ELSE cast(p.p_partkey AS int) END AS product_id,
    cast(p.p_size AS string) AS category_id,
    CASE p.p_partkey % 5 WHEN 0 THEN NULL WHEN 1 THEN lower(p.p_type) ELSE lower(p.p_type) || '.' || split_part(p.p_name,' ',2) END AS category_code,
    CASE WHEN e.event_id % 7 = 0 THEN NULL ELSE lower(p.p_brand) END AS brand,
    CASE WHEN e.event_id % 103 = 0 THEN NULL ELSE e.value END AS price,
    CASE WHEN e.event_id % 107 = 0 THEN NULL WHEN e.user_id % 10 = 9 THEN cast(e.user_id + 1000000000 AS int) ELSE cast(e.user_id AS int) END AS user_id,
    CASE WHEN e.event_id % 109 = 0 THEN NULL ELSE cast(e.user_id AS string) || '-' || cast(cast(date_trunc('month', e.ts) AS date) AS string) END AS user_session
  FROM events e
  JOIN part p ON p.p_partkey = (e.user_id * 100 + cast(regexp_extract(e.props,'[0-9]+',0) AS bigint)) % (SELECT count(*) FROM part)
  JOIN (SELECT 0 AS copy UNION ALL SELECT 1 AS copy) d ON d.copy = 0 OR e.event_id % 13 = 0
) x
"""

USER_LOYALTY = """
SELECT cast(c_custkey AS int) AS user_id,
  CASE c_mktsegment WHEN 'MACHINERY' THEN 'VIP' WHEN 'BUILDING' THEN 'Gold' WHEN 'AUTOMOBILE' THEN 'Silver' ELSE 'Regular' END AS loyalty_tier,
  date '2018-01-01' + cast(c_custkey % 790 AS int) AS signup_date,
  CASE c_nationkey % 6 WHEN 0 THEN 'Google' WHEN 1 THEN 'Facebook' WHEN 2 THEN 'Organic' WHEN 3 THEN 'TikTok' WHEN 4 THEN 'Instagram' ELSE 'Referral' END AS acquisition_channel
FROM customer
"""

RAW_COLS = ("event_id, event_time, event_type, product_id, category_id, category_code, "
            "brand, price, user_id, user_session")
SILVER_COLS = ("user_id, event_time, event_type, product_id, category_id, brand, price, user_session, "
               "event_date, category, sub_category, loyalty_tier, acquisition_channel, event_id")
SERVING_COLS = ("user_id, event_type, product_id, category, sub_category, brand, price, user_session, "
                "event_time, loyalty_tier, acquisition_channel, event_id")

def open_carts_sql(source: str, cart_rows: str = "true", purchase_rows: str = "true") -> str:
    """Carts of ``source`` without a purchase of the same session and product; each
    filter restricts the rows that count as carts or as purchases."""
    return f"""
        SELECT md5(array_to_string([coalesce(user_session, ''), coalesce(product_id::VARCHAR, ''),
                   strftime(cart_time, '%Y-%m-%d %H:%M:%S'), place::VARCHAR], '-')) AS abandonment_id,
               left_.user AS user_id, user_session, product_id, left_.brand AS brand, left_.price AS price, cart_time,
               left_.tier AS loyalty_tier, left_.channel AS acquisition_channel
        FROM (
          SELECT user_session, product_id, cart_time, unnest(items) AS left_, generate_subscripts(items, 1) AS place
          FROM (
            SELECT c.user_session, c.product_id, c.event_time AS cart_time,
                   list({{'user': c.user_id, 'brand': c.brand, 'price': c.price,
                         'tier': coalesce(c.loyalty_tier, 'Regular'),
                         'channel': coalesce(c.acquisition_channel, 'Organic')}} ORDER BY c.event_id) AS items
            FROM {source} c
            WHERE c.event_type = 'cart' AND {cart_rows} AND NOT EXISTS (
              FROM {source} bought WHERE bought.event_type = 'purchase' AND {purchase_rows}
              AND bought.user_session = c.user_session AND bought.product_id = c.product_id)
            GROUP BY ALL))"""


CTES = {
    "raw_clickstream": RAW_CLICKSTREAM,
    "user_loyalty": USER_LOYALTY,
    "parsed": f"""
        SELECT {RAW_COLS}, try_strptime(event_time, '%Y-%m-%d %H:%M:%S UTC') AS ts_parsed
        FROM raw_clickstream""",
    "quarantined": f"""
        SELECT {RAW_COLS} FROM parsed
        WHERE ts_parsed IS NULL OR event_type IS NULL OR user_id IS NULL OR product_id IS NULL OR price IS NULL""",
    "cleaned": """
        SELECT event_id, ts_parsed AS event_time, event_type, product_id, category_id,
               coalesce(brand, 'unknown') AS brand, price, user_id, user_session,
               CAST(ts_parsed AS DATE) AS event_date,
               coalesce(string_split(category_code, '.')[1], 'unknown') AS category,
               coalesce(string_split(category_code, '.')[2], 'unknown') AS sub_category
        FROM parsed
        WHERE ts_parsed IS NOT NULL AND event_type IS NOT NULL AND user_id IS NOT NULL
          AND product_id IS NOT NULL AND price IS NOT NULL""",
    "deduped": """
        SELECT * EXCLUDE (rn) FROM (
          SELECT *, row_number() OVER (PARTITION BY user_session, event_time, product_id, event_type
                                       ORDER BY event_id) AS rn
          FROM cleaned) WHERE rn = 1""",
    "silver": """
        SELECT d.user_id, d.event_time, d.event_type, d.product_id, d.category_id, d.brand, d.price,
               d.user_session, d.event_date, d.category, d.sub_category,
               coalesce(l.loyalty_tier, 'Regular') AS loyalty_tier,
               coalesce(l.acquisition_channel, 'Organic') AS acquisition_channel, d.event_id
        FROM deduped d LEFT JOIN user_loyalty l ON d.user_id = l.user_id""",
    "serving": f"SELECT {SERVING_COLS} FROM silver WHERE event_type <> 'view'",
    "f_sales": """
        SELECT md5(array_to_string([strftime(event_time, '%Y-%m-%d %H:%M:%S'), coalesce(user_id::VARCHAR, ''),
                   coalesce(product_id::VARCHAR, ''), coalesce(user_session, ''), place::VARCHAR], '-')) AS sale_id,
               event_time, user_id, product_id, sold.brand AS brand, sold.price AS price, user_session,
               sold.tier AS loyalty_tier, sold.channel AS acquisition_channel
        FROM (
          SELECT event_time, user_id, product_id, user_session, unnest(items) AS sold,
                 generate_subscripts(items, 1) AS place
          FROM (
            SELECT event_time, user_id, product_id, user_session,
                   list({'brand': brand, 'price': price, 'tier': coalesce(loyalty_tier, 'Regular'),
                         'channel': coalesce(acquisition_channel, 'Organic')} ORDER BY event_id) AS items
            FROM serving WHERE event_type = 'purchase' GROUP BY ALL))""",
    "f_carts": open_carts_sql("serving"),
    "visits": """
        SELECT user_id, user_session, min(event_time) AS began, max(event_time) AS ended
        FROM serving GROUP BY user_id, user_session""",
    "d_users": """
        SELECT user_id, count(user_session)::BIGINT AS total_sessions, min(began) AS first_seen, max(ended) AS last_seen
        FROM visits GROUP BY user_id HAVING user_id IS NOT NULL""",
    "d_products": """
        SELECT product_id, top.a AS category, top.b AS sub_category, top.c AS brand
        FROM (SELECT product_id, max({'a': coalesce(category, ''), 'b': coalesce(sub_category, ''),
                                      'c': coalesce(brand, '')}) AS top
              FROM serving GROUP BY product_id) WHERE product_id IS NOT NULL""",
    "d_users_loyalty": """
        SELECT active.*, crm.loyalty_tier, crm.signup_date, crm.acquisition_channel
        FROM (SELECT user_id, count(user_session)::BIGINT AS total_sessions, min(began) AS first_active_time,
                     max(ended) AS last_active_time FROM visits GROUP BY user_id) active
        LEFT JOIN user_loyalty crm USING (user_id)""",
}


def with_ctes(select: str, extra: dict[str, str] | None = None) -> str:
    parts = dict(CTES)
    parts.update(extra or {})
    body = ",\n".join(f"{name} AS ({sql})" for name, sql in parts.items())
    return f"WITH {body}\n{select}"


def money(c: str) -> str:
    return f"CAST(sum(CAST({c} AS DECIMAL(38,10))) AS DOUBLE)"


def hash_fraction_sql(key: str, salt: str) -> str:
    return (f"CAST(('0x' || substring(md5('{salt}' || CAST({key} AS VARCHAR)), 1, 8)) AS BIGINT)"
            f" / {TWO_POW_32!r}")


def bucket_sql(key: str, labels: list[str], bounds: list[float], salt: str) -> str:
    u = hash_fraction_sql(key, salt)
    whens = " ".join(f"WHEN {u} < {b!r} THEN '{lab}'" for lab, b in zip(labels[:-1], bounds[:-1]))
    return f"CASE {whens} ELSE '{labels[-1]}' END"


def channel_list() -> list[str]:
    return list(CHANNELS)
