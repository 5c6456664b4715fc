"""Joins of a table whose hot keys a sketch finds.

``hot_keys`` runs a top-k sketch of bounded size over the key (one scan of one column,
merged map-side). Rows of a hot key are joined with the few right rows of those keys,
which are broadcast (as many as ``MOST`` at most); rows of a NULL key match nothing and
take a branch that joins nothing; the rest is joined as the planner likes, without
any key that would fill a partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MOST = 1000        # hot keys at most: bounds what is broadcast
TRACKED = 100_000  # keys the sketch counts at a time at most: bounds its memory


def hot_keys(df: DataFrame, key: str, share: float, most: int = MOST, tracked: int = TRACKED) -> list:
    """Keys that hold about ``share`` of the rows or more, the hottest first."""
    found = df.where(F.col(key).isNotNull()).agg(
        F.expr(f"approx_top_k({key}, {int(most)}, {int(tracked)})").alias("top"), F.count(F.lit(1)).alias("n")).first()
    return [t["item"] for t in found["top"] or [] if t["count"] >= share * found["n"]]


def left_join(left: DataFrame, right: DataFrame, key: str, hot: list) -> DataFrame:
    """``left.join(right, key, "left")`` with the ``hot`` keys apart. ``right`` has one row per key."""
    columns = [*left.columns, *[c for c in right.columns if c != key]]
    is_hot = F.col(key).isin(hot) if hot else F.lit(False)
    none = left.where(F.col(key).isNull())
    for f in right.schema.fields:
        if f.name != key:
            none = none.withColumn(f.name, F.lit(None).cast(f.dataType))
    rest = left.where(F.col(key).isNotNull() & ~is_hot).join(right, key, "left").select(*columns)
    out = rest.unionByName(none.select(*columns))
    if hot:
        few = F.broadcast(right.where(F.col(key).isin(hot)))
        out = out.unionByName(left.where(is_hot).join(few, key, "left").select(*columns))
    return out
