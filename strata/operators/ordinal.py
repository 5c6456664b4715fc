"""Ordinal of a row among rows sharing a key: ``ROW_NUMBER()`` that feeds a
surrogate key and filters nothing.

One window, one shuffle on all of the keys: the rows are dealt out anew even if they
lie by one of them already, so a hot user's or session's rows, which a join before
gathered (and AQE split), are spread by time and product. Behind deduplication a whole
key has one row or a few.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def ordinal(df: DataFrame, keys: list[str], order_by: list[str] | None = None, name: str = "rn") -> DataFrame:
    """Add ``name`` = 1..n within each ``keys`` group, ordered by ``order_by``
    and then by every other column (a total order, so results are
    deterministic; identical rows are interchangeable)."""
    order = list(order_by or []) + [c for c in df.columns if c not in keys and c not in (order_by or [])]
    window = Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_first() for c in order])
    return df.repartition(*keys).withColumn(name, F.row_number().over(window).cast("bigint"))
