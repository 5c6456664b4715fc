"""Skew-safe anti join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def anti_join(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``left`` with no ``right`` row equal on all ``keys`` (SQL ``=``).

    A left row with a NULL key can never match, but in the join it would hash to
    the one partition of the NULL key. Those rows take a branch of their own that
    joins and shuffles nothing; a hot complete key is left to AQE's skew join.
    ``right`` is reduced to its distinct complete keys first.
    """
    complete = " AND ".join(f"{k} IS NOT NULL" for k in keys)
    cols = left.columns
    r = right.where(complete).selectExpr(*[f"{k} AS _aj_{k}" for k in keys]).distinct()
    on = F.expr(" AND ".join(f"{k} = _aj_{k}" for k in keys))
    matched = left.where(complete).join(r, on, "left_anti").select(*cols)
    return matched.unionByName(left.where(f"NOT ({complete})"))
