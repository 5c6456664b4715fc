"""Data-quality checks as DataFrames: ``(table, column, check, failures)``.

* ``not_null`` — rows where the column is NULL; all columns of one table are
  checked in a single aggregation pass.
* ``unique`` — key values occurring more than once (NULLs ignored), counted
  with a partial aggregation so a hot key is combined map-side.
* ``relationships`` — child rows whose non-NULL foreign key has no parent row.
* ``enforce`` — the gate: raise when any check failed.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators.joins import anti_join


def _frame(df: DataFrame, table: str, check: str) -> DataFrame:
    return df.select(F.lit(table).alias("table"), F.col("column"), F.lit(check).alias("check"),
                     F.col("failures").cast("bigint").alias("failures"))


def not_null(df: DataFrame, table: str, columns: list[str]) -> DataFrame:
    counts = df.agg(*[F.count(F.when(F.col(c).isNull(), F.lit(1))).alias(c) for c in columns])
    rows = counts.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("bigint").alias("failures")) for c in columns])))
    return _frame(rows, table, "not_null")


def unique(df: DataFrame, table: str, column: str) -> DataFrame:
    dup = (df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
           .where(F.col("_n") > 1))
    rows = dup.agg(F.count(F.lit(1)).alias("failures")).select(F.lit(column).alias("column"), "failures")
    return _frame(rows, table, "unique")


def relationships(child: DataFrame, table: str, column: str,
                  parent: DataFrame, parent_column: str, parent_table: str) -> DataFrame:
    fk = child.select(F.col(column).alias("_k")).where(F.col("_k").isNotNull())
    pk = parent.select(F.col(parent_column).alias("_k"))
    orphans = anti_join(fk, pk, ["_k"])
    rows = orphans.agg(F.count(F.lit(1)).alias("failures")).select(F.lit(column).alias("column"), "failures")
    return _frame(rows, table, f"relationships:{parent_table}.{parent_column}")


def relationships_to(parent: DataFrame, parent_column: str, parent_table: str,
                     children: list[tuple[DataFrame, str, str]]) -> DataFrame:
    """``relationships`` of several ``children`` (frame, table, column) to one parent, which
    is read and joined once: their keys go through one anti join, marked with their child."""
    keys = union_all([c.select(F.col(column).alias("_k"), F.lit(i).alias("_i")).where(F.col("_k").isNotNull())
                      for i, (c, _, column) in enumerate(children)])
    orphans = anti_join(keys, parent.select(F.col(parent_column).alias("_k")), ["_k"])
    counts = orphans.agg(*[F.count_if(F.col("_i") == i).alias(f"c{i}") for i in range(len(children))])
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(table).alias("table"), F.lit(column).alias("column"), F.lit(f"relationships:{parent_table}.{parent_column}").alias("check"),
                 F.col(f"c{i}").cast("bigint").alias("failures")) for i, (_, table, column) in enumerate(children)])))


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def enforce(report: DataFrame) -> DataFrame:
    """Raise if any check has failures (the report is one row per check)."""
    bad = [r.asDict() for r in report.where(F.col("failures") > 0).collect()]
    if bad:
        raise AssertionError(f"data-quality checks failed: {bad}")
    return report
