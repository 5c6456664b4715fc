"""Silver → serving: one day (or every day) without ``view`` events, in the
serving contract. Gold reads this table."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata import schemas
from strata.plans.silver import lineage

EXCLUDED_EVENT = "view"


def serving(silver: DataFrame, run_date: str | _dt.date | None = None) -> DataFrame:
    """Rows of ``run_date`` (all days when None) whose type is not 'view'.

    The day filter is on the partition column of the Silver table, so a read
    of a partitioned Silver prunes to that day's folder; the type filter is
    pushed into the Parquet scan.
    """
    cond = F.col("event_type") != F.lit(EXCLUDED_EVENT)
    if run_date is not None:
        cond = (F.col("event_date") == F.lit(str(run_date)).cast("date")) & cond
    return schemas.conform(silver.where(cond), schemas.SERVING, keep_extra=lineage(silver))


def data_end_date(silver: DataFrame) -> DataFrame:
    """Last day of the latest month with events."""
    return silver.agg(F.last_day(F.max("event_date")).alias("data_end_date"))
