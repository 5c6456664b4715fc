"""Dimensions from mergeable partial states, updated by day.

Layout below a state's ``path``::

    day/event_date=<d>/     one row per key: the partial aggregate of that day's events
    base/until=<d>/         one row per key: all days up to d, folded together

Loading a day aggregates its events only and replaces its partial, so a day that is loaded
again, with other rows too, leaves no trace of what it held before. The dimension merges
base and partials, which are much smaller than the events (a row per key and day). ``fold``
merges days that no load will touch any more into a new base; a base counts once its
``_SUCCESS`` file is there, and days it covers aren't read beside it, so a crash in
between loses and doubles nothing.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators import tables

DAY = "event_date"


@dataclass(frozen=True)
class Aggregate:
    """A mergeable aggregate: SQL over events (``first``) and over its own rows (``merge``)."""

    keys: tuple[str, ...]
    first: dict[str, str]
    merge: dict[str, str]
    where: str = "true"

    def of_events(self, events: DataFrame, *more: str) -> DataFrame:
        return self._grouped(events.where(self.where), self.first, more)

    def of_states(self, states: DataFrame) -> DataFrame:
        return self._grouped(states, self.merge, ())

    def _grouped(self, df: DataFrame, aggregates: dict[str, str], more: tuple[str, ...]) -> DataFrame:
        return df.groupBy(*self.keys, *more).agg(*[F.expr(sql).alias(name) for name, sql in aggregates.items()])


# Visits: the sessions a user was seen in, with their first and last time.
VISITS = Aggregate(("user_id", "user_session"), {"began": "min(event_time)", "ended": "max(event_time)"},
                   {"began": "min(began)", "ended": "max(ended)"})
# The greatest description of a product.
PRODUCTS = Aggregate(("product_id",), {"best": "max(struct(coalesce(category, '') AS a, coalesce(sub_category, '') AS b, "
                                               "coalesce(brand, '') AS c, category, sub_category, brand))"},
                     {"best": "max(best)"}, where="product_id IS NOT NULL")


class DayState:
    """The stored partial states of one aggregate."""

    def __init__(self, spark: SparkSession, path: str, aggregate: Aggregate):
        self.spark, self.path, self.aggregate = spark, path.rstrip("/"), aggregate

    def folded_until(self) -> str | None:
        """The last day the base covers."""
        done = [v for v in tables.list_partitions(self.spark, f"{self.path}/base", "until")
                if tables.table_exists(self.spark, f"{self.path}/base/until={v}/_SUCCESS")]
        return done[-1] if done else None

    def open_days(self) -> list[str]:
        """Days stored as partials of their own."""
        until = self.folded_until()
        return [d for d in tables.list_partitions(self.spark, f"{self.path}/day", DAY) if until is None or d > until]

    def update(self, events: DataFrame, days: list[str]) -> None:
        """Replace the partials of ``days`` by those of their events. ``events`` has an
        ``event_date``, by which its scan is pruned to those days."""
        until = self.folded_until()
        late = [d for d in days if until is not None and d <= until]
        if late:
            raise ValueError(f"days {late} are folded into the base until {until}: rebuild the state")
        rows = events.where(F.col(DAY).isin([F.lit(d).cast("date") for d in days]))
        tables.replace_partitions(self.spark, f"{self.path}/day", self.aggregate.of_events(rows, DAY), DAY, owned=days)

    def fold(self, until: str) -> None:
        """Merge the days up to ``until`` into a new base and remove what it replaces."""
        old, days = self.folded_until(), [d for d in self.open_days() if d <= until]
        if not days:
            return
        merged = self.aggregate.of_states(self._stored(old, days))
        tables.write_table(merged, f"{self.path}/base/until={until}", whole=True)
        for d in tables.list_partitions(self.spark, f"{self.path}/day", DAY):
            if d <= until:
                tables.delete_path(self.spark, f"{self.path}/day/{DAY}={d}")
        for v in tables.list_partitions(self.spark, f"{self.path}/base", "until"):
            if v < until:
                tables.delete_path(self.spark, f"{self.path}/base/until={v}")

    def _stored(self, until: str | None, days: list[str]) -> DataFrame:
        parts = []
        if days:
            folders = [tables.partition_path(f"{self.path}/day", DAY, d) for d in days]
            parts.append(self.spark.read.parquet(*folders))
        if until is not None:
            parts.append(self.spark.read.parquet(f"{self.path}/base/until={until}"))
        if not parts:
            raise FileNotFoundError(f"no state at {self.path}")
        return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])

    def read(self) -> DataFrame:
        """One row per key: all days together."""
        return self.aggregate.of_states(self._stored(self.folded_until(), self.open_days()))


def dim_users(visits: DayState) -> DataFrame:
    """``gold.dim_users`` from the visits: a session counts once, whatever days it has."""
    return (visits.read().where("user_id IS NOT NULL").groupBy("user_id")
            .agg(F.count("user_session").alias("total_sessions"), F.min("began").alias("first_seen"), F.max("ended").alias("last_seen")))


def dim_users_loyalty(visits: DayState, crm: DataFrame) -> DataFrame:
    """``gold.dim_users_loyalty`` from the visits."""
    active = visits.read().groupBy("user_id").agg(
        F.count("user_session").alias("total_sessions"), F.min("began").alias("first_active_time"), F.max("ended").alias("last_active_time"))
    return active.join(crm.select("user_id", "loyalty_tier", "signup_date", "acquisition_channel"), "user_id", "left").select(
        "user_id", "loyalty_tier", "signup_date", "acquisition_channel", "total_sessions", "first_active_time", "last_active_time")


def dim_products(products: DayState) -> DataFrame:
    """``gold.dim_products`` from the best description of each day."""
    return products.read().select("product_id", "best.category", "best.sub_category", "best.brand")
