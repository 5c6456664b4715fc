"""Silver enrichment: CRM attributes by user, with defaults for unknown users."""

from __future__ import annotations

from pyspark.sql import DataFrame

from strata.operators.hot_keys import left_join


# Defaults for users absent from the CRM.
DEFAULT_TIER = "Regular"
DEFAULT_CHANNEL = "Organic"
CRM_COLUMNS = ["user_id", "loyalty_tier", "acquisition_channel"]


def enrich(clean: DataFrame, crm: DataFrame, hot_users: list | None = None) -> DataFrame:
    """Left join on ``user_id`` (CRM key is unique) and fill missing attributes.

    The planner chooses the join from the CRM's size, AQE again from measured
    sizes; in a shuffle join AQE splits a hot user's partition (left outer
    joins split the left side). ``hot_users`` are joined with their few CRM rows
    by broadcast, so none of them fills a partition, with or without AQE.
    """
    side = crm.select(*CRM_COLUMNS)
    joined = clean.join(side, "user_id", "left") if hot_users is None else left_join(clean, side, "user_id", hot_users)
    return (joined
                 .fillna({"loyalty_tier": DEFAULT_TIER, "acquisition_channel": DEFAULT_CHANNEL}))
