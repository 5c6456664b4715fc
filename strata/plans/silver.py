"""Bronze → Silver plan: parse once, split into quarantine and clean, enrich
with the CRM, deduplicate, conform to the Silver contract."""

from __future__ import annotations

from pyspark.sql import DataFrame

from strata import schemas
from strata.operators.clean import clean, dedup, parse, quarantine
from strata.operators.enrich import enrich

LINEAGE = ["event_id"]


def lineage(df: DataFrame) -> list[str]:
    return [c for c in LINEAGE if c in df.columns]


def silver_parts(raw: DataFrame, crm: DataFrame, hot_users: list | None = None) -> tuple[DataFrame, DataFrame]:
    """(quarantined rows, Silver rows) from one parse of the raw rows.

    Deduplication runs before the CRM join — enrichment is a per-row function
    of ``user_id`` so the survivor is the same — which shrinks the join input.
    ``hot_users`` (``operators.hot_keys``) are joined apart from the others.
    """
    parsed = parse(raw)
    q = quarantine(parsed)
    extra = lineage(raw)
    cleaned = dedup(clean(parsed), order_by=extra)
    silver = schemas.conform(enrich(cleaned, crm, hot_users), schemas.SILVER, keep_extra=extra)
    return q, silver


def silver_clean(raw: DataFrame) -> DataFrame:
    """Valid rows, typed and defaulted, before dedup and enrichment."""
    return clean(parse(raw))


def silver_dedup(raw: DataFrame) -> DataFrame:
    return dedup(silver_clean(raw), order_by=lineage(raw))


def silver(raw: DataFrame, crm: DataFrame) -> DataFrame:
    return silver_parts(raw, crm)[1]


def quarantined(raw: DataFrame) -> DataFrame:
    return quarantine(parse(raw))
