"""strata — Spark-native layered clickstream analytics.

Layers: landing CSV → staging/Bronze → Silver (clean, dedup, enrich, upsert)
→ serving → Gold star schema → KPIs and data-quality gate. Every step is a
DataFrame/SQL plan on Spark; see README.md.
"""

__version__ = "0.1.0"
