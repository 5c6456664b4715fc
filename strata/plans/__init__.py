"""Layer plans (Silver, serving, Gold, KPIs) and the storage jobs (``daily``)."""
