"""Sources and sinks: landing CSV, staging/Bronze Parquet, CRM (Parquet/JDBC)."""
