"""Sources and sinks: Parquet/CSV/JDBC tables, topics, change feeds, ingest."""
