"""The query catalogue on the driver tables and its DuckDB oracle."""
