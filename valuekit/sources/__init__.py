"""File sources and sinks."""

from valuekit.sources.files import (  # noqa: F401
    load_csv,
    load_csv_tables,
    read_parquet,
    read_parquet_tables,
    write_csv,
    write_parquet,
    write_parquet_counted,
)
