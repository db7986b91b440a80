"""Reading, writing and staging tables."""

from tradewind.sources.staging import stage
from tradewind.sources.tables import (
    load_or_build, read_cleaned, read_periods, read_raw, read_raw_tables, replace_periods, with_file_order, write_csv,
    write_fact_table, write_series,
)

__all__ = [
    "load_or_build", "read_cleaned", "read_periods", "read_raw", "read_raw_tables",
    "replace_periods", "stage", "with_file_order", "write_csv", "write_fact_table", "write_series",
]
