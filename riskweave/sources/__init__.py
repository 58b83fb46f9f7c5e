"""Inputs and sinks: fixture views over the driver's tables, file scans,
table writes."""

from riskweave.sources.files import (
    append_table,
    create_database,
    list_databases,
    list_tables,
    overwrite_partition,
    read_csv,
    read_csv_by_name,
    read_parquet,
    read_table,
    write_table,
)
from riskweave.sources.fixtures import claims_from, claims_raw, customers_from, customers_raw

__all__ = [
    "append_table", "claims_from", "claims_raw", "create_database", "customers_from", "customers_raw",
    "list_databases", "list_tables", "overwrite_partition", "read_csv", "read_csv_by_name", "read_parquet", "read_table",
    "write_table",
]
