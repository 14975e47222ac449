"""Sources and sinks: CSV/parquet scans, file discovery, managed-table saves."""

from .files import list_files, read_csv, read_table, load_tables, TABLE_NAMES  # noqa: F401
from .catalog import (ensure_database, save_table, save_and_audit, bronze_load,  # noqa: F401
                      create_view, rows_to_json, scan_profile, catalog_inventory)
