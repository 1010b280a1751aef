"""Reading landed pages, exports and metadata."""

from recordloom.sources.bulk import csv_records, read_bulk_csv, split_bulk_csv
from recordloom.sources.catalog import catalog_tables, discover_forms, discover_reports
from recordloom.sources.landing import (
    as_record,
    drop_failed_pages,
    drop_sentinels,
    infer_schema,
    land_by_day,
    parse_bulk_csv,
    parse_pages,
    read_keyed,
    read_pages,
    read_single,
    read_text_pages,
    scan_filtered,
    snapshot_complete,
)

__all__ = [
    "as_record",
    "catalog_tables",
    "csv_records",
    "discover_forms",
    "discover_reports",
    "drop_failed_pages",
    "drop_sentinels",
    "infer_schema",
    "land_by_day",
    "parse_bulk_csv",
    "parse_pages",
    "read_bulk_csv",
    "read_keyed",
    "read_pages",
    "read_single",
    "read_text_pages",
    "scan_filtered",
    "snapshot_complete",
    "split_bulk_csv",
]
