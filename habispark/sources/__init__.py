"""Readers for the landed files."""

from habispark.sources.files import (
    SchemaError,
    certificate_columns,
    field_counts,
    files_without,
    landed_years,
    page_maps,
    read_certificate_maps,
    read_certificates,
    read_cog,
    read_geocoded,
    read_sales,
    read_table,
    require_columns,
    stored_years,
)
from habispark.sources.snapshots import latest_snapshot, latest_snapshot_url

__all__ = [
    "SchemaError",
    "certificate_columns",
    "field_counts",
    "files_without",
    "landed_years",
    "latest_snapshot",
    "latest_snapshot_url",
    "page_maps",
    "read_certificate_maps",
    "read_certificates",
    "read_cog",
    "read_geocoded",
    "read_sales",
    "read_table",
    "require_columns",
    "stored_years",
]
