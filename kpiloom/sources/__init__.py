"""Base-table schemas, readers, catalog binding and KPI sinks."""

from kpiloom.sources.schemas import (
    CONTENT_TYPES,
    EXAM_CATEGORIES,
    MAIN_CATEGORIES,
    TABLES,
    WIDE_CATEGORIES,
    WIDE_CONTENT_TYPES,
)
from kpiloom.sources.sinks import publish_kpi_csv, write_base_table, write_kpi_csv, write_kpi_parquet
from kpiloom.sources.tables import bind_tables, read_table, read_tables

__all__ = [
    "CONTENT_TYPES",
    "EXAM_CATEGORIES",
    "MAIN_CATEGORIES",
    "TABLES",
    "WIDE_CATEGORIES",
    "WIDE_CONTENT_TYPES",
    "bind_tables",
    "publish_kpi_csv",
    "read_table",
    "read_tables",
    "write_base_table",
    "write_kpi_csv",
    "write_kpi_parquet",
]
