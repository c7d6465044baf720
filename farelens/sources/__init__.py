"""Scans and sinks."""

from .sinks import (
    EmptyInputError,
    count_table,
    path_exists,
    persist_for_passes,
    publish,
    published,
    read_counts,
    require_rows,
    write_counted,
    write_metrics_json,
    write_parquet,
    write_report_csv,
)
from .testdata import scored, scored_from_lineitem, table, trips, trips_from_lineitem
from .trips import TRIP_COLUMNS, TRIP_SCHEMA, read_parquet, read_trips_csv, with_parsed_time

__all__ = [
    "EmptyInputError",
    "count_table",
    "path_exists",
    "persist_for_passes",
    "publish",
    "published",
    "read_counts",
    "require_rows",
    "write_counted",
    "write_metrics_json",
    "write_parquet",
    "write_report_csv",
    "scored",
    "scored_from_lineitem",
    "table",
    "trips",
    "trips_from_lineitem",
    "TRIP_COLUMNS",
    "TRIP_SCHEMA",
    "read_parquet",
    "read_trips_csv",
    "with_parsed_time",
]
