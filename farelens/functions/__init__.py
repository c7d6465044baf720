"""Column expressions built only from ``pyspark.sql.functions`` (JVM-side, codegen)."""

from .calendar import calendar_columns, parse_time
from .errors import error_category, error_columns
from .geo import haversine_km, in_box, trip_in_box
from .stats import count_if, is_missing

__all__ = [
    "calendar_columns",
    "parse_time",
    "error_category",
    "error_columns",
    "haversine_km",
    "in_box",
    "trip_in_box",
    "count_if",
    "is_missing",
]
