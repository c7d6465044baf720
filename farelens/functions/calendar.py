"""Time parsing and calendar fields (session time zone, pinned by the caller)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_time(c: str | Column = "pickup_datetime") -> Column:
    """Text to timestamp without a format. Unparsable text gives null (the
    ANSI-off behaviour the study relies on), never an error."""
    return F.try_to_timestamp(F.col(c) if isinstance(c, str) else c)


def calendar_columns(ts: str = "pickup_datetime_ts") -> dict[str, Column]:
    """hour, day of week (1 = Sunday), month, year, as int columns."""
    t = F.col(ts)
    return {
        "pickup_hour": F.hour(t),
        "pickup_dow": F.dayofweek(t),
        "pickup_month": F.month(t),
        "pickup_year": F.year(t),
    }
