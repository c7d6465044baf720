"""Aggregate expressions with the study's null/NaN conventions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def count_if(cond: Column) -> Column:
    """Rows where ``cond`` is true; null counts as false."""
    return F.count_if(F.coalesce(cond, F.lit(False)))


def is_missing(c: str, kind: str) -> Column:
    """Missing test by column kind: numeric = null or NaN, string = null or blank."""
    col = F.col(c)
    if kind == "numeric":
        return col.isNull() | F.isnan(col)
    if kind == "string":
        return col.isNull() | (F.trim(col) == "")
    return col.isNull()
