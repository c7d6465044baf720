"""Prediction error expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..params import ERROR_CATEGORIES, ERROR_CATEGORY_REST


def error_columns(label: str = "label", prediction: str = "prediction") -> dict[str, Column]:
    """Signed, absolute and percentage error from unrounded inputs.

    A label of 0 gives a null percentage error (``try_divide``), as the study
    did with ANSI off."""
    err = F.col(prediction) - F.col(label)
    return {
        "error": err,
        "absolute_error": F.abs(err),
        "percentage_error": F.try_divide(F.abs(err), F.col(label)) * 100,
    }


def error_category(c: str | Column = "absolute_error") -> Column:
    """Bucket an absolute error; null and NaN fall to the last category."""
    col = F.col(c) if isinstance(c, str) else c
    expr = None
    for bound, label in ERROR_CATEGORIES:
        cond = col < bound
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(ERROR_CATEGORY_REST))
