"""Prediction-error analysis on a (label, prediction) frame.

Errors are computed from unrounded values, then every column is rounded to
2 places, and all later statistics use the rounded columns (as originally).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import count_if, error_category, error_columns
from ..params import DEFAULT, ERROR_THRESHOLDS, Params
from .quantiles import quantiles

RESULT_COLS = ("label", "prediction", "error", "absolute_error", "percentage_error")


def prediction_errors(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """label, prediction, error, absolute_error, percentage_error (2 places).
    Percentage error is null for a label of 0."""
    errs = error_columns(label, prediction)
    return pred.select(
        F.round(F.col(label), 2).alias("label"),
        F.round(F.col(prediction), 2).alias("prediction"),
        *[F.round(e, 2).alias(n) for n, e in errs.items()],
    )


def error_categories(result: DataFrame) -> DataFrame:
    """(error_category, count, percentage) by count descending.

    The share uses ``sum(count) OVER ()`` on the grouped rows (at most five),
    so the total never needs a second pass over the data."""
    grouped = result.groupBy(error_category("absolute_error").alias("error_category")).agg(
        F.count(F.lit(1)).alias("count")
    )
    total = F.sum("count").over(Window.partitionBy())
    return grouped.withColumn("percentage", F.round(F.col("count") / total * 100, 2)).orderBy(F.col("count").desc())


def error_summary(result: DataFrame, params: Params = DEFAULT, median: str = "exact") -> DataFrame:
    """One row: totals, mean/max/min absolute error, mean percentage error,
    median absolute error (exact distributed rank, or the approximate sketch),
    counts and shares within 1, 2 and 5."""
    t1, t2, t5 = ERROR_THRESHOLDS
    ae = F.col("absolute_error")
    aggs = [
        F.count(F.lit(1)).alias("total_predictions"),
        F.avg(F.abs(F.col("error"))).alias("mean_absolute_error"),
        F.max(ae).alias("max_error"),
        F.min(ae).alias("min_error"),
        F.avg("percentage_error").alias("mean_percentage_error"),
        count_if(ae < t1).alias("predictions_within_1_dollar"),
        count_if(ae < t2).alias("predictions_within_2_dollars"),
        count_if(ae < t5).alias("predictions_within_5_dollars"),
    ]
    if median == "approx":
        # the sketch rides along in the same single pass
        accuracy = max(1, int(round(1.0 / params.quantile_rel_error)))
        clean = F.when(~F.isnan(ae), ae)
        stats = result.agg(*aggs, F.percentile_approx(clean, 0.5, accuracy).alias("median_absolute_error"))
    else:
        med = quantiles(result, ["absolute_error"], [0.5], "exact").select(
            F.col("value").alias("median_absolute_error")
        )
        stats = result.agg(*aggs).crossJoin(F.broadcast(med))
    share = lambda c: F.round(F.col(c) / F.col("total_predictions") * 100, 2)
    return stats.select(
        "total_predictions",
        "mean_absolute_error",
        "median_absolute_error",
        "max_error",
        "min_error",
        "mean_percentage_error",
        "predictions_within_1_dollar",
        "predictions_within_2_dollars",
        "predictions_within_5_dollars",
        share("predictions_within_1_dollar").alias("pct_within_1_dollar"),
        share("predictions_within_2_dollars").alias("pct_within_2_dollars"),
        share("predictions_within_5_dollars").alias("pct_within_5_dollars"),
    )


def error_describe(result: DataFrame) -> DataFrame:
    """Typed describe of the absolute and percentage error:
    (summary, abs_error, percentage_error) for count, mean, stddev, min, max.
    ``describe_strings`` keeps Spark's own string-typed ``describe``."""
    ae, pe = F.abs(F.col("error")), F.col("percentage_error")
    wide = result.agg(
        F.count(ae).cast("double").alias("count_a"), F.count(pe).cast("double").alias("count_p"),
        F.avg(ae).alias("mean_a"), F.avg(pe).alias("mean_p"),
        F.stddev(ae).alias("stddev_a"), F.stddev(pe).alias("stddev_p"),
        F.min(ae).alias("min_a"), F.min(pe).alias("min_p"),
        F.max(ae).alias("max_a"), F.max(pe).alias("max_p"),
    )
    rows = [
        F.struct(F.lit(s).alias("summary"), F.col(f"{s}_a").alias("abs_error"), F.col(f"{s}_p").alias("percentage_error"))
        for s in ("count", "mean", "stddev", "min", "max")
    ]
    return wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def describe_strings(result: DataFrame) -> DataFrame:
    return result.select(F.abs(F.col("error")).alias("abs_error"), "percentage_error").describe()


def _order(desc: bool):
    ae = F.col("absolute_error")
    first = ae.desc_nulls_last() if desc else ae.asc_nulls_first()
    rest = [F.col(c).asc_nulls_first() for c in RESULT_COLS if c != "absolute_error"]
    return [first, *rest]


def best_predictions(result: DataFrame, k: int = 100) -> DataFrame:
    """k lowest absolute errors; ties broken by the other columns. Planned as
    TakeOrderedAndProject: each task keeps its own top k, one merge of
    k x #tasks rows - no full sort."""
    return result.orderBy(*_order(False)).limit(k)


def worst_predictions(result: DataFrame, k: int = 100) -> DataFrame:
    return result.orderBy(*_order(True)).limit(k)


def sample_rows(result: DataFrame, n: int = 1000) -> DataFrame:
    """The first ``n`` rows in the order of all columns (nulls first)."""
    return result.orderBy(*[F.col(c).asc_nulls_first() for c in RESULT_COLS]).limit(n)
