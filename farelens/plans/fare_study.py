"""The whole study in one Spark session: clean -> profile -> features ->
vectors -> fits -> evaluation -> tuning -> importance -> error analysis.

Stages hand over through parquet tables in ``out_dir`` (a shared folder on a
cluster), which also cuts lineage, so a lost executor re-runs at most one
stage. Report tables are aggregates and are written as single CSV files;
metrics are written as JSON lines. Nothing passes through the driver except
bounded metadata (model parameters, grid metrics, feature importances).
"""

from __future__ import annotations

import math
import time

from pyspark.sql import DataFrame, SparkSession

from ..operators import distributions as ds
from ..operators import errors as er
from ..operators import features as fe
from ..operators import models as md
from ..operators import profile as pr
from ..operators import quality as qu
from ..params import DEFAULT, Params
from ..session import ensure_checkpoint_dir, pin_time_zone
from ..sources import (
    EmptyInputError, read_counts, read_parquet, with_parsed_time, write_counted, write_metrics_json, write_parquet, write_report_csv,
)

IQR_COLS = ("fare_amount", "distance_km")


def clean(spark: SparkSession, trips: DataFrame, out_dir: str, params: Params = DEFAULT) -> DataFrame:
    """Parse time, drop repeated keys, report quality, write ``raw.parquet``."""
    pin_time_zone(spark, params)
    raw = qu.dedup_keys(with_parsed_time(trips))
    if not write_counted(raw, f"{out_dir}/raw.parquet")["__rows"]:
        raise EmptyInputError("trip input has no rows")
    raw = read_parquet(spark, f"{out_dir}/raw.parquet")
    write_report_csv(qu.quality_report(raw, params), f"{out_dir}/quality")
    return raw


def profile(raw: DataFrame, out_dir: str, params: Params = DEFAULT) -> None:
    """All profile reports, straight from the cleaned table: the one-row reports and the
    summary are cut from one pass, the distributions, histograms and heatmaps from
    another, and the IQR report is computed once."""
    prof, p, eda = fe.profile_frame(raw), params, f"{out_dir}/eda"
    row, iqr = small(pr.overview(prof, p)), small(pr.iqr_report(prof, list(IQR_COLS), p, method="approx"))
    corr_cols = ["fare_amount", *p.feature_cols]
    first = row.first()
    means = {c: first[f"{c}_avg"] for c in corr_cols if first[f"{c}_avg"] is not None and math.isfinite(first[f"{c}_avg"])}
    reports = {
        "missing_values": pr.missing_values(prof, row),
        "numeric_min_max": pr.numeric_min_max(prof, row=row),
        "numeric_avg_std": pr.numeric_avg_std(prof, row=row),
        "outside_box": row.select("total_rows", *[f"{e}_outside{x}" for x in ("", "_share") for e in ("pickup", "dropoff")]),
        "iqr": iqr,
        "summary": pr.profile_summary(prof, p, row=row, iqr=iqr),
        "correlation_matrix": pr.correlation(prof, corr_cols, centers=means),
    }
    with md.cached(ds.profile_counts(prof, p)) as counts:  # a row a bin, from one scan
        reports |= {name: ds.cut_report(counts, name, p) for name in ds.REPORTS}
        for name, df in reports.items():
            write_report_csv(df, f"{eda}/{name}")


def small(report: DataFrame) -> DataFrame:
    """A report of a few rows as a local frame, so that it is computed once."""
    return report.sparkSession.createDataFrame(report.collect(), report.schema)


def features(spark: SparkSession, raw: DataFrame, out_dir: str, params: Params = DEFAULT) -> DataFrame:
    """Write the feature table, capped if the study caps it; the accounting of the
    filter comes from the counts taken while both tables were written."""
    before = read_counts(spark, f"{out_dir}/raw.parquet")["__rows"]
    after = write_counted(fe.feature_table(raw, params, carry=("key",)), f"{out_dir}/fe.parquet")["__rows"]
    if not after:
        raise EmptyInputError("feature table has no rows")
    accounts = spark.createDataFrame([(before, after, before - after)], "rows_before bigint, rows_after bigint, rows_dropped bigint")
    write_report_csv(accounts, f"{out_dir}/filter_accounting")
    feats = read_parquet(spark, f"{out_dir}/fe.parquet")
    if params.fit_row_cap is not None:  # the capped subset beside the whole table
        write_counted(fe.row_cap(feats, params.fit_row_cap, ["key"]), f"{out_dir}/fe_small.parquet")
    return feats


def vectors(spark: SparkSession, feats: DataFrame, out_dir: str, params: Params = DEFAULT):
    prep, train, test = md.vectorize(feats, params)
    md.save_model(prep, f"{out_dir}/prep_pipeline")
    write_parquet(train, f"{out_dir}/train.parquet")
    write_parquet(test, f"{out_dir}/test.parquet")
    return read_parquet(spark, f"{out_dir}/train.parquet"), read_parquet(spark, f"{out_dir}/test.parquet")


def models(train: DataFrame, test: DataFrame, out_dir: str, params: Params = DEFAULT) -> dict[str, float]:
    """Fit and save the three baselines, score the saved models; returns the
    measured metrics of the linear one."""
    fitted = {
        "Linear": md.fit_linear(train, params),
        "RF": md.fit_forest(train, params),
        "GBT": md.fit_boosted(train, params),
    }
    for name, key in (("Linear", "lr"), ("RF", "rf"), ("GBT", "gbt")):
        md.save_model(fitted[name], f"{out_dir}/baseline_models/{key}")
    compared = small(md.model_comparison(md.load_baselines(f"{out_dir}/baseline_models"), test))
    write_metrics_json(compared, f"{out_dir}/baseline_metrics")
    return {r["metric"]: r["value"] for r in compared.where("model = 'Linear'").collect()}


def tuning(
    train: DataFrame, test: DataFrame, out_dir: str, params: Params = DEFAULT, baseline: dict[str, float] | None = None
) -> None:
    """Both grids; ``baseline``: the linear metrics that the tuned linear model is
    compared with (default: the fixed ones of the original data)."""
    rf_cv, rf_report = md.tune_forest(train, params)
    md.save_model(rf_cv.bestModel, f"{out_dir}/best_rf_model")
    write_report_csv(md.with_test_rmse(rf_report, rf_cv, test), f"{out_dir}/tuning_rf")
    lr_cv, lr_report = md.tune_linear(train, params)
    md.save_model(lr_cv.bestModel, f"{out_dir}/best_lr_model")
    write_report_csv(md.with_test_rmse(lr_report, lr_cv, test), f"{out_dir}/tuning_linear")
    tuned = md.regression_metrics(lr_cv.bestModel.transform(test))
    write_report_csv(md.baseline_improvement(tuned, baseline or params.baseline_linear), f"{out_dir}/tuning_linear_vs_baseline")
    # importance needs the tuned forest, so it runs after tuning
    write_report_csv(md.feature_importance(rf_cv.bestModel, params.feature_cols), f"{out_dir}/feature_importance")


def error_analysis(spark: SparkSession, test: DataFrame, out_dir: str, params: Params = DEFAULT) -> None:
    model = md.load_forest(spark, f"{out_dir}/best_rf_model", f"{out_dir}/baseline_models/rf")
    pdir = f"{out_dir}/predictions"
    write_parquet(er.prediction_errors(model.transform(test)), f"{pdir}/predictions_full.parquet")
    result = read_parquet(spark, f"{pdir}/predictions_full.parquet")
    write_report_csv(er.error_describe(result), f"{pdir}/describe")
    write_report_csv(er.sample_rows(result), f"{pdir}/predictions_sample")
    write_report_csv(er.best_predictions(result), f"{pdir}/predictions_best")
    write_report_csv(er.worst_predictions(result), f"{pdir}/predictions_worst")
    write_report_csv(er.error_categories(result), f"{pdir}/error_distribution")
    write_metrics_json(er.error_summary(result, params, median="approx"), f"{pdir}/predictions_summary")


def run(spark: SparkSession, trips: DataFrame, out_dir: str, params: Params = DEFAULT) -> dict[str, float]:
    """Run every stage; returns seconds per stage."""
    times: dict[str, float] = {}

    def timed(name, fn, *a):
        t0 = time.time()
        r = fn(*a)
        times[name] = round(time.time() - t0, 3)
        return r

    # boosting cuts its lineage here; out_dir is shared, as the stages' tables are
    ensure_checkpoint_dir(spark, f"{out_dir}/checkpoints")
    raw = timed("clean", clean, spark, trips, out_dir, params)
    timed("profile", profile, raw, out_dir, params)
    feats = timed("features", features, spark, raw, out_dir, params)
    train, test = timed("vectors", vectors, spark, feats, out_dir, params)
    with md.cached(train) as kept:  # once for every fit
        baseline = timed("models", models, kept, test, out_dir, params)
        timed("tuning", tuning, kept, test, out_dir, params, baseline)
    timed("error_analysis", error_analysis, spark, test, out_dir, params)
    return times
