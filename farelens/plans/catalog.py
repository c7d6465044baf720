"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

Each query reads the given tables (trips and scored predictions are derived
from ``lineitem``) and runs over all of their rows. Floating outputs are
rounded to 6 places so that results compare across engines.
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import distributions as ds
from ..operators import errors as er
from ..operators import features as fe
from ..operators import models as md
from ..operators import moments as mo
from ..operators import profile as pr
from ..operators import quality as qu
from ..operators import quantiles as qn
from ..params import DEFAULT, FEATURE_COLS, ROW_CAP, SAMPLE_ROWS, SMALL_MODELS, TOP_K
from ..session import shared_folder
from ..sources import TRIP_COLUMNS, TRIP_SCHEMA, count_table, read_counts, read_parquet, testdata, write_counted
from . import stages as st

# binds at every tested size; the study's own cap is ROW_CAP
QUERY_ROW_CAP = ROW_CAP // 50
DEFAULT_TOP_K = TOP_K
DEFAULT_SAMPLE_ROWS = SAMPLE_ROWS
IQR_COLS = ("fare_amount", "distance_km")
# a year is large against its spread
CORR_CENTERS = {"pickup_year": 2000.0}
CORR_COLS = ("fare_amount", *FEATURE_COLS)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ROWS_ONLY: set[str] = set()


def register(name: str, rows_only: bool = False):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if rows_only:
            ROWS_ONLY.add(name)
        return fn

    return deco


# --- P1-P6: parsing, calendar, distance, features --------------------------


@register("parse_time")
def q_parse_time(spark, sf_dir):
    return st.trips_ts(spark, sf_dir).select("key", "pickup_datetime", "pickup_datetime_ts")


@register("csv_scan")
def q_csv_scan(spark, sf_dir):
    """S1 without files: the trips as CSV lines, some with a bad, a missing or an
    extra cell, parsed under the fixed schema."""
    trips = testdata.trips(spark, sf_dir)
    order = F.split("key", "-")[0].cast("bigint")
    cells = {c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in TRIP_COLUMNS}
    cells["fare_amount"] = F.when(order % 7 == 0, F.lit("oops")).otherwise(cells["fare_amount"])
    cells["dropoff_latitude"] = F.when(order % 11 == 0, F.lit("")).otherwise(cells["dropoff_latitude"])
    line = F.concat_ws(",", *cells.values(), F.when(order % 13 == 0, F.lit("extra")))
    parsed = trips.select(F.from_csv(line, TRIP_SCHEMA.simpleString()[7:-1].replace(":", " "), {"mode": "PERMISSIVE"}).alias("r"))
    return st.round_doubles(parsed.select("r.*"))


@register("calendar_features")
def q_calendar_features(spark, sf_dir):
    return st.profile(spark, sf_dir).select("key", "pickup_hour", "pickup_dow", "pickup_month", "pickup_year")


@register("haversine")
def q_haversine(spark, sf_dir):
    return st.round_doubles(st.profile(spark, sf_dir).select("key", "distance_km"))


@register("features")
def q_features(spark, sf_dir):
    return st.round_doubles(st.features(spark, sf_dir))


@register("valid_trips")
def q_valid_trips(spark, sf_dir):
    return st.round_doubles(fe.valid_trips(st.raw(spark, sf_dir)))


@register("filter_accounting")
def q_filter_accounting(spark, sf_dir):
    return fe.filter_accounting(st.raw(spark, sf_dir))


@register("hourly_fare")
def q_hourly_fare(spark, sf_dir):
    return st.round_doubles(fe.hourly_fares(st.features(spark, sf_dir)))


# --- K4, G3: caps, samples, split -------------------------------------------


@register("row_cap")
def q_row_cap(spark, sf_dir):
    return st.round_doubles(fe.row_cap(st.features(spark, sf_dir, carry=("key",)), QUERY_ROW_CAP, ["key"]))


@register("written_counts")
def q_written_counts(spark, sf_dir):
    """S3: the feature table written, reread and compared with what was counted on the way."""
    feats, path = st.features(spark, sf_dir, carry=("key",)), f"{shared_folder(spark)}/features.parquet"
    written = write_counted(feats, path)
    reread = read_parquet(spark, path)
    same = written == read_counts(spark, path) == count_table(reread)
    return reread.agg(F.count(F.lit(1)).alias("rows"), F.lit(len(feats.columns)).cast("bigint").alias("columns"), F.lit(same).alias("same"))


@register("hash_sample")
def q_hash_sample(spark, sf_dir):
    return st.round_doubles(fe.hash_sample(st.features(spark, sf_dir, carry=("key",)), 0.5, ["key"]))


@register("train_test_split")
def q_train_test_split(spark, sf_dir):
    feats = st.features(spark, sf_dir, carry=("key",))
    return st.round_doubles(feats.withColumn("part", fe.split_part(["key"])))


# --- A1-A3, G1-G2, P8-P9, A20: quality --------------------------------------


@register("row_counts")
def q_row_counts(spark, sf_dir):
    return qu.stage_counts(st.trips_ts(spark, sf_dir), fe.valid_trip(DEFAULT))


@register("duplicate_keys")
def q_duplicate_keys(spark, sf_dir):
    return qu.duplicate_keys(st.trips_ts(spark, sf_dir))


@register("distinct_keys")
def q_distinct_keys(spark, sf_dir):
    return qu.distinct_keys(st.trips_ts(spark, sf_dir))


@register("dedup_keys")
def q_dedup_keys(spark, sf_dir):
    return st.round_doubles(st.raw(spark, sf_dir))


@register("quality_report")
def q_quality_report(spark, sf_dir):
    return st.round_doubles(qu.quality_report(st.raw(spark, sf_dir)))


@register("outside_box")
def q_outside_box(spark, sf_dir):
    return st.round_doubles(qu.outside_box(st.profile(spark, sf_dir)))


# --- A4-A6, A14-A16, S6: profile ---------------------------------------------


@register("missing_values")
def q_missing_values(spark, sf_dir):
    return st.round_doubles(pr.missing_values(st.profile(spark, sf_dir)))


@register("numeric_min_max")
def q_numeric_min_max(spark, sf_dir):
    return st.round_doubles(pr.numeric_min_max(st.profile(spark, sf_dir)))


@register("numeric_avg_std")
def q_numeric_avg_std(spark, sf_dir):
    return st.round_doubles(pr.numeric_avg_std(st.profile(spark, sf_dir)))


@register("quantiles_approx")
def q_quantiles_approx(spark, sf_dir):
    """A sketch's values may be any within its error, so what is compared is the proof."""
    found = qn.proved_quantiles(
        st.profile(spark, sf_dir), list(IQR_COLS), list(DEFAULT.quantile_probs), DEFAULT.quantile_rel_error
    )
    return found.select("column", "prob", "rows", "within")


@register("quantiles_exact")
def q_quantiles_exact(spark, sf_dir):
    return st.round_doubles(
        qn.exact_quantiles(st.profile(spark, sf_dir), list(IQR_COLS), [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 0.99, 1.0])
    )


@register("iqr_exact")
def q_iqr_exact(spark, sf_dir):
    return st.round_doubles(pr.iqr_report(st.profile(spark, sf_dir), list(IQR_COLS), method="exact"))


@register("iqr_approx")
def q_iqr_approx(spark, sf_dir):
    """As ``quantiles_approx``: the proof of the quartiles, and that the outliers are
    those of the fences that the report names."""
    return pr.iqr_proof(st.profile(spark, sf_dir), list(IQR_COLS))


@register("correlation")
def q_correlation(spark, sf_dir):
    return st.round_doubles(pr.correlation(st.profile(spark, sf_dir), list(CORR_COLS), nulls="zero", centers=CORR_CENTERS))


@register("correlation_skip")
def q_correlation_skip(spark, sf_dir):
    return st.round_doubles(pr.correlation(st.profile(spark, sf_dir), list(CORR_COLS), nulls="skip", centers=CORR_CENTERS))


@register("profile_summary")
def q_profile_summary(spark, sf_dir):
    return st.round_doubles(pr.profile_summary(st.profile(spark, sf_dir), method="exact"))


# --- A7-A13: distributions ---------------------------------------------------


@register("hour_distribution")
def q_hour_distribution(spark, sf_dir):
    return ds.value_distribution(st.profile(spark, sf_dir), "pickup_hour")


@register("profile_counts")
def q_profile_counts(spark, sf_dir):
    return ds.profile_counts(st.profile(spark, sf_dir))


@register("passenger_distribution")
def q_passenger_distribution(spark, sf_dir):
    return ds.passenger_distribution(st.profile(spark, sf_dir))


@register("monthly_trips")
def q_monthly_trips(spark, sf_dir):
    return ds.monthly_trips(st.profile(spark, sf_dir))


@register("hist_fare")
def q_hist_fare(spark, sf_dir):
    p = DEFAULT
    return st.round_doubles(ds.histogram(st.profile(spark, sf_dir), "fare_amount", p.fare_bin_width, 0.0, p.heat_fare_max))


@register("hist_distance")
def q_hist_distance(spark, sf_dir):
    p = DEFAULT
    return st.round_doubles(
        ds.histogram(st.profile(spark, sf_dir), "distance_km", p.distance_bin_width, 0.0, p.heat_distance_max)
    )


@register("hist_fare_data_range")
def q_hist_fare_data_range(spark, sf_dir):
    return st.round_doubles(ds.histogram(st.profile(spark, sf_dir), "fare_amount", DEFAULT.fare_bin_width))


@register("pickup_heatmap")
def q_pickup_heatmap(spark, sf_dir):
    p = DEFAULT
    return st.round_doubles(
        ds.geo_heatmap(st.profile(spark, sf_dir), "pickup_longitude", "pickup_latitude", p.pickup_box, p.geo_bin_size)
    )


@register("dropoff_heatmap")
def q_dropoff_heatmap(spark, sf_dir):
    p = DEFAULT
    return st.round_doubles(
        ds.geo_heatmap(st.profile(spark, sf_dir), "dropoff_longitude", "dropoff_latitude", p.dropoff_box, p.geo_bin_size)
    )


@register("fare_distance_heatmap")
def q_fare_distance_heatmap(spark, sf_dir):
    return st.round_doubles(ds.fare_distance_heatmap(st.profile(spark, sf_dir)))


@register("heatmap_pivot")
def q_heatmap_pivot(spark, sf_dir):
    p = DEFAULT
    heat = ds.geo_heatmap(st.profile(spark, sf_dir), "pickup_longitude", "pickup_latitude", p.pickup_box, p.geo_bin_size)
    labels = ds.axis_labels(p.pickup_box.lon[0], p.pickup_box.lon[1], p.geo_bin_size)
    return st.round_doubles(ds.heatmap_pivot(heat, "lat_bin", "lat_center", "lon_bin", labels))


@register("dropoff_heatmap_pivot")
def q_dropoff_heatmap_pivot(spark, sf_dir):
    p = DEFAULT
    heat = ds.geo_heatmap(st.profile(spark, sf_dir), "dropoff_longitude", "dropoff_latitude", p.dropoff_box, p.geo_bin_size)
    labels = ds.axis_labels(p.dropoff_box.lon[0], p.dropoff_box.lon[1], p.geo_bin_size)
    return st.round_doubles(ds.heatmap_pivot(heat, "lat_bin", "lat_center", "lon_bin", labels))


@register("fare_distance_pivot")
def q_fare_distance_pivot(spark, sf_dir):
    p = DEFAULT
    heat = ds.fare_distance_heatmap(st.profile(spark, sf_dir))
    labels = ds.axis_labels(0.0, p.heat_distance_max, p.heat_distance_bin)
    return st.round_doubles(ds.heatmap_pivot(heat, "fare_bin", "fare_center", "dist_bin", labels))


# --- M10, A17-A19, P12-P13, K2, K5, M7, M11: errors and metrics ---------------


def _result(spark, sf_dir):
    return er.prediction_errors(st.scored(spark, sf_dir))


@register("prediction_errors")
def q_prediction_errors(spark, sf_dir):
    return st.round_doubles(_result(spark, sf_dir))


@register("error_categories")
def q_error_categories(spark, sf_dir):
    return st.round_doubles(er.error_categories(_result(spark, sf_dir)))


@register("error_summary")
def q_error_summary(spark, sf_dir):
    return st.round_doubles(er.error_summary(_result(spark, sf_dir), median="exact"))


@register("error_summary_approx", rows_only=True)
def q_error_summary_approx(spark, sf_dir):
    return er.error_summary(_result(spark, sf_dir), median="approx")


@register("error_describe")
def q_error_describe(spark, sf_dir):
    return st.round_doubles(er.error_describe(_result(spark, sf_dir)))


@register("best_predictions")
def q_best_predictions(spark, sf_dir):
    return st.round_doubles(er.best_predictions(_result(spark, sf_dir), DEFAULT_TOP_K))


@register("worst_predictions")
def q_worst_predictions(spark, sf_dir):
    return st.round_doubles(er.worst_predictions(_result(spark, sf_dir), DEFAULT_TOP_K))


@register("sample_rows")
def q_sample_rows(spark, sf_dir):
    return st.round_doubles(er.sample_rows(_result(spark, sf_dir), DEFAULT_SAMPLE_ROWS))


@register("regression_metrics")
def q_regression_metrics(spark, sf_dir):
    return st.round_doubles(md.regression_metrics(st.scored(spark, sf_dir)))


@register("baseline_improvement")
def q_baseline_improvement(spark, sf_dir):
    return st.round_doubles(md.baseline_improvement(md.regression_metrics(st.scored(spark, sf_dir))))


# --- M1-M9, M12-M13: models (small sizes; the full sizes stay Params defaults) --

ML = SMALL_MODELS


@contextmanager
def _persisted(df: DataFrame):
    """``df`` persisted (memory, spilling to disk) while a multi-pass report
    or fit runs, released afterwards. A lost block recomputes from lineage."""
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield df
    finally:
        df.unpersist()


@contextmanager
def _model_input(spark, sf_dir):
    """(train, test) vectors, kept once while the fits and the scoring read them."""
    _, frame = md.vectors(st.features(spark, sf_dir, ML, carry=("key",)), ML)
    with _persisted(frame) as kept:
        yield md.train_rows(kept), md.test_rows(kept)


def _small(df: DataFrame) -> DataFrame:
    """Bring a bounded result (metrics, a grid report) back as a local frame,
    so the persisted input can be released before the caller reads it."""
    return df.sparkSession.createDataFrame(df.collect(), df.schema)


def _fit_query(name: str, fit_fn):
    def q(spark, sf_dir):
        with _model_input(spark, sf_dir) as (train, test):
            return _small(md.model_comparison({name: fit_fn(train, ML)}, test))

    return q


@register("assembled_features")
def q_assembled_features(spark, sf_dir):
    out = md.assembler(ML.feature_cols).transform(st.features(spark, sf_dir))
    slots = vector_to_array("features_raw")
    return st.round_doubles(out.select("label", *[slots[i].alias(f"x_{c}") for i, c in enumerate(ML.feature_cols)]))


@register("scaled_features")
def q_scaled_features(spark, sf_dir):
    # two passes; the rows are the caller's to read, so nothing can be kept for them
    fe_df = st.features(spark, sf_dir)
    prep = md.prep_pipeline(ML.feature_cols).fit(fe_df)
    return st.round_doubles(md.scaled_columns(prep, fe_df, ML.feature_cols))


@register("linear_moments")
def q_linear_moments(spark, sf_dir):
    """What the linear grid is solved from: sums of products by fold, over train."""
    _, frame = md.vectors(st.features(spark, sf_dir, carry=("key",)), ML)
    # the sums run to the number of rows: compared as means
    found = mo.linear_moments(md.train_rows(frame), len(ML.feature_cols))
    n = F.max(F.when((F.col("a") == 0) & (F.col("b") == 0), F.col("value"))).over(Window.partitionBy("fold"))
    return st.round_doubles(found.select("fold", "a", "b", (F.col("value") / n).alias("mean"), n.cast("bigint").alias("rows")))


register("fit_linear", rows_only=True)(_fit_query("Linear", md.fit_linear))
register("fit_forest", rows_only=True)(_fit_query("RF", md.fit_forest))
register("fit_boosted", rows_only=True)(_fit_query("GBT", md.fit_boosted))


@register("model_comparison", rows_only=True)
def q_model_comparison(spark, sf_dir):
    with _model_input(spark, sf_dir) as (train, test):
        models = {"Linear": md.fit_linear(train, ML), "RF": md.fit_forest(train, ML), "GBT": md.fit_boosted(train, ML)}
        return _small(md.model_comparison(models, test))


@register("tune_forest", rows_only=True)
def q_tune_forest(spark, sf_dir):
    with _model_input(spark, sf_dir) as (train, test):
        cv, report = md.tune_forest(train, ML)
        return md.with_test_rmse(report, cv, test)


@register("tune_linear", rows_only=True)
def q_tune_linear(spark, sf_dir):
    with _model_input(spark, sf_dir) as (train, test):
        cv, report = md.tune_linear(train, ML)
        return md.with_test_rmse(report, cv, test)


@register("feature_importance", rows_only=True)
def q_feature_importance(spark, sf_dir):
    with _model_input(spark, sf_dir) as (train, _):
        return md.feature_importance(md.fit_forest(train, ML), ML.feature_cols)
