"""Every operator over dirty rows with ANSI on: no runtime error, sane output."""

import math

import pytest

from farelens.operators import distributions as ds
from farelens.operators import errors as er
from farelens.operators import features as fe
from farelens.operators import profile as pr
from farelens.operators import quality as qu
from farelens.params import DEFAULT
from farelens.sources import with_parsed_time

INF, NAN = float("inf"), float("nan")
ROWS = [
    ("a", 5.0, "2012-01-01 10:00:00 UTC", -73.9, 40.7, -73.95, 40.75, 1),
    ("b", NAN, "2012-01-01 11:00:00 UTC", -73.9, 40.7, -73.95, 40.75, 2),
    ("c", 1e300, "  ", INF, 40.7, -73.95, -INF, 3),
    ("d", -1e300, "not-a-time", NAN, NAN, None, None, -5),
    ("e", 0.0, "", -1e300, 1e300, 1e300, -1e300, 2147483647),
    (" ", None, None, None, None, None, None, None),
    ("f", 7.5, "2013-06-30 23:59:59 UTC", -74.0, 40.8, -74.0, 40.8, 6),
]
SCHEMA = (
    "key string, fare_amount double, pickup_datetime string, pickup_longitude double, pickup_latitude double, "
    "dropoff_longitude double, dropoff_latitude double, passenger_count int"
)


@pytest.fixture(scope="module")
def dirty(spark):
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    raw = qu.dedup_keys(with_parsed_time(spark.createDataFrame(ROWS, SCHEMA)))
    return raw, fe.profile_frame(raw)


def test_quality_and_features_on_dirty_rows(dirty):
    raw, prof = dirty
    assert qu.quality_report(raw).count() == 11
    assert qu.outside_box(prof).first()["total_rows"] == 7
    feats = fe.feature_table(raw).collect()
    labels = sorted(r["label"] for r in feats if not math.isnan(r["label"]))
    assert labels == [5.0, 7.5]
    assert sum(1 for r in feats if math.isnan(r["label"])) == 1  # NaN >= 0 is true in Spark: a NaN fare passes
    assert fe.filter_accounting(raw).first()["rows_before"] == 7


def test_profile_on_dirty_rows(dirty):
    _, prof = dirty
    miss = {r["column"]: r["missing_count"] for r in pr.missing_values(prof).collect()}
    assert miss["fare_amount"] == 2 and miss["pickup_datetime"] == 3 and miss["key"] == 1
    pr.numeric_min_max(prof).collect()
    pr.numeric_avg_std(prof).collect()
    cells = pr.correlation(prof, ["fare_amount", *DEFAULT.feature_cols]).collect()
    assert len(cells) == 49 and all(not math.isnan(r["corr"]) for r in cells)
    pr.correlation(prof, ["fare_amount", "distance_km"], nulls="skip").collect()
    for method in ("approx", "exact"):
        rep = pr.iqr_report(prof, ["fare_amount", "distance_km"], method=method).collect()
        assert len(rep) == 2
    pr.profile_summary(prof, method="exact").collect()


def test_distributions_on_dirty_rows(dirty):
    _, prof = dirty
    for col, w in (("fare_amount", 1.0), ("distance_km", 0.5)):
        ds.histogram(prof, col, w, 0.0, 125.0).collect()
        ds.histogram(prof, col, w).collect()  # data range with +-1e300: bins filtered before the int cast
    ds.value_distribution(prof, "pickup_hour").collect()
    ds.passenger_distribution(prof).collect()
    ds.monthly_trips(prof).collect()
    ds.geo_heatmap(prof, "pickup_longitude", "pickup_latitude", DEFAULT.pickup_box, 0.01).collect()
    ds.fare_distance_heatmap(prof).collect()


def test_errors_on_dirty_rows(spark):
    pred = spark.createDataFrame(
        [(0.0, 1.0), (NAN, 2.0), (3.0, NAN), (None, 1.0), (1e300, -1e300), (5.0, 5.004)], "label double, prediction double"
    )
    res = er.prediction_errors(pred)
    res.collect()
    cats = {r["error_category"]: r["count"] for r in er.error_categories(res).collect()}
    assert sum(cats.values()) == 6
    er.error_summary(res, median="exact").collect()
    er.error_summary(res, median="approx").collect()
    er.error_describe(res).collect()
    assert len(er.worst_predictions(res, 3).collect()) == 3
