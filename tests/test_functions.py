import math

from pyspark.sql import functions as F

from farelens.functions import error_category, error_columns, haversine_km, parse_time
from farelens.params import ERROR_CATEGORY_REST


def test_haversine_known_distance(spark):
    # one degree of latitude on the 6371 km sphere
    df = spark.createDataFrame(
        [(40.0, -74.0, 41.0, -74.0)], "pickup_latitude double, pickup_longitude double, dropoff_latitude double, dropoff_longitude double"
    )
    d = df.select(haversine_km().alias("d")).first()["d"]
    assert abs(d - 6371.0 * math.pi / 180) < 1e-9


def test_haversine_null_stays_null_and_nan_stays_nan(spark):
    df = spark.createDataFrame(
        [(None, -74.0, 41.0, -74.0), (float("nan"), -74.0, 41.0, -74.0), (40.0, -74.0, 40.0, -74.0)],
        "pickup_latitude double, pickup_longitude double, dropoff_latitude double, dropoff_longitude double",
    )
    rows = [r["d"] for r in df.select(haversine_km().alias("d")).collect()]
    assert rows[0] is None
    assert math.isnan(rows[1])
    assert rows[2] == 0.0


def test_haversine_antipodal_is_half_circumference(spark):
    df = spark.createDataFrame(
        [(0.0, 0.0, 0.0, 180.0)], "pickup_latitude double, pickup_longitude double, dropoff_latitude double, dropoff_longitude double"
    )
    d = df.select(haversine_km().alias("d")).first()["d"]
    assert abs(d - 6371.0 * math.pi) < 1e-6


def test_parse_time_bad_text_is_null_under_ansi(spark):
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    df = spark.createDataFrame([("2012-05-01 13:45:00 UTC",), ("not-a-time",), (None,), ("",)], "s string")
    got = [r["t"] for r in df.select(parse_time("s").alias("t")).collect()]
    assert got[0] is not None and got[0].hour == 13
    assert got[1:] == [None, None, None]


def test_error_columns_label_zero_gives_null_percentage(spark):
    df = spark.createDataFrame([(0.0, 3.0), (4.0, 5.0)], "label double, prediction double")
    rows = df.select(*[c.alias(n) for n, c in error_columns().items()]).collect()
    assert rows[0]["percentage_error"] is None and rows[0]["absolute_error"] == 3.0
    assert rows[1]["error"] == 1.0 and rows[1]["percentage_error"] == 25.0


def test_error_category_bounds_null_and_nan(spark):
    df = spark.createDataFrame([(0.99,), (1.0,), (4.999,), (9.99,), (10.0,), (None,), (float("nan"),)], "a double")
    got = [r["c"] for r in df.select(error_category("a").alias("c")).collect()]
    assert got[0].startswith("Excellent")
    assert got[1].startswith("Good")
    assert got[2].startswith("Fair")
    assert got[3].startswith("Poor")
    assert got[4:] == [ERROR_CATEGORY_REST] * 3


def test_functions_stay_in_jvm(spark):
    df = spark.createDataFrame([(40.0, -74.0, 41.0, -74.0)], "pickup_latitude double, pickup_longitude double, dropoff_latitude double, dropoff_longitude double")
    plan = df.select(haversine_km().alias("d"), error_category(F.lit(1.5)).alias("c"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan
