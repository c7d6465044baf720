import glob
import json
import os

import pytest

from farelens.params import SMALL_MODELS, Params
from farelens.plans import fare_study
from farelens.sources import (
    EmptyInputError,
    TRIP_COLUMNS,
    read_trips_csv,
    require_rows,
    testdata,
    write_metrics_json,
    write_report_csv,
)
from tests.conftest import SF_SMALL


def test_typed_csv_scan_permissive(spark, tmp_out):
    path = os.path.join(tmp_out, "train.csv")
    with open(path, "w") as f:
        f.write("k,fare,when,plon,plat,dlon,dlat,pc\n")  # header names are ignored
        f.write("a,4.5,2012-01-01 10:00:00 UTC,-73.9,40.7,-73.95,40.75,1\n")
        f.write("b,oops,2012-01-01 11:00:00 UTC,-73.9,40.7,-73.95,40.75,2,extra\n")
        f.write("c,3.0,not-a-time,,40.7,-73.95,40.75,x\n")
    df = read_trips_csv(spark, path)
    assert tuple(df.columns) == TRIP_COLUMNS
    rows = {r["key"]: r for r in df.collect()}
    assert rows["a"]["fare_amount"] == 4.5 and rows["a"]["passenger_count"] == 1
    assert rows["b"]["fare_amount"] is None and rows["b"]["passenger_count"] == 2  # bad cell null, extra dropped
    assert rows["c"]["pickup_longitude"] is None and rows["c"]["passenger_count"] is None


def test_empty_input_guard(spark):
    empty = spark.createDataFrame([], "key string")
    with pytest.raises(EmptyInputError):
        require_rows(empty, "trips")
    one = spark.createDataFrame([("a",)], "key string")
    assert require_rows(one) is one


def test_report_sinks(spark, tmp_out):
    rep = spark.createDataFrame([("x", 1), ("y", 2)], "name string, n bigint")
    write_report_csv(rep, f"{tmp_out}/rep")
    files = glob.glob(f"{tmp_out}/rep/part-*.csv")
    assert len(files) == 1
    assert open(files[0]).read().splitlines()[0] == "name,n"
    write_report_csv(spark.createDataFrame([], "name string"), f"{tmp_out}/empty")
    assert not os.path.exists(f"{tmp_out}/empty")
    write_metrics_json(rep, f"{tmp_out}/metrics")
    lines = open(glob.glob(f"{tmp_out}/metrics/part-*.json")[0]).read().splitlines()
    assert [json.loads(x)["n"] for x in lines] == [1, 2]


def test_params_from_env_overrides():
    p = Params.from_env({"EDA_FARE_BIN_WIDTH": "2.0", "EDA_PICKUP_LON_MIN": "-75", "EDA_HEAT_FARE_MAX": "50"})
    assert p.fare_bin_width == 2.0 and p.pickup_box.lon == (-75.0, -73.4) and p.heat_fare_max == 50.0
    assert Params.from_env({}) == Params()


def test_end_to_end_study(spark, tmp_out):
    out = f"{tmp_out}/study"
    times = fare_study.run(spark, testdata.trips(spark, SF_SMALL), out, SMALL_MODELS)
    assert set(times) == {"clean", "profile", "features", "vectors", "models", "tuning", "error_analysis"}
    for d in ("raw.parquet", "fe.parquet", "train.parquet", "test.parquet", "prep_pipeline", "baseline_models/rf",
              "best_rf_model", "best_lr_model", "eda/correlation_matrix", "eda/summary", "quality",
              "predictions/predictions_full.parquet", "predictions/error_distribution", "feature_importance"):
        assert os.path.exists(f"{out}/{d}"), d
    raw = spark.read.parquet(f"{out}/raw.parquet")
    assert raw.count() == raw.select("key").distinct().count()
