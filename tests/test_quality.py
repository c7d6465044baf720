from farelens.operators import quality as qu

SCHEMA = (
    "key string, fare_amount double, pickup_datetime string, pickup_longitude double, pickup_latitude double, "
    "dropoff_longitude double, dropoff_latitude double, passenger_count int, pickup_datetime_ts timestamp"
)


def _row(key, fare=5.0, plon=-73.9, plat=40.7, dlon=-73.95, dlat=40.75, pc=1, ts=True):
    import datetime

    return (key, fare, "x", plon, plat, dlon, dlat, pc, datetime.datetime(2012, 1, 1, 10) if ts else None)


def test_quality_counts(spark):
    rows = [
        _row("a"),
        _row("b", fare=-1.0),
        _row("c", pc=None),
        _row("d", pc=7),
        _row("e", plon=None),  # null coordinate alone: box test null, not counted
        _row("f", plon=None, plat=50.0),  # another bound fails: counted
        _row("g", ts=False),
    ]
    w = qu.quality_counts(spark.createDataFrame(rows, SCHEMA)).first().asDict()
    assert w["total_rows"] == 7
    assert w["fare_negative_rows"] == 1
    assert w["passenger_count_out_of_range"] == 2
    assert w["geo_out_of_bounds_rows"] == 1
    assert w["pickup_longitude_nulls"] == 2
    assert w["pickup_datetime_ts_nulls"] == 1


def test_quality_report_long_form(spark):
    df = spark.createDataFrame([_row("a"), _row("b", fare=-2.0)], SCHEMA)
    rep = {r["check"]: (r["rows"], r["pct"]) for r in qu.quality_report(df).collect()}
    assert rep["total_rows"] == (2, 100.0)
    assert rep["fare_negative_rows"] == (1, 50.0)


def test_dedup_deterministic_keeps_smallest_row_nulls_first(spark):
    rows = [_row("k", fare=3.0), _row("k", fare=None), _row("k", fare=1.0), _row(None, fare=2.0), _row(None, fare=1.5)]
    out = {r["key"]: r["fare_amount"] for r in qu.dedup_keys(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert out == {"k": None, None: 1.5}


def test_dedup_hot_key_and_partition_independence(spark):
    rows = [_row("hot", fare=float(i % 97)) for i in range(3000)] + [_row(f"k{i}", fare=float(i)) for i in range(6000)]
    df = spark.createDataFrame(rows, SCHEMA)
    a = sorted(qu.dedup_keys(df.repartition(7)).collect())
    b = sorted(qu.dedup_keys(df.repartition(3, "fare_amount")).collect())
    assert a == b
    assert len(a) == 6001
    assert [r for r in a if r["key"] == "hot"][0]["fare_amount"] == 0.0


def test_dedup_plan_aggregates_before_shuffle(spark):
    df = spark.createDataFrame([_row("a"), _row("a")], SCHEMA)
    plan = qu.dedup_keys(df)._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan


def test_duplicate_keys_counts_null_as_one_key(spark):
    df = spark.createDataFrame([_row("a"), _row("a"), _row(None), _row(None), _row("b")], SCHEMA)
    r = qu.duplicate_keys(df).first()
    assert (r["rows"], r["distinct_keys"], r["duplicate_rows"]) == (5, 3, 2)
    assert qu.distinct_keys(df).count() == 3


def test_outside_box_three_valued(spark):
    rows = [_row("a"), _row("b", plon=-80.0), _row("c", plon=None), _row("d", dlat=41.5)]
    r = qu.outside_box(spark.createDataFrame(rows, SCHEMA)).first()
    assert r["total_rows"] == 4
    assert r["pickup_outside"] == 1
    assert r["dropoff_outside"] == 1
    assert r["pickup_outside_share"] == 0.25


def test_stage_counts_one_pass(spark):
    from pyspark.sql import functions as F

    rows = [_row("a"), _row("a", fare=9.0), _row("b", fare=-1.0), _row(None), _row(None, pc=9)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r["stage"]: r["rows"] for r in qu.stage_counts(df, F.col("fare_amount") >= 0).collect()}
    assert got == {"trips": 5, "deduplicated": 3, "valid_trips": 2}
