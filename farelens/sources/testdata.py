"""Trip-shaped inputs derived from the driver's TPC-H-like tables.

The testdata has no trips, so trips and scored predictions are derived from
``lineitem`` with integer arithmetic only (the same rules are written as
DuckDB SQL in ``plans/oracle.py``). The derivation is a narrow projection:
no shuffle, every column pruned to the five lineitem columns it needs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .trips import TRIP_COLUMNS


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns the derivations use."""
    cols = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice", "l_shipdate"]
    return table(spark, sf_dir, "lineitem").select(*cols)


def _d(x: float):
    return F.lit(float(x))


def trips_from_lineitem(lineitem: DataFrame) -> DataFrame:
    """Raw trips (8 columns). Covers negative and x3 fares, null and unparsable
    times, zero/null longitude, passenger 7 and null, repeated keys."""
    ok, pk, sk, ln = (F.col(c) for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"))
    price = F.col("l_extendedprice")

    def pad2(c):
        return F.lpad(c.cast("string"), 2, "0")

    fare_sign = F.when(pk % 97 == 0, F.lit(-1)).when(pk % 79 == 0, F.lit(3)).otherwise(F.lit(1))
    ts_text = F.concat(
        F.col("l_shipdate").cast("date").cast("string"),
        F.lit(" "),
        pad2(pk % 24),
        F.lit(":"),
        pad2(sk % 60),
        F.lit(":00 UTC"),
    )
    out = lineitem.select(
        F.concat(ok.cast("string"), F.lit("-"), ln.cast("string")).alias("key"),
        (fare_sign * price / _d(1000)).alias("fare_amount"),
        F.when(pk % 83 == 0, F.lit(None).cast("string"))
        .when(pk % 89 == 0, F.lit("not-a-time"))
        .otherwise(ts_text)
        .alias("pickup_datetime"),
        F.when(pk % 101 == 0, _d(0))
        .when(pk % 103 == 0, F.lit(None).cast("double"))
        .otherwise(_d(-74) - (pk % 350).cast("double") / _d(1000))
        .alias("pickup_longitude"),
        (_d(40) + (F.lit(400) + pk % 600).cast("double") / _d(1000)).alias("pickup_latitude"),
        (_d(-74) + ((sk * 7 + ok) % 600 - 300).cast("double") / _d(1000)).alias("dropoff_longitude"),
        (_d(40) + (F.lit(400) + (sk * 11 + ok) % 600).cast("double") / _d(1000)).alias("dropoff_latitude"),
        F.when(sk % 37 == 0, F.lit(None)).otherwise(ln).cast("int").alias("passenger_count"),
    )
    return out.select(*TRIP_COLUMNS)


def scored_from_lineitem(lineitem: DataFrame) -> DataFrame:
    """(label, prediction) before rounding; label 0 where ``l_partkey % 97 = 0``.
    Small offsets keep every value off a rounding tie."""
    pk, sk = F.col("l_partkey"), F.col("l_suppkey")
    label = F.when(pk % 97 == 0, _d(0)).otherwise(F.col("l_extendedprice") / _d(1000) + _d(0.000003))
    noise = ((sk * 7 + pk * 3) % 2400 - 1200).cast("double") / _d(100)
    return lineitem.select(label.alias("label"), (label + noise + _d(0.000001)).alias("prediction"))


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trips_from_lineitem(lineitem(spark, sf_dir))


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored_from_lineitem(lineitem(spark, sf_dir))
