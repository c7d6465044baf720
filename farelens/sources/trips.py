"""Trip records: the fixed raw schema and the readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType

from ..functions import parse_time

# fixed raw schema (column order is the CSV column order)
TRIP_SCHEMA = StructType(
    [
        StructField("key", StringType(), True),
        StructField("fare_amount", DoubleType(), True),
        StructField("pickup_datetime", StringType(), True),
        StructField("pickup_longitude", DoubleType(), True),
        StructField("pickup_latitude", DoubleType(), True),
        StructField("dropoff_longitude", DoubleType(), True),
        StructField("dropoff_latitude", DoubleType(), True),
        StructField("passenger_count", IntegerType(), True),
    ]
)
TRIP_COLUMNS = tuple(f.name for f in TRIP_SCHEMA.fields)


def read_trips_csv(spark: SparkSession, path: str) -> DataFrame:
    """Header CSV with the fixed schema applied by position (nothing inferred).

    PERMISSIVE mode: a bad cell becomes null, extra cells are dropped, header
    names are ignored. The CSV reader splits files, so a large input is read
    in parallel; the schema avoids the inference pass."""
    return spark.read.csv(path, header=True, schema=TRIP_SCHEMA, mode="PERMISSIVE")


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def with_parsed_time(trips: DataFrame, out: str = "pickup_datetime_ts") -> DataFrame:
    """Raw trips plus the parsed pickup time (null when unparsable)."""
    return trips.withColumn(out, parse_time("pickup_datetime"))
