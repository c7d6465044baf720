"""Shared stage builders for registered queries: every query starts from the
given ``lineitem`` table, so its work grows with the data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from ..operators.features import feature_table, profile_frame
from ..operators.quality import dedup_keys
from ..params import DEFAULT, Params
from ..sources import testdata
from ..sources.trips import with_parsed_time


def trips_ts(spark: SparkSession, sf_dir: str, params: Params = DEFAULT) -> DataFrame:
    """Raw trips + parsed time, before deduplication. Calendar fields follow the
    session's time zone, which the entry point pins (``session.pin_time_zone``)."""
    return with_parsed_time(testdata.trips(spark, sf_dir))


def raw(spark: SparkSession, sf_dir: str, params: Params = DEFAULT) -> DataFrame:
    """The cleaned raw table: parsed time, one row per key."""
    return dedup_keys(trips_ts(spark, sf_dir, params))


def profile(spark: SparkSession, sf_dir: str, params: Params = DEFAULT) -> DataFrame:
    return profile_frame(raw(spark, sf_dir, params))


def features(spark: SparkSession, sf_dir: str, params: Params = DEFAULT, carry: tuple[str, ...] = ()) -> DataFrame:
    return feature_table(raw(spark, sf_dir, params), params, carry)


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return testdata.scored(spark, sf_dir)


def round_doubles(df: DataFrame, places: int = 6) -> DataFrame:
    """Round every floating column for engine-independent comparison."""
    return df.select(
        *[
            F.round(F.col(f"`{f.name}`"), places).alias(f.name)
            if isinstance(f.dataType, (DoubleType, FloatType))
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )
