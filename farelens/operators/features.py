"""Feature derivation, the valid-trip filter, row caps and the train/test split.

Everything here is a narrow transformation (no shuffle). ``row_cap`` finds its cut
with a few aggregates first; only its ``first`` method, the original study's arbitrary
``limit``, funnels rows through a single partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import calendar_columns, haversine_km, trip_in_box
from ..params import DEFAULT, Params
from .quantiles import order_statistics

# bits of the hash that samples and splits compare with a fraction
HASH_BITS = 60
# hex digits of the hash that a cap ranks: a double holds such a number exactly
PLACE_DIGITS = 13


def add_distance(df: DataFrame, out: str = "distance_km") -> DataFrame:
    return df.withColumn(out, haversine_km())


def add_calendar(df: DataFrame, ts: str = "pickup_datetime_ts") -> DataFrame:
    return df.withColumns(calendar_columns(ts))


def profile_frame(raw: DataFrame) -> DataFrame:
    """The profile's working frame: raw trips + distance + calendar fields."""
    return add_calendar(add_distance(raw))


def valid_trip(params: Params = DEFAULT) -> Column:
    """Loose box on both ends, fare >= 0, passengers in range, parsed time.

    A null in any tested column fails the row. ``NaN >= 0`` is true in Spark,
    so a NaN fare passes, as it did originally."""
    return (
        trip_in_box(params.loose_box)
        & (F.col("fare_amount") >= 0)
        & F.col("passenger_count").between(params.passenger_min, params.passenger_max)
        & F.col("pickup_datetime_ts").isNotNull()
    )


def valid_trips(raw: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """Rows passing the filter. The plain-column predicates reach the parquet
    scan as pushed filters when ``raw`` is a parquet table."""
    return raw.where(valid_trip(params))


def feature_table(raw: DataFrame, params: Params = DEFAULT, carry: tuple[str, ...] = ()) -> DataFrame:
    """label + the six model features, in their fixed order; ``carry`` puts columns
    of the trip (its key, for the split) in front."""
    cal = calendar_columns("pickup_datetime_ts")
    return valid_trips(raw, params).select(
        *carry,
        F.col("fare_amount").alias("label"),
        *[cal[c].alias(c) for c in ("pickup_hour", "pickup_dow", "pickup_month", "pickup_year")],
        F.col("passenger_count"),
        haversine_km().alias("distance_km"),
    )


def filter_accounting(raw: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """Rows before the filter, after it, and dropped, in one scan."""
    passed = F.coalesce(valid_trip(params), F.lit(False))
    return raw.agg(
        F.count(F.lit(1)).alias("rows_before"),
        F.count_if(passed).alias("rows_after"),
    ).withColumn("rows_dropped", F.col("rows_before") - F.col("rows_after"))


def hourly_fares(features: DataFrame) -> DataFrame:
    """Trip count and mean fare per pickup hour (partial + final hash aggregate,
    24 groups: the shuffle carries at most 24 rows per map task)."""
    return (
        features.groupBy("pickup_hour")
        .agg(F.count(F.lit(1)).alias("trips"), F.avg("label").alias("mean_fare"))
        .orderBy("pickup_hour")
    )


def row_cap(df: DataFrame, n: int, cols: list[str] | None = None, method: str = "hash") -> DataFrame:
    """A subset of exactly ``n`` rows (all, if there are fewer).

    ``hash`` (default): the rows with the smallest hashes of ``cols`` (default: all).
    The n-th smallest hash is found by narrowing and the rows are filtered where they
    lie, so nothing passes through one partition and the subset does not depend on
    partitioning. Of rows with equal columns at the cut any are taken, as many as are
    due. ``first``: the original, the first n rows in any order, through one partition."""
    if method == "first":
        return df.limit(n)
    if n <= 0:
        return df.limit(0)
    place = _place(cols or df.columns, PLACE_DIGITS).alias("place")
    places = df.select(place.cast("double").alias("place"))
    rows = places.count()
    if rows <= n:
        return df
    found = order_statistics(places, ["place"], [(n - 1) / (rows - 1)], lambda _: {n - 1, n})[0][1]
    cut, after = int(found[n - 1]), int(found[n])
    if cut < after:
        return df.where(_place(cols or df.columns, PLACE_DIGITS) <= cut)
    below = df.where(_place(cols or df.columns, PLACE_DIGITS) < cut)
    equal = df.where(_place(cols or df.columns, PLACE_DIGITS) == cut)
    return below.unionByName(equal.limit(n - below.count()))


def _place(cols: list[str], digits: int, seed: int | str = "cap") -> Column:
    """The first hex digits of an MD5 over the seed and the columns, as a number."""
    text = F.concat_ws("\x1f", F.lit(str(seed)), *[F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in cols])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, digits), 16, 10).cast("bigint")


def below_fraction(cols: list[str], fraction: float, seed: int) -> Column:
    """True for about ``fraction`` of all values of ``cols``: the first 60 bits of
    an MD5 over the seed and the columns, compared with ``fraction * 2^60``."""
    return _place(cols, HASH_BITS // 4, seed) < F.lit(int(fraction * (1 << HASH_BITS)))


def hash_sample(df: DataFrame, fraction: float, cols: list[str] | None = None, seed: int = DEFAULT.seed) -> DataFrame:
    """Deterministic sample of about ``fraction`` of the rows; every partition
    filters its own rows, so no exchange and no single-partition funnel."""
    return df.where(below_fraction(cols or df.columns, fraction, seed))


def split_part(cols: list[str], train_fraction: float = DEFAULT.train_fraction, seed: int = DEFAULT.seed) -> Column:
    """The hash split as one column: "train" or "test" per row."""
    return F.when(below_fraction(cols, train_fraction, seed), F.lit("train")).otherwise(F.lit("test"))


def train_test_split(
    df: DataFrame,
    train_fraction: float = DEFAULT.train_fraction,
    seed: int = DEFAULT.seed,
    method: str = "hash",
    cols: list[str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Split into train and test.

    ``hash`` (default): a row goes to train when the hash of its columns falls
    below the fraction, so the split does not depend on partitioning and the
    halves are disjoint and complete. ``random``: the original
    ``randomSplit([f, 1-f], seed)``, which depends on the partition layout."""
    if method == "random":
        train, test = df.randomSplit([train_fraction, 1.0 - train_fraction], seed=seed)
        return train, test
    train = below_fraction(cols or df.columns, train_fraction, seed)
    return df.where(train), df.where(~train)
