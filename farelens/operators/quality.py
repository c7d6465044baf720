"""Data-quality reports and key deduplication.

Each report is ONE aggregate over the input (partial aggregation on every
map task, a single-row final merge), reshaped to long form afterwards; the
original issued one job per count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import count_if, in_box, trip_in_box
from ..params import DEFAULT, Params

REQUIRED_COLS = (
    "fare_amount",
    "pickup_datetime_ts",
    "pickup_longitude",
    "pickup_latitude",
    "dropoff_longitude",
    "dropoff_latitude",
    "passenger_count",
)


def _long(wide: DataFrame, value_cols: list[str], total_col: str, name: str, value: str) -> DataFrame:
    """One-row wide counts -> (name, value, pct) rows, the total first
    (pct 100). A single ``explode`` over the one-row aggregate, so the
    input is scanned once."""
    total = F.col(total_col)

    def pct(c):
        return F.when(total > 0, F.col(c) * F.lit(100.0) / total).otherwise(F.lit(0.0))

    rows = [F.struct(F.lit(c).alias(name), F.col(c).alias(value), pct(c).alias("pct")) for c in [total_col, *value_cols]]
    return wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def quality_counts(df: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """One wide row: total, negative fares, passengers out of range or null,
    rows outside the loose box (a null coordinate counts only when another
    bound already fails), and nulls of the required columns."""
    pc = F.col("passenger_count")
    aggs = [
        F.count(F.lit(1)).alias("total_rows"),
        count_if(F.col("fare_amount") < 0).alias("fare_negative_rows"),
        count_if((pc < params.passenger_min) | (pc > params.passenger_max) | pc.isNull()).alias(
            "passenger_count_out_of_range"
        ),
        count_if(~trip_in_box(params.loose_box)).alias("geo_out_of_bounds_rows"),
    ]
    aggs += [count_if(F.col(c).isNull()).alias(f"{c}_nulls") for c in REQUIRED_COLS]
    return df.agg(*aggs)


def quality_report(df: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """(check, rows, pct) with the total as its own row (pct 100)."""
    wide = quality_counts(df, params)
    checks = [c for c in wide.columns if c != "total_rows"]
    return _long(wide, checks, "total_rows", "check", "rows")


def duplicate_keys(df: DataFrame, key: str = "key") -> DataFrame:
    """rows, distinct keys (null is one key value), duplicate rows.

    ``count(DISTINCT key)`` is planned as a two-level aggregate (group by key
    with map-side partial aggregation, then a global count), so a hot key is
    collapsed before the shuffle."""
    k = F.col(key)
    wide = df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct(k).alias("_nn"),
        F.max(k.isNull().cast("int")).alias("_has_null"),
    )
    return wide.select(
        "rows",
        (F.col("_nn") + F.coalesce(F.col("_has_null"), F.lit(0))).cast("bigint").alias("distinct_keys"),
    ).withColumn("duplicate_rows", F.col("rows") - F.col("distinct_keys"))


def distinct_keys(df: DataFrame, key: str = "key") -> DataFrame:
    return df.select(key).distinct()


def dedup_keys(df: DataFrame, key: str = "key", deterministic: bool = True) -> DataFrame:
    """One row per key; nulls form one group.

    ``deterministic=True`` keeps the smallest row of each key (all other
    columns compared in order, nulls first) via ``min(struct(...))``: a
    partial aggregate, so a key holding a third of all rows is reduced to one
    row per map task before the shuffle, and the survivor does not depend on
    the partition layout. ``deterministic=False`` is the original
    ``dropDuplicates`` (arbitrary survivor)."""
    if not deterministic:
        return df.dropDuplicates([key])
    others = [c for c in df.columns if c != key]
    if not others:
        return df.select(key).distinct()
    kept = df.groupBy(key).agg(F.min(F.struct(*[F.col(c) for c in others])).alias("_row"))
    return kept.select(*[F.col(key) if c == key else F.col(f"_row.{c}").alias(c) for c in df.columns])


def outside_box(df: DataFrame, params: Params = DEFAULT, more: list[Column] | None = None) -> DataFrame:
    """Rows whose pickup / dropoff lies outside the display box, and shares.

    Three-valued: a null coordinate makes the box test null, which is not
    counted unless another bound already fails. ``more``: further aggregates of
    the same pass."""
    wide = df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        count_if(~in_box("pickup_longitude", "pickup_latitude", params.pickup_box)).alias("pickup_outside"),
        count_if(~in_box("dropoff_longitude", "dropoff_latitude", params.dropoff_box)).alias("dropoff_outside"),
        *(more or []),
    )
    share = lambda c: F.when(F.col("total_rows") > 0, F.col(c) / F.col("total_rows"))
    return wide.select(
        "total_rows",
        "pickup_outside",
        "dropoff_outside",
        share("pickup_outside").alias("pickup_outside_share"),
        share("dropoff_outside").alias("dropoff_outside_share"),
        *[c for c in wide.columns if c not in ("total_rows", "pickup_outside", "dropoff_outside")],
    )


def stage_counts(trips: DataFrame, valid: Column, key: str = "key") -> DataFrame:
    """(stage, rows) for the input, the deduplicated rows and the valid rows,
    in ONE scan and one shuffle: the dedup aggregate also counts each key's
    rows, and one aggregate over the survivors sums those counts."""
    others = [c for c in trips.columns if c != key]
    kept = trips.groupBy(key).agg(
        F.count(F.lit(1)).alias("_n"), F.min(F.struct(*[F.col(c) for c in others])).alias("_row")
    )
    survivors = kept.select("_n", *[F.col(f"_row.{c}").alias(c) for c in others])
    wide = survivors.agg(
        F.sum("_n").cast("bigint").alias("trips"),
        F.count(F.lit(1)).alias("deduplicated"),
        count_if(valid).alias("valid_trips"),
    )
    return wide.select(
        F.explode(
            F.array(*[F.struct(F.lit(c).alias("stage"), F.col(c).alias("rows")) for c in ("trips", "deduplicated", "valid_trips")])
        ).alias("r")
    ).select("r.*")
