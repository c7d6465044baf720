"""Parameters of the trip study, as one frozen value passed to every operator.

Every number here is a fixed value that must equal the original study's for
equal results; nothing is read from the environment inside the operators.
``Params.from_env`` is the one place that honours the ``EDA_*`` overrides.
"""

from __future__ import annotations

import os
from dataclasses import dataclass, field, replace

# --- fixed values (must equal the original study) -------------------------
FEATURE_COLS = (
    "pickup_hour",
    "pickup_dow",
    "pickup_month",
    "pickup_year",
    "passenger_count",
    "distance_km",
)
PASSENGER_MIN = 1
PASSENGER_MAX = 6
EARTH_RADIUS_KM = 6371.0

# loose validity box used for cleaning (degrees)
LOOSE_LON = (-79.0, -71.0)
LOOSE_LAT = (38.0, 45.0)

# display box used by the profile (degrees)
EDA_FARE_MAX = 125.0
EDA_DISTANCE_MAX = 40.0
EDA_PICKUP_LON = (-74.3, -73.4)
EDA_PICKUP_LAT = (40.4, 41.0)
EDA_DROPOFF_LON = (-74.3, -73.4)
EDA_DROPOFF_LAT = (40.4, 41.0)

# bin widths
FARE_BIN_WIDTH = 1.0
DISTANCE_BIN_WIDTH = 0.5
GEO_BIN_SIZE = 0.01
HEAT_DISTANCE_BIN = 0.5
HEAT_FARE_BIN = 2.5

# error categories: (upper bound exclusive, label); the last label takes the rest
ERROR_CATEGORIES = (
    (1.0, "Excellent (<$1)"),
    (2.0, "Good ($1-$2)"),
    (5.0, "Fair ($2-$5)"),
    (10.0, "Poor ($5-$10)"),
)
ERROR_CATEGORY_REST = "Very Poor (>$10)"
ERROR_THRESHOLDS = (1.0, 2.0, 5.0)

# baseline linear metrics the tuned model is compared with
BASELINE_LINEAR = {"rmse": 5.8078, "mae": 2.4809, "r2": 0.5377}

# model settings
LINEAR_REG = 0.01
LINEAR_ELASTIC_NET = 0.0
FOREST_TREES = 120
FOREST_DEPTH = 14
BOOSTED_ROUNDS = 120
BOOSTED_DEPTH = 8
SEED = 42
TRAIN_FRACTION = 0.8
ROW_CAP = 200_000
FOREST_GRID = {"numTrees": (80,), "maxDepth": (10, 14)}
LINEAR_GRID = {"regParam": (0.0, 0.01, 0.1, 1.0), "elasticNetParam": (0.0, 0.5, 1.0)}
CV_FOLDS = 3
QUANTILE_PROBS = (0.25, 0.5, 0.75)
QUANTILE_REL_ERROR = 0.01
IQR_FACTOR = 1.5
SAMPLE_ROWS = 1000
TOP_K = 100
# --------------------------------------------------------------------------


@dataclass(frozen=True)
class Box:
    lon: tuple[float, float]
    lat: tuple[float, float]


@dataclass(frozen=True)
class Params:
    """All knobs of the study. Defaults are the original study's values."""

    feature_cols: tuple[str, ...] = FEATURE_COLS
    passenger_min: int = PASSENGER_MIN
    passenger_max: int = PASSENGER_MAX
    loose_box: Box = Box(LOOSE_LON, LOOSE_LAT)
    pickup_box: Box = Box(EDA_PICKUP_LON, EDA_PICKUP_LAT)
    dropoff_box: Box = Box(EDA_DROPOFF_LON, EDA_DROPOFF_LAT)
    fare_max: float = EDA_FARE_MAX
    distance_max: float = EDA_DISTANCE_MAX
    fare_bin_width: float = FARE_BIN_WIDTH
    distance_bin_width: float = DISTANCE_BIN_WIDTH
    geo_bin_size: float = GEO_BIN_SIZE
    heat_distance_bin: float = HEAT_DISTANCE_BIN
    heat_fare_bin: float = HEAT_FARE_BIN
    heat_distance_max: float = EDA_DISTANCE_MAX
    heat_fare_max: float = EDA_FARE_MAX
    quantile_probs: tuple[float, ...] = QUANTILE_PROBS
    quantile_rel_error: float = QUANTILE_REL_ERROR
    iqr_factor: float = IQR_FACTOR
    time_zone: str = "UTC"
    # models
    linear_reg: float = LINEAR_REG
    linear_elastic_net: float = LINEAR_ELASTIC_NET
    forest_trees: int = FOREST_TREES
    forest_depth: int = FOREST_DEPTH
    boosted_rounds: int = BOOSTED_ROUNDS
    boosted_depth: int = BOOSTED_DEPTH
    seed: int = SEED
    train_fraction: float = TRAIN_FRACTION
    cv_folds: int = CV_FOLDS
    forest_grid: dict = field(default_factory=lambda: dict(FOREST_GRID))
    linear_grid: dict = field(default_factory=lambda: dict(LINEAR_GRID))
    forest_parallelism: int = 1
    linear_parallelism: int = 2
    # None: fit on every valid row; an int caps the rows as the original did, by
    # their hash; a fraction keeps a deterministic hash sample instead
    fit_row_cap: int | None = None
    fit_fraction: float | None = None
    # "all" (original: scaler sees test rows too) or "train"
    scaler_fit_on: str = "all"
    baseline_linear: dict = field(default_factory=lambda: dict(BASELINE_LINEAR))

    def with_(self, **kw) -> "Params":
        return replace(self, **kw)

    @classmethod
    def from_env(cls, env: dict | None = None) -> "Params":
        """Apply the ``EDA_*`` environment overrides of the original profile step."""
        env = os.environ if env is None else env

        def f(name, default):
            return float(env.get(name, default))

        p = cls()
        return replace(
            p,
            fare_bin_width=f("EDA_FARE_BIN_WIDTH", p.fare_bin_width),
            distance_bin_width=f("EDA_DISTANCE_BIN_WIDTH", p.distance_bin_width),
            geo_bin_size=f("EDA_GEO_BIN_SIZE", p.geo_bin_size),
            heat_distance_bin=f("EDA_HEAT_DISTANCE_BIN", p.heat_distance_bin),
            heat_fare_bin=f("EDA_HEAT_FARE_BIN", p.heat_fare_bin),
            heat_distance_max=f("EDA_HEAT_DISTANCE_MAX", p.distance_max),
            heat_fare_max=f("EDA_HEAT_FARE_MAX", p.fare_max),
            pickup_box=Box(
                (f("EDA_PICKUP_LON_MIN", p.pickup_box.lon[0]), f("EDA_PICKUP_LON_MAX", p.pickup_box.lon[1])),
                (f("EDA_PICKUP_LAT_MIN", p.pickup_box.lat[0]), f("EDA_PICKUP_LAT_MAX", p.pickup_box.lat[1])),
            ),
            dropoff_box=Box(
                (f("EDA_DROPOFF_LON_MIN", p.dropoff_box.lon[0]), f("EDA_DROPOFF_LON_MAX", p.dropoff_box.lon[1])),
                (f("EDA_DROPOFF_LAT_MIN", p.dropoff_box.lat[0]), f("EDA_DROPOFF_LAT_MAX", p.dropoff_box.lat[1])),
            ),
        )


DEFAULT = Params()

# Small model sizes for registered queries and tests; full sizes stay the defaults.
SMALL_MODELS = DEFAULT.with_(
    forest_trees=10,
    forest_depth=5,
    boosted_rounds=5,
    boosted_depth=3,
    forest_grid={"numTrees": (5,), "maxDepth": (3, 5)},
    linear_grid=dict(LINEAR_GRID),
    cv_folds=3,
)
