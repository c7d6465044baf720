"""Independent DuckDB SQL for every oracle-checked query.

The text is written against the pre-registered ``lineitem`` view and shares
only the fixed parameter values with the Spark side, not its logic. DuckDB
specifics: ``dayofweek`` is 0-based (add 1); ``hour``/``month``/``year`` and
integer sums are BIGINT/HUGEINT (cast); division by zero gives inf (use
``nullif``); every floating output is rounded to 6 places, as in the catalog.
"""

from __future__ import annotations

from ..params import DEFAULT, FEATURE_COLS, ROW_CAP, SAMPLE_ROWS

P = DEFAULT


def d(x: float) -> str:
    """A DOUBLE literal (a bare decimal literal is DECIMAL in DuckDB)."""
    return f"CAST({float(x)!r} AS DOUBLE)"


def r6(expr: str, alias: str) -> str:
    return f"round({expr}, 6) AS {alias}"


TRIPS = """
trips AS (
  SELECT concat(CAST(l_orderkey AS VARCHAR), '-', CAST(l_linenumber AS VARCHAR)) AS key,
    CASE WHEN l_partkey % 97 = 0 THEN -1 WHEN l_partkey % 79 = 0 THEN 3 ELSE 1 END
      * l_extendedprice / CAST(1000 AS DOUBLE) AS fare_amount,
    CASE WHEN l_partkey % 83 = 0 THEN NULL
         WHEN l_partkey % 89 = 0 THEN 'not-a-time'
         ELSE concat(CAST(CAST(l_shipdate AS DATE) AS VARCHAR), ' ',
                     lpad(CAST(l_partkey % 24 AS VARCHAR), 2, '0'), ':',
                     lpad(CAST(l_suppkey % 60 AS VARCHAR), 2, '0'), ':00 UTC') END AS pickup_datetime,
    CASE WHEN l_partkey % 101 = 0 THEN CAST(0 AS DOUBLE)
         WHEN l_partkey % 103 = 0 THEN NULL
         ELSE CAST(-74 AS DOUBLE) - CAST(l_partkey % 350 AS DOUBLE) / CAST(1000 AS DOUBLE) END AS pickup_longitude,
    CAST(40 AS DOUBLE) + CAST(400 + l_partkey % 600 AS DOUBLE) / CAST(1000 AS DOUBLE) AS pickup_latitude,
    CAST(-74 AS DOUBLE) + CAST((l_suppkey * 7 + l_orderkey) % 600 - 300 AS DOUBLE) / CAST(1000 AS DOUBLE) AS dropoff_longitude,
    CAST(40 AS DOUBLE) + CAST(400 + (l_suppkey * 11 + l_orderkey) % 600 AS DOUBLE) / CAST(1000 AS DOUBLE) AS dropoff_latitude,
    CAST(CASE WHEN l_suppkey % 37 = 0 THEN NULL ELSE l_linenumber END AS INTEGER) AS passenger_count
  FROM lineitem
)"""

RAW_COLS = (
    "key, fare_amount, pickup_datetime, pickup_longitude, pickup_latitude, "
    "dropoff_longitude, dropoff_latitude, passenger_count, pickup_datetime_ts"
)

TRIPS_TS = """
trips_ts AS (
  SELECT *, try_cast(replace(pickup_datetime, ' UTC', '') AS TIMESTAMP) AS pickup_datetime_ts FROM trips
)"""

# one row per key: the smallest row, all columns in order, nulls first
RAW = f"""
raw AS (
  SELECT {RAW_COLS} FROM (
    SELECT *, row_number() OVER (PARTITION BY key ORDER BY
      fare_amount ASC NULLS FIRST, pickup_datetime ASC NULLS FIRST,
      pickup_longitude ASC NULLS FIRST, pickup_latitude ASC NULLS FIRST,
      dropoff_longitude ASC NULLS FIRST, dropoff_latitude ASC NULLS FIRST,
      passenger_count ASC NULLS FIRST, pickup_datetime_ts ASC NULLS FIRST) AS rn
    FROM trips_ts) z
  WHERE rn = 1
)"""

PROFILE_COLS = RAW_COLS + ", distance_km, pickup_hour, pickup_dow, pickup_month, pickup_year"

PROFILE = f"""
hav AS (
  SELECT *, power(sin(radians(dropoff_latitude - pickup_latitude) / 2), 2)
      + cos(radians(pickup_latitude)) * cos(radians(dropoff_latitude))
      * power(sin(radians(dropoff_longitude - pickup_longitude) / 2), 2) AS a0
  FROM raw
),
prof AS (
  SELECT {RAW_COLS},
    CAST(6371 AS DOUBLE) * 2 * atan2(sqrt(abs(a0)), sqrt(abs(1 - a0))) AS distance_km,
    CAST(hour(pickup_datetime_ts) AS INTEGER) AS pickup_hour,
    CAST(dayofweek(pickup_datetime_ts) + 1 AS INTEGER) AS pickup_dow,
    CAST(month(pickup_datetime_ts) AS INTEGER) AS pickup_month,
    CAST(year(pickup_datetime_ts) AS INTEGER) AS pickup_year
  FROM hav
)"""


def loose_ok(prefix: str = "") -> str:
    lo, la = P.loose_box.lon, P.loose_box.lat
    return (
        f"({prefix}pickup_longitude BETWEEN {d(lo[0])} AND {d(lo[1])} "
        f"AND {prefix}dropoff_longitude BETWEEN {d(lo[0])} AND {d(lo[1])} "
        f"AND {prefix}pickup_latitude BETWEEN {d(la[0])} AND {d(la[1])} "
        f"AND {prefix}dropoff_latitude BETWEEN {d(la[0])} AND {d(la[1])})"
    )


VALID = (
    f"{loose_ok()} AND fare_amount >= 0 AND passenger_count BETWEEN {P.passenger_min} AND {P.passenger_max} "
    "AND pickup_datetime_ts IS NOT NULL"
)

FEATURES = f"""
feat AS (
  SELECT fare_amount AS label, pickup_hour, pickup_dow, pickup_month, pickup_year, passenger_count, distance_km
  FROM prof WHERE {VALID}
)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


BASE = (TRIPS, TRIPS_TS)
RAW_BASE = BASE + (RAW,)
PROF_BASE = RAW_BASE + (PROFILE,)
FEAT_BASE = PROF_BASE + (FEATURES,)

ORACLE: dict[str, str] = {}

ORACLE["parse_time"] = with_(*BASE) + "SELECT key, pickup_datetime, pickup_datetime_ts FROM trips_ts"

ORACLE["calendar_features"] = (
    with_(*PROF_BASE) + "SELECT key, pickup_hour, pickup_dow, pickup_month, pickup_year FROM prof"
)

ORACLE["haversine"] = with_(*PROF_BASE) + f"SELECT key, {r6('distance_km', 'distance_km')} FROM prof"

ORACLE["features"] = with_(*FEAT_BASE) + (
    f"SELECT {r6('label', 'label')}, pickup_hour, pickup_dow, pickup_month, pickup_year, passenger_count, "
    f"{r6('distance_km', 'distance_km')} FROM feat"
)

ORACLE["valid_trips"] = with_(*PROF_BASE) + (
    "SELECT key, round(fare_amount, 6) AS fare_amount, pickup_datetime, "
    "round(pickup_longitude, 6) AS pickup_longitude, round(pickup_latitude, 6) AS pickup_latitude, "
    "round(dropoff_longitude, 6) AS dropoff_longitude, round(dropoff_latitude, 6) AS dropoff_latitude, "
    f"passenger_count, pickup_datetime_ts FROM raw WHERE {VALID}"
)

ORACLE["filter_accounting"] = with_(*RAW_BASE) + (
    "SELECT count(*) AS rows_before, "
    f"CAST(sum(CASE WHEN {VALID} THEN 1 ELSE 0 END) AS BIGINT) AS rows_after, "
    f"CAST(count(*) - sum(CASE WHEN {VALID} THEN 1 ELSE 0 END) AS BIGINT) AS rows_dropped FROM raw"
)

ORACLE["hourly_fare"] = with_(*FEAT_BASE) + (
    "SELECT pickup_hour, count(*) AS trips, round(avg(label), 6) AS mean_fare FROM feat "
    "GROUP BY pickup_hour ORDER BY pickup_hour"
)

assert tuple(FEATURE_COLS) == (
    "pickup_hour",
    "pickup_dow",
    "pickup_month",
    "pickup_year",
    "passenger_count",
    "distance_km",
)


# --- quality ------------------------------------------------------------------

ORACLE["row_counts"] = with_(*PROF_BASE) + (
    "SELECT 'trips' AS stage, count(*) AS rows FROM trips_ts "
    "UNION ALL SELECT 'deduplicated' AS stage, count(*) AS rows FROM raw "
    f"UNION ALL SELECT 'valid_trips' AS stage, count(*) AS rows FROM raw WHERE {VALID}"
)

ORACLE["duplicate_keys"] = with_(*BASE) + (
    "SELECT rows, distinct_keys, rows - distinct_keys AS duplicate_rows FROM ("
    "SELECT count(*) AS rows, (SELECT count(*) FROM (SELECT DISTINCT key FROM trips_ts) k) AS distinct_keys "
    "FROM trips_ts) z"
)

ORACLE["distinct_keys"] = with_(*BASE) + "SELECT DISTINCT key FROM trips_ts"

ORACLE["dedup_keys"] = with_(*RAW_BASE) + (
    "SELECT key, round(fare_amount, 6) AS fare_amount, pickup_datetime, "
    "round(pickup_longitude, 6) AS pickup_longitude, round(pickup_latitude, 6) AS pickup_latitude, "
    "round(dropoff_longitude, 6) AS dropoff_longitude, round(dropoff_latitude, 6) AS dropoff_latitude, "
    "passenger_count, pickup_datetime_ts FROM raw"
)

_REQ = (
    "fare_amount",
    "pickup_datetime_ts",
    "pickup_longitude",
    "pickup_latitude",
    "dropoff_longitude",
    "dropoff_latitude",
    "passenger_count",
)
_QCHECKS = [
    ("fare_negative_rows", "fare_amount < 0"),
    (
        "passenger_count_out_of_range",
        f"passenger_count < {P.passenger_min} OR passenger_count > {P.passenger_max} OR passenger_count IS NULL",
    ),
    ("geo_out_of_bounds_rows", f"NOT {loose_ok()}"),
] + [(f"{c}_nulls", f"{c} IS NULL") for c in _REQ]

ORACLE["quality_report"] = (
    with_(
        *RAW_BASE,
        "\nq AS (SELECT count(*) AS total_rows, "
        + ", ".join(f"sum(CASE WHEN {cond} THEN 1 ELSE 0 END) AS {name}" for name, cond in _QCHECKS)
        + " FROM raw)",
    )
    + "SELECT 'total_rows' AS \"check\", total_rows AS rows, "
    "CASE WHEN total_rows > 0 THEN CAST(100 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS pct FROM q"
    + "".join(
        f" UNION ALL SELECT '{name}' AS \"check\", CAST({name} AS BIGINT) AS rows, "
        f"round(CASE WHEN total_rows > 0 THEN {name} * CAST(100 AS DOUBLE) / total_rows ELSE 0 END, 6) AS pct FROM q"
        for name, _ in _QCHECKS
    )
)


def _box_ok(lon: str, lat: str, box) -> str:
    return (
        f"({lon} BETWEEN {d(box.lon[0])} AND {d(box.lon[1])} AND {lat} BETWEEN {d(box.lat[0])} AND {d(box.lat[1])})"
    )


ORACLE["outside_box"] = with_(*PROF_BASE) + (
    "SELECT total_rows, pickup_outside, dropoff_outside, "
    "round(pickup_outside / total_rows, 6) AS pickup_outside_share, "
    "round(dropoff_outside / total_rows, 6) AS dropoff_outside_share FROM ("
    "SELECT count(*) AS total_rows, "
    f"CAST(sum(CASE WHEN NOT {_box_ok('pickup_longitude', 'pickup_latitude', P.pickup_box)} THEN 1 ELSE 0 END) AS BIGINT) AS pickup_outside, "
    f"CAST(sum(CASE WHEN NOT {_box_ok('dropoff_longitude', 'dropoff_latitude', P.dropoff_box)} THEN 1 ELSE 0 END) AS BIGINT) AS dropoff_outside "
    "FROM prof) z"
)

# --- profile ------------------------------------------------------------------

# profile frame columns and their kinds, written out for the oracle
_KINDS = [
    ("key", "string"),
    ("fare_amount", "numeric"),
    ("pickup_datetime", "string"),
    ("pickup_longitude", "numeric"),
    ("pickup_latitude", "numeric"),
    ("dropoff_longitude", "numeric"),
    ("dropoff_latitude", "numeric"),
    ("passenger_count", "numeric"),
    ("pickup_datetime_ts", "other"),
    ("distance_km", "numeric"),
    ("pickup_hour", "numeric"),
    ("pickup_dow", "numeric"),
    ("pickup_month", "numeric"),
    ("pickup_year", "numeric"),
]
_NUMERIC = [c for c, k in _KINDS if k == "numeric"]
_DOUBLES = {"fare_amount", "pickup_longitude", "pickup_latitude", "dropoff_longitude", "dropoff_latitude", "distance_km"}


def _missing(c: str, kind: str) -> str:
    if kind == "numeric":
        return f"{c} IS NULL OR isnan(CAST({c} AS DOUBLE))"
    if kind == "string":
        return f"{c} IS NULL OR trim({c}) = ''"
    return f"{c} IS NULL"


ORACLE["missing_values"] = with_(*PROF_BASE) + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", CAST(sum(CASE WHEN {_missing(c, k)} THEN 1 ELSE 0 END) AS BIGINT) AS missing_count, "
    f"round(sum(CASE WHEN {_missing(c, k)} THEN 1 ELSE 0 END) * CAST(100 AS DOUBLE) / count(*), 6) AS missing_pct FROM prof"
    for c, k in _KINDS
)


def _r(expr: str, c: str, alias: str) -> str:
    return f"round({expr}, 6) AS {alias}" if c in _DOUBLES else f"{expr} AS {alias}"


ORACLE["numeric_min_max"] = with_(*PROF_BASE) + (
    "SELECT "
    + ", ".join(_r(f"min({c})", c, f"{c}_min") for c in _NUMERIC)
    + ", "
    + ", ".join(_r(f"max({c})", c, f"{c}_max") for c in _NUMERIC)
    + " FROM prof"
)

ORACLE["numeric_avg_std"] = with_(*PROF_BASE) + (
    "SELECT "
    + ", ".join(f"round(avg({c}), 6) AS {c}_avg" for c in _NUMERIC)
    + ", "
    + ", ".join(f"round(stddev_samp({c}), 6) AS {c}_std" for c in _NUMERIC)
    + " FROM prof"
)

_IQR_COLS = ("fare_amount", "distance_km")
_EXACT_PROBS = (0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 0.99, 1.0)

ORACLE["quantiles_exact"] = with_(*PROF_BASE) + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", {d(p)} AS prob, round(quantile_cont({c}, {p!r}), 6) AS value "
    f"FROM prof WHERE {c} IS NOT NULL AND NOT isnan({c})"
    for c in _IQR_COLS
    for p in _EXACT_PROBS
)


ORACLE["quantiles_approx"] = with_(*PROF_BASE) + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", {d(p)} AS prob, count(*) AS rows, true AS within FROM prof WHERE {c} IS NOT NULL AND NOT isnan({c})"
    for c in _IQR_COLS
    for p in P.quantile_probs
)
ORACLE["iqr_approx"] = with_(*PROF_BASE) + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count({c}) AS rows, true AS q1_within, true AS median_within, true AS q3_within, "
    "true AS outliers_add_up FROM prof"
    for c in _IQR_COLS
)


def _iqr_cte() -> str:
    parts = []
    for c in _IQR_COLS:
        parts.append(
            f"SELECT '{c}' AS col, quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.5) AS median, "
            f"quantile_cont({c}, 0.75) AS q3 FROM prof WHERE {c} IS NOT NULL AND NOT isnan({c})"
        )
    fences = (
        "\nqs AS (" + " UNION ALL ".join(parts) + "),"
        f"\nfences AS (SELECT col, q1, median, q3, q3 - q1 AS iqr, q1 - {d(P.iqr_factor)} * (q3 - q1) AS lower, "
        f"q3 + {d(P.iqr_factor)} * (q3 - q1) AS upper FROM qs),"
    )
    outl = " UNION ALL ".join(
        f"SELECT '{c}' AS col, CAST(sum(CASE WHEN p.{c} < f.lower OR p.{c} > f.upper THEN 1 ELSE 0 END) AS BIGINT) AS outliers, "
        f"count(*) AS total_rows FROM prof p CROSS JOIN (SELECT * FROM fences WHERE col = '{c}') f"
        for c in _IQR_COLS
    )
    return fences + "\nouts AS (" + outl + ")"


ORACLE["iqr_exact"] = with_(*PROF_BASE, _iqr_cte()) + (
    "SELECT f.col AS \"column\", round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3, "
    "round(iqr, 6) AS iqr, round(lower, 6) AS lower, round(upper, 6) AS upper, outliers, "
    "round(outliers / total_rows, 6) AS outlier_share FROM fences f JOIN outs o ON f.col = o.col"
)

_CORR_COLS = ("fare_amount",) + tuple(FEATURE_COLS)


def _corr_sql(nulls: str) -> str:
    pairs = [(a, b) for i, a in enumerate(_CORR_COLS) for b in _CORR_COLS[i:]]
    aggs = []
    for k, (a, b) in enumerate(pairs):
        if nulls == "zero":
            x, y = f"coalesce(CAST({a} AS DOUBLE), 0)", f"coalesce(CAST({b} AS DOUBLE), 0)"
        else:
            x = f"CASE WHEN {b} IS NOT NULL THEN CAST({a} AS DOUBLE) END"
            y = f"CASE WHEN {a} IS NOT NULL THEN CAST({b} AS DOUBLE) END"
        aggs.append(f"covar_pop({x}, {y}) / nullif(stddev_pop({x}) * stddev_pop({y}), 0) AS r{k}")
    index = {}
    for k, (a, b) in enumerate(pairs):
        index[(a, b)] = index[(b, a)] = f"r{k}"
    cells = " UNION ALL ".join(
        f"SELECT '{a}' AS col_a, '{b}' AS col_b, "
        f"round(CASE WHEN {index[(a, b)]} IS NULL OR isnan({index[(a, b)]}) THEN 0 ELSE {index[(a, b)]} END, 6) AS corr FROM w"
        for a in _CORR_COLS
        for b in _CORR_COLS
    )
    return with_(*PROF_BASE, "\nw AS (SELECT " + ", ".join(aggs) + " FROM prof)") + cells


ORACLE["correlation"] = _corr_sql("zero")
ORACLE["correlation_skip"] = _corr_sql("skip")

_MISSING_TOTAL = " + ".join(f"sum(CASE WHEN {_missing(c, k)} THEN 1 ELSE 0 END)" for c, k in _KINDS)

ORACLE["profile_summary"] = with_(
    *PROF_BASE,
    _iqr_cte(),
    "\nbox AS (SELECT count(*) AS total_rows, "
    f"sum(CASE WHEN NOT {_box_ok('pickup_longitude', 'pickup_latitude', P.pickup_box)} THEN 1 ELSE 0 END) AS po, "
    f"sum(CASE WHEN NOT {_box_ok('dropoff_longitude', 'dropoff_latitude', P.dropoff_box)} THEN 1 ELSE 0 END) AS dout, "
    f"{_MISSING_TOTAL} AS miss FROM prof)",
) + (
    "SELECT 'total_rows' AS metric, round(CAST(total_rows AS DOUBLE), 6) AS value FROM box "
    "UNION ALL SELECT 'pickup_outside', round(CAST(po AS DOUBLE), 6) FROM box "
    "UNION ALL SELECT 'pickup_outside_share', round(po / total_rows, 6) FROM box "
    "UNION ALL SELECT 'dropoff_outside', round(CAST(dout AS DOUBLE), 6) FROM box "
    "UNION ALL SELECT 'dropoff_outside_share', round(dout / total_rows, 6) FROM box "
    "UNION ALL SELECT 'missing_cells', round(CAST(miss AS DOUBLE), 6) FROM box "
    + "".join(
        f"UNION ALL SELECT '{s}_iqr_lower', round(lower, 6) FROM fences WHERE col = '{c}' "
        f"UNION ALL SELECT '{s}_iqr_upper', round(upper, 6) FROM fences WHERE col = '{c}' "
        f"UNION ALL SELECT '{s}_iqr_outlier_share', round(outliers / total_rows, 6) FROM outs WHERE col = '{c}' "
        for c, s in (("fare_amount", "fare"), ("distance_km", "distance"))
    )
)

# --- distributions ------------------------------------------------------------

ORACLE["hour_distribution"] = with_(*PROF_BASE) + (
    "SELECT pickup_hour, count(*) AS count FROM prof GROUP BY pickup_hour ORDER BY pickup_hour NULLS FIRST"
)

ORACLE["passenger_distribution"] = with_(*PROF_BASE) + (
    "SELECT passenger_count, count(*) AS count FROM prof "
    f"WHERE passenger_count BETWEEN {P.passenger_min} AND {P.passenger_max} "
    "GROUP BY passenger_count ORDER BY passenger_count"
)

ORACLE["monthly_trips"] = with_(*PROF_BASE) + (
    "SELECT pickup_year, pickup_month, count(*) AS count, "
    "CASE WHEN pickup_year IS NOT NULL AND pickup_month IS NOT NULL "
    "THEN CAST(pickup_year AS VARCHAR) || '-' || lpad(CAST(pickup_month AS VARCHAR), 2, '0') END AS label "
    "FROM prof GROUP BY pickup_year, pickup_month ORDER BY pickup_year NULLS FIRST, pickup_month NULLS FIRST"
)


def _hist_sql(col: str, width: float, lo: float, hi: float) -> str:
    """Histogram with a fixed range: bins = ceil((hi - lo) / width), ids 0..bins."""
    import math

    bins = max(1, int(math.ceil((hi - lo) / width)))
    b = f"floor(({col} - {d(lo)}) / {d(width)})"
    return with_(*PROF_BASE) + (
        f"SELECT CAST(bin_id AS INTEGER) AS bin_id, count(*) AS count, "
        f"round({d(lo)} + bin_id * {d(width)}, 6) AS bin_left, "
        f"round({d(lo)} + bin_id * {d(width)} + {d(width)}, 6) AS bin_right, "
        f"round((({d(lo)} + bin_id * {d(width)}) + ({d(lo)} + bin_id * {d(width)} + {d(width)})) / 2, 6) AS bin_mid "
        f"FROM (SELECT {b} AS bin_id FROM prof WHERE {col} IS NOT NULL) z "
        f"WHERE bin_id >= 0 AND bin_id <= {bins} GROUP BY bin_id ORDER BY bin_id"
    )


ORACLE["hist_fare"] = _hist_sql("fare_amount", P.fare_bin_width, 0.0, P.heat_fare_max)
ORACLE["hist_distance"] = _hist_sql("distance_km", P.distance_bin_width, 0.0, P.heat_distance_max)

ORACLE["hist_fare_data_range"] = with_(
    *PROF_BASE,
    "\nrng AS (SELECT lo, CASE WHEN hi <= lo THEN lo + 1.0 ELSE hi END AS hi FROM ("
    "SELECT coalesce(min(fare_amount), 0) AS lo, coalesce(max(fare_amount), 0) AS hi FROM prof "
    "WHERE NOT isnan(fare_amount)) z),"
    "\nrb AS (SELECT lo, greatest(1, CAST(ceil((hi - lo) / 1.0) AS INTEGER)) AS bins FROM rng)",
) + (
    "SELECT CAST(bin_id AS BIGINT) AS bin_id, count(*) AS count, round(lo + bin_id * 1.0, 6) AS bin_left, "
    "round(lo + bin_id * 1.0 + 1.0, 6) AS bin_right, "
    "round(((lo + bin_id * 1.0) + (lo + bin_id * 1.0 + 1.0)) / 2, 6) AS bin_mid "
    "FROM (SELECT floor((fare_amount - lo) / 1.0) AS bin_id, lo, bins FROM prof CROSS JOIN rb "
    "WHERE fare_amount IS NOT NULL) z WHERE bin_id >= 0 AND bin_id <= bins GROUP BY bin_id, lo ORDER BY bin_id"
).replace("1.0", d(P.fare_bin_width))


def _geo_sql(lon: str, lat: str, box) -> str:
    s = d(P.geo_bin_size)
    return with_(*PROF_BASE) + (
        f"SELECT lat_bin, lon_bin, count(*) AS count, "
        f"round({d(box.lon[0])} + (lon_bin + {d(0.5)}) * {s}, 6) AS lon_center, "
        f"round({d(box.lat[0])} + (lat_bin + {d(0.5)}) * {s}, 6) AS lat_center FROM ("
        f"SELECT CAST(floor(({lon} - {d(box.lon[0])}) / {s}) AS INTEGER) AS lon_bin, "
        f"CAST(floor(({lat} - {d(box.lat[0])}) / {s}) AS INTEGER) AS lat_bin FROM prof "
        f"WHERE {_box_ok(lon, lat, box)}) z GROUP BY lat_bin, lon_bin"
    )


ORACLE["pickup_heatmap"] = _geo_sql("pickup_longitude", "pickup_latitude", P.pickup_box)
ORACLE["dropoff_heatmap"] = _geo_sql("dropoff_longitude", "dropoff_latitude", P.dropoff_box)

ORACLE["fare_distance_heatmap"] = with_(*PROF_BASE) + (
    f"SELECT fare_bin, dist_bin, count(*) AS count, "
    f"round((dist_bin + {d(0.5)}) * {d(P.heat_distance_bin)}, 6) AS dist_center, "
    f"round((fare_bin + {d(0.5)}) * {d(P.heat_fare_bin)}, 6) AS fare_center FROM ("
    f"SELECT CAST(floor(distance_km / {d(P.heat_distance_bin)}) AS INTEGER) AS dist_bin, "
    f"CAST(floor(fare_amount / {d(P.heat_fare_bin)}) AS INTEGER) AS fare_bin FROM prof "
    f"WHERE distance_km >= 0 AND distance_km <= {d(P.heat_distance_max)} "
    f"AND fare_amount >= 0 AND fare_amount <= {d(P.heat_fare_max)}) z GROUP BY fare_bin, dist_bin"
)


def _pivot_sql(row: tuple[str, str, float, float, float], column: tuple[str, str, float, float, float]) -> str:
    """(result name, source column, low, high, bin size) of each axis."""
    (rn, rc, r0, r1, rs), (_, cc, c0, c1, cs) = row, column
    n = int((c1 - c0) // cs)
    cols = ", ".join(
        f"CAST(sum(CASE WHEN cb = {b} THEN cnt ELSE 0 END) AS BIGINT) AS \"{round(c0 + (b + 0.5) * cs, 4)!r}\"" for b in range(n + 1)
    )
    return with_(*PROF_BASE) + (
        f"SELECT round({d(r0)} + (rb + {d(0.5)}) * {d(rs)}, 4) AS {rn}, {cols} FROM ("
        f"SELECT rb, cb, count(*) AS cnt FROM (SELECT CAST(floor(({rc} - {d(r0)}) / {d(rs)}) AS INTEGER) AS rb, "
        f"CAST(floor(({cc} - {d(c0)}) / {d(cs)}) AS INTEGER) AS cb FROM prof "
        f"WHERE {rc} BETWEEN {d(r0)} AND {d(r1)} AND {cc} BETWEEN {d(c0)} AND {d(c1)}) b GROUP BY rb, cb) g GROUP BY rb"
    )


def _geo_axes(end: str, box) -> tuple:
    return ("lat_center", f"{end}_latitude", *box.lat, P.geo_bin_size), ("lon_center", f"{end}_longitude", *box.lon, P.geo_bin_size)


ORACLE["heatmap_pivot"] = _pivot_sql(*_geo_axes("pickup", P.pickup_box))
ORACLE["dropoff_heatmap_pivot"] = _pivot_sql(*_geo_axes("dropoff", P.dropoff_box))
ORACLE["fare_distance_pivot"] = _pivot_sql(
    ("fare_center", "fare_amount", 0.0, P.heat_fare_max, P.heat_fare_bin),
    ("dist_center", "distance_km", 0.0, P.heat_distance_max, P.heat_distance_bin),
)



def _counts_sql() -> str:
    """The eight distributions, each counted on its own."""
    parts = [
        "SELECT 'pickup_hour_distribution' AS report, pickup_hour AS a, CAST(NULL AS BIGINT) AS b, count(*) AS count FROM prof GROUP BY pickup_hour",
        "SELECT 'trips_per_month', pickup_year, pickup_month, count(*) FROM prof GROUP BY pickup_year, pickup_month",
        f"SELECT 'passenger_distribution', passenger_count, NULL, count(*) FROM prof "
        f"WHERE passenger_count BETWEEN {P.passenger_min} AND {P.passenger_max} GROUP BY passenger_count",
    ]
    for name, c, w, hi in (("hist_fare_amount", "fare_amount", P.fare_bin_width, P.heat_fare_max), ("hist_distance_km", "distance_km", P.distance_bin_width, P.heat_distance_max)):
        parts.append(
            f"SELECT '{name}', CAST(bin AS BIGINT), NULL, count(*) FROM (SELECT floor({c} / {d(w)}) AS bin FROM prof WHERE {c} IS NOT NULL) z "
            f"WHERE bin >= 0 AND bin <= {max(1, -int(-hi // w))} GROUP BY bin"
        )
    heat = {
        "pickup_heatmap": _geo_axes("pickup", P.pickup_box),
        "dropoff_heatmap": _geo_axes("dropoff", P.dropoff_box),
        "fare_distance_heatmap": (
            ("fare", "fare_amount", 0.0, P.heat_fare_max, P.heat_fare_bin), ("dist", "distance_km", 0.0, P.heat_distance_max, P.heat_distance_bin)
        ),
    }
    for name, ((_, rc, r0, r1, rs), (_, cc, c0, c1, cs)) in heat.items():
        parts.append(
            f"SELECT '{name}', CAST(floor(({rc} - {d(r0)}) / {d(rs)}) AS BIGINT) AS x, CAST(floor(({cc} - {d(c0)}) / {d(cs)}) AS BIGINT) AS y, count(*) "
            f"FROM prof WHERE {rc} BETWEEN {d(r0)} AND {d(r1)} AND {cc} BETWEEN {d(c0)} AND {d(c1)} GROUP BY x, y"
        )
    return with_(*PROF_BASE) + "SELECT report, CAST(a AS BIGINT) AS a, CAST(b AS BIGINT) AS b, count FROM (" + " UNION ALL ".join(parts) + ") u"


ORACLE["profile_counts"] = _counts_sql()

# --- errors and metrics -------------------------------------------------------

SCORED = """
scored AS (
  SELECT CASE WHEN l_partkey % 97 = 0 THEN CAST(0 AS DOUBLE)
              ELSE l_extendedprice / CAST(1000 AS DOUBLE) + CAST(0.000003 AS DOUBLE) END AS label,
    CASE WHEN l_partkey % 97 = 0 THEN CAST(0 AS DOUBLE)
         ELSE l_extendedprice / CAST(1000 AS DOUBLE) + CAST(0.000003 AS DOUBLE) END
      + CAST((l_suppkey * 7 + l_partkey * 3) % 2400 - 1200 AS DOUBLE) / CAST(100 AS DOUBLE)
      + CAST(0.000001 AS DOUBLE) AS prediction
  FROM lineitem
),
res AS (
  SELECT round(label, 2) AS label, round(prediction, 2) AS prediction, round(prediction - label, 2) AS error,
    round(abs(prediction - label), 2) AS absolute_error,
    round(abs(prediction - label) / nullif(label, 0) * 100, 2) AS percentage_error
  FROM scored
)"""

_RES_COLS = "label, prediction, error, absolute_error, percentage_error"

ORACLE["prediction_errors"] = with_(SCORED) + f"SELECT {_RES_COLS} FROM res"

_CAT = (
    "CASE WHEN absolute_error < 1.0 THEN 'Excellent (<$1)' WHEN absolute_error < 2.0 THEN 'Good ($1-$2)' "
    "WHEN absolute_error < 5.0 THEN 'Fair ($2-$5)' WHEN absolute_error < 10.0 THEN 'Poor ($5-$10)' "
    "ELSE 'Very Poor (>$10)' END"
)

ORACLE["error_categories"] = with_(SCORED) + (
    f"SELECT error_category, count(*) AS count, round(round(count(*) / sum(count(*)) OVER () * 100, 2), 6) AS percentage "
    f"FROM (SELECT {_CAT} AS error_category FROM res) z GROUP BY error_category ORDER BY count DESC"
)

ORACLE["error_summary"] = with_(SCORED) + (
    "SELECT count(*) AS total_predictions, round(avg(abs(error)), 6) AS mean_absolute_error, "
    "round(quantile_cont(absolute_error, 0.5), 6) AS median_absolute_error, "
    "round(max(absolute_error), 6) AS max_error, round(min(absolute_error), 6) AS min_error, "
    "round(avg(percentage_error), 6) AS mean_percentage_error, "
    + ", ".join(
        f"CAST(sum(CASE WHEN absolute_error < {t} THEN 1 ELSE 0 END) AS BIGINT) AS predictions_within_{n}"
        for t, n in ((1.0, "1_dollar"), (2.0, "2_dollars"), (5.0, "5_dollars"))
    )
    + ", "
    + ", ".join(
        f"round(round(sum(CASE WHEN absolute_error < {t} THEN 1 ELSE 0 END) / count(*) * 100, 2), 6) AS pct_within_{n}"
        for t, n in ((1.0, "1_dollar"), (2.0, "2_dollars"), (5.0, "5_dollars"))
    )
    + " FROM res"
)

ORACLE["error_describe"] = with_(SCORED, "\nw AS (SELECT abs(error) AS a, percentage_error AS p FROM res)") + " UNION ALL ".join(
    f"SELECT '{name}' AS summary, round({fa}, 6) AS abs_error, round({fp}, 6) AS percentage_error FROM w"
    for name, fa, fp in (
        ("count", "CAST(count(a) AS DOUBLE)", "CAST(count(p) AS DOUBLE)"),
        ("mean", "avg(a)", "avg(p)"),
        ("stddev", "stddev_samp(a)", "stddev_samp(p)"),
        ("min", "min(a)", "min(p)"),
        ("max", "max(a)", "max(p)"),
    )
)

ORACLE["best_predictions"] = with_(SCORED) + (
    f"SELECT {_RES_COLS} FROM res ORDER BY absolute_error ASC NULLS FIRST, label ASC NULLS FIRST, "
    f"prediction ASC NULLS FIRST, error ASC NULLS FIRST, percentage_error ASC NULLS FIRST LIMIT 100"
)

ORACLE["sample_rows"] = with_(SCORED) + (
    f"SELECT {_RES_COLS} FROM res ORDER BY {', '.join(c + ' ASC NULLS FIRST' for c in _RES_COLS.split(', '))} LIMIT {SAMPLE_ROWS}"
)

ORACLE["worst_predictions"] = with_(SCORED) + (
    f"SELECT {_RES_COLS} FROM res ORDER BY absolute_error DESC NULLS LAST, label ASC NULLS FIRST, "
    f"prediction ASC NULLS FIRST, error ASC NULLS FIRST, percentage_error ASC NULLS FIRST LIMIT 100"
)

_METRICS_CTE = (
    "\nm AS (SELECT sqrt(avg(power(prediction - label, 2))) AS rmse, avg(abs(prediction - label)) AS mae, "
    "1 - sum(power(prediction - label, 2)) / nullif(var_pop(label) * count(label), 0) AS r2 FROM scored)"
)

ORACLE["regression_metrics"] = with_(SCORED, _METRICS_CTE) + (
    "SELECT round(rmse, 6) AS rmse, round(mae, 6) AS mae, round(r2, 6) AS r2 FROM m"
)

ORACLE["baseline_improvement"] = with_(SCORED, _METRICS_CTE) + " UNION ALL ".join(
    f"SELECT '{k}' AS metric, round({d(v)}, 6) AS baseline, round({k}, 6) AS measured, "
    f"round({'(' + d(v) + ' - ' + k + ')' if k != 'r2' else '(' + k + ' - ' + d(v) + ')'} / {d(v)} * 100, 6) AS improvement_pct FROM m"
    for k, v in P.baseline_linear.items()
)

# --- models -------------------------------------------------------------------

# z-score with the sample standard deviation; a zero-std feature gives 0
ORACLE["scaled_features"] = with_(*FEAT_BASE) + (
    "SELECT round(label, 6) AS label, "
    + ", ".join(
        f"round(CASE WHEN stddev_samp({c}) OVER () = 0 OR stddev_samp({c}) OVER () IS NULL THEN 0 "
        f"ELSE ({c} - avg({c}) OVER ()) / stddev_samp({c}) OVER () END, 6) AS z_{c}"
        for c in FEATURE_COLS
    )
    + " FROM feat"
)


# --- S1, K4, K5, G3, M1: scan, samples, split, assembly ----------------------

ORACLE["csv_scan"] = with_(TRIPS) + (
    "SELECT key, CASE WHEN o % 7 = 0 THEN NULL ELSE round(fare_amount, 6) END AS fare_amount, pickup_datetime, "
    "round(pickup_longitude, 6) AS pickup_longitude, round(pickup_latitude, 6) AS pickup_latitude, "
    "round(dropoff_longitude, 6) AS dropoff_longitude, "
    "CASE WHEN o % 11 = 0 THEN NULL ELSE round(dropoff_latitude, 6) END AS dropoff_latitude, passenger_count "
    "FROM (SELECT *, CAST(split_part(key, '-', 1) AS BIGINT) AS o FROM trips) z"
)


def _below(fraction: float, seed: int) -> str:
    """The key's place by the first 60 bits of an MD5."""
    return f"CAST(('0x' || substr(md5('{seed}' || chr(31) || key), 1, 15)) AS BIGINT) < {int(fraction * (1 << 60))}"


KEYED = PROF_BASE + (f"\nkeyed AS (SELECT key, fare_amount AS label, {', '.join(FEATURE_COLS)} FROM prof WHERE {VALID})",)
_KEYED_COLS = f"key, {r6('label', 'label')}, {', '.join(FEATURE_COLS[:-1])}, {r6('distance_km', 'distance_km')}"

ORACLE["hash_sample"] = with_(*KEYED) + f"SELECT {_KEYED_COLS} FROM keyed WHERE {_below(0.5, P.seed)}"
ORACLE["train_test_split"] = with_(*KEYED) + (
    f"SELECT {_KEYED_COLS}, CASE WHEN {_below(P.train_fraction, P.seed)} THEN 'train' ELSE 'test' END AS part FROM keyed"
)
ORACLE["row_cap"] = with_(*KEYED) + (
    f"SELECT {_KEYED_COLS} FROM keyed ORDER BY substr(md5('cap' || chr(31) || key), 1, 13), key LIMIT {ROW_CAP // 50}"
)
ORACLE["assembled_features"] = with_(*FEAT_BASE) + (
    "SELECT round(label, 6) AS label, " + ", ".join(f"round(CAST({c} AS DOUBLE), 6) AS x_{c}" for c in FEATURE_COLS) + " FROM feat"
)


def _moments_sql() -> str:
    """Standardised features of all rows, folds and split by the key's MD5."""
    z = [
        f"CASE WHEN stddev_samp({c}) OVER () = 0 OR stddev_samp({c}) OVER () IS NULL THEN 0 "
        f"ELSE ({c} - avg({c}) OVER ()) / stddev_samp({c}) OVER () END AS x{i}"
        for i, c in enumerate(FEATURE_COLS, 1)
    ]
    k = P.cv_folds
    fold = "CASE " + "".join(f"WHEN {_below((i + 1) / k, P.seed + 2)} THEN {i} " for i in range(k - 1)) + f"ELSE {k - 1} END"
    last = len(FEATURE_COLS) + 1
    cells = [(a, b) for a in range(last + 1) for b in range(a, last + 1)]
    return with_(
        *KEYED,
        f"\nvec AS (SELECT key, CAST(1 AS DOUBLE) AS x0, {', '.join(z)}, label AS x{last} FROM keyed)",
        f"\ntrn AS (SELECT *, {fold} AS fold FROM vec WHERE {_below(P.train_fraction, P.seed)})",
        "\nsums AS (SELECT fold, count(*) AS rows, " + ", ".join(f"avg(x{a} * x{b}) AS m{a}_{b}" for a, b in cells) + " FROM trn GROUP BY fold)",
    ) + " UNION ALL ".join(f"SELECT fold, {a} AS a, {b} AS b, round(m{a}_{b}, 6) AS mean, rows FROM sums" for a, b in cells)


ORACLE["linear_moments"] = _moments_sql()
ORACLE["written_counts"] = with_(*KEYED) + f"SELECT count(*) AS rows, CAST({len(FEATURE_COLS) + 2} AS BIGINT) AS columns, true AS same FROM keyed"
