"""Column profile: missing values, moments, IQR outliers, correlations, summary.

Every report is one aggregate pass (partial per map task, a one-row final
merge) reshaped to long form; the original ran one job per statistic
(49 for the correlation matrix alone).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType

from ..functions import count_if, is_missing
from ..params import DEFAULT, Params
from .quality import outside_box
from .quantiles import quantiles, within


def column_kinds(df: DataFrame) -> dict[str, str]:
    """numeric / string / other by data type (decimal counts as numeric)."""
    kinds = {}
    for f in df.schema.fields:
        if isinstance(f.dataType, NumericType):
            kinds[f.name] = "numeric"
        elif isinstance(f.dataType, StringType):
            kinds[f.name] = "string"
        else:
            kinds[f.name] = "other"
    return kinds


def numeric_columns(df: DataFrame) -> list[str]:
    return [c for c, k in column_kinds(df).items() if k == "numeric"]


def overview(df: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """One row, one pass: total_rows, the box counts and shares, and per column the
    missing count and (numeric) min, max, avg and sample stddev. The reports below
    are cut from it."""
    return outside_box(df, params, [*_missing_sums(df), *_extremes(numeric_columns(df)), *_moments(numeric_columns(df))])


def _missing_sums(df: DataFrame) -> list[Column]:
    return [count_if(is_missing(c, k)).alias(f"{c}_missing") for c, k in column_kinds(df).items()]


def _extremes(cols: list[str]) -> list[Column]:
    return [F.min(c).alias(f"{c}_min") for c in cols] + [F.max(c).alias(f"{c}_max") for c in cols]


def _moments(cols: list[str]) -> list[Column]:
    return [F.avg(c).alias(f"{c}_avg") for c in cols] + [F.stddev(c).alias(f"{c}_std") for c in cols]


def missing_values(df: DataFrame, row: DataFrame | None = None) -> DataFrame:
    """(column, missing_count, missing_pct). Numeric: null or NaN; string:
    null or blank after trim; other: null. ``row``: an ``overview`` of df."""
    row = row if row is not None else df.agg(F.count(F.lit(1)).alias("total_rows"), *_missing_sums(df))
    long = row.select("total_rows", *[F.col(f"{c}_missing").alias(c) for c in df.columns])
    long = long.unpivot(["total_rows"], list(df.columns), "column", "missing_count")
    pct = F.when(F.col("total_rows") > 0, F.col("missing_count") * F.lit(100.0) / F.col("total_rows"))
    return long.select("column", "missing_count", pct.alias("missing_pct"))


def numeric_min_max(df: DataFrame, cols: list[str] | None = None, row: DataFrame | None = None) -> DataFrame:
    """One wide row ``<c>_min ... <c>_max``; NaN sorts above all numbers."""
    cols = cols or numeric_columns(df)
    if row is None:
        return df.agg(*_extremes(cols))
    return row.select(*[f"{c}_{x}" for x in ("min", "max") for c in cols])


def numeric_avg_std(df: DataFrame, cols: list[str] | None = None, row: DataFrame | None = None) -> DataFrame:
    """One wide row ``<c>_avg ... <c>_std`` (sample stddev, null for one row)."""
    cols = cols or numeric_columns(df)
    if row is None:
        return df.agg(*_moments(cols))
    return row.select(*[f"{c}_{x}" for x in ("avg", "std") for c in cols])


def iqr_report(df: DataFrame, cols: list[str], params: Params = DEFAULT, method: str = "approx",
               blocks: int | None = None) -> DataFrame:
    """Per column: q1, median, q3, iqr, lower/upper fences, outlier rows.

    Two passes in all: the quantiles (one sketch aggregate, or the exact
    distributed rank), then ONE counting pass for every column, with all
    fences in a single broadcast row. Outliers: ``x < lower or x > upper``;
    NaN counts as above, null never."""
    probs = list(params.quantile_probs)
    kw = {"blocks": blocks} if blocks else {}
    q = quantiles(df, cols, probs, method, params.quantile_rel_error, **kw)

    def pick(c, p):
        return F.first(F.when((F.col("column") == c) & (F.col("prob") == p), F.col("value")), ignorenulls=True)

    names = ("q1", "median", "q3")
    fences = q.agg(*[pick(c, p).alias(f"{n}_{i}") for i, c in enumerate(cols) for n, p in zip(names, probs)])
    for i in range(len(cols)):
        iqr = F.col(f"q3_{i}") - F.col(f"q1_{i}")
        fences = fences.withColumns(
            {
                f"iqr_{i}": iqr,
                f"lower_{i}": F.col(f"q1_{i}") - params.iqr_factor * iqr,
                f"upper_{i}": F.col(f"q3_{i}") + params.iqr_factor * iqr,
            }
        )
    stats = [n for n in ("q1", "median", "q3", "iqr", "lower", "upper")]
    counted = df.crossJoin(F.broadcast(fences)).agg(
        F.count(F.lit(1)).alias("total_rows"),
        *[F.first(f"{n}_{i}").alias(f"{n}_{i}") for i in range(len(cols)) for n in stats],
        *[
            count_if((F.col(c) < F.col(f"lower_{i}")) | (F.col(c) > F.col(f"upper_{i}"))).alias(f"outliers_{i}")
            for i, c in enumerate(cols)
        ],
    )
    rows = [
        F.struct(
            F.lit(c).alias("column"),
            *[F.col(f"{n}_{i}").alias(n) for n in stats],
            F.col(f"outliers_{i}").alias("outliers"),
            F.when(F.col("total_rows") > 0, F.col(f"outliers_{i}") / F.col("total_rows")).alias("outlier_share"),
        )
        for i, c in enumerate(cols)
    ]
    return counted.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def iqr_proof(df: DataFrame, cols: list[str], params: Params = DEFAULT) -> DataFrame:
    """Per column of the approximate ``iqr_report``: rows, whether each of its quartiles
    is within the relative rank error, and whether the rows inside and outside its
    fences add up to the rows that have a value (NaN is outside, null neither)."""
    report = {r["column"]: r for r in iqr_report(df, cols, params, "approx").collect()}  # one row a column
    probs = list(params.quantile_probs)
    wide = []
    for i, c in enumerate(cols):
        x, r = F.col(c).cast("double"), report[c]
        clean = F.when(~F.isnan(x), x)
        wide += [F.count(x).alias(f"rows_{i}"), F.count(clean).alias(f"n_{i}")]
        wide.append(count_if(x.between(F.lit(r["lower"]).cast("double"), F.lit(r["upper"]).cast("double"))).alias(f"inside_{i}"))
        for j, name in enumerate(("q1", "median", "q3")):
            v = F.lit(r[name]).cast("double")
            wide += [count_if(clean < v).alias(f"b{i}_{j}"), count_if(clean <= v).alias(f"u{i}_{j}")]
    out = []
    for i, c in enumerate(cols):
        n = F.col(f"n_{i}")
        near = [within(n, F.col(f"b{i}_{j}"), F.col(f"u{i}_{j}"), p, params.quantile_rel_error) for j, p in enumerate(probs)]
        adds_up = F.col(f"inside_{i}") + F.lit(report[c]["outliers"]) == F.col(f"rows_{i}")
        cells = [F.lit(c).alias("column"), F.col(f"rows_{i}").alias("rows")]
        cells += [x.alias(f"{name}_within") for name, x in zip(("q1", "median", "q3"), near)]
        out.append(F.struct(*cells, adds_up.alias("outliers_add_up")))
    return df.agg(*wide).select(F.explode(F.array(*out)).alias("r")).select("r.*")


def correlation(df: DataFrame, cols: list[str], nulls: str = "zero", centers: dict[str, float] | None = None) -> DataFrame:
    """Pearson matrix in long form (col_a, col_b, corr) of the columns that exist.

    ``nulls="zero"`` reads null as 0, as ``DataFrame.stat.corr`` does;
    ``"skip"`` uses pairwise-complete rows. A constant column, NaN and null
    results give 0.0; an empty input gives 0.0 everywhere.

    One scan and one aggregate of plain sums and sums of products; no row is
    multiplied. For ``skip`` the rows are grouped by which columns are present, a bit
    each: every group has the same sums, and a pair adds up the groups that hold both,
    of which there are at most 2^columns. ``centers`` are subtracted first; a value
    near a column's mean keeps the digits of a column whose mean is large against its
    spread."""
    cols = [c for c in cols if c in df.columns]
    if not cols:
        return df.sparkSession.createDataFrame([], "col_a string, col_b string, corr double")
    pairs = [(i, j) for i in range(len(cols)) for j in range(i, len(cols))]
    raw = [F.col(c).cast("double") for c in cols]
    if nulls == "zero":
        raw = [F.coalesce(x, F.lit(0.0)) for x in raw]
    xs = [x - F.lit(float((centers or {}).get(c, 0.0))) for c, x in zip(cols, raw)]
    base = df.select(*[x.alias(f"x{i}") for i, x in enumerate(xs)])
    x = [F.col(f"x{i}") for i in range(len(cols))]
    z = x if nulls == "zero" else [F.coalesce(c, F.lit(0.0)) for c in x]
    sums = [F.count(F.lit(1)).alias("n")] + [F.sum(c).alias(f"s{i}") for i, c in enumerate(z)]
    sums += [F.sum(z[i] * z[j]).alias(f"p{i}_{j}") for i, j in pairs]
    limits = [f(c).alias(f"{n}{i}") for i, c in enumerate(x) for n, f in (("min", F.min), ("max", F.max))]
    if nulls == "zero":
        wide = base.agg(*sums, *limits)

        def part(i, j):
            return [F.col("n"), *[F.col(c) for c in (f"s{i}", f"s{j}", f"p{i}_{i}", f"p{j}_{j}", f"p{i}_{j}")]]
    else:
        present = sum((F.when(c.isNotNull(), F.lit(1 << i)).otherwise(F.lit(0)) for i, c in enumerate(x)), F.lit(0))
        masks = base.withColumn("mask", present).groupBy("mask").agg(*sums, *limits)
        added = [f(f"{n}{i}").alias(f"{n}{i}") for i in range(len(x)) for n, f in (("min", F.min), ("max", F.max))]
        for i, j in pairs:
            both = F.col("mask").bitwiseAND(F.lit(1 << i | 1 << j)) == F.lit(1 << i | 1 << j)
            own = ("n", f"s{i}", f"s{j}", f"p{i}_{i}", f"p{j}_{j}", f"p{i}_{j}")
            added += [F.sum(F.when(both, F.col(c))).alias(f"t{i}_{j}_{k}") for k, c in enumerate(own)]
        wide = masks.agg(*added)

        def part(i, j):
            return [F.col(f"t{i}_{j}_{k}") for k in range(6)]

    found = []
    for i, j in pairs:
        n, sa, sb, aa, bb, ab = part(i, j)
        spread = F.sqrt(F.greatest(n * aa - sa * sa, F.lit(0.0))) * F.sqrt(F.greatest(n * bb - sb * sb, F.lit(0.0)))
        fixed = (F.col(f"min{i}") == F.col(f"max{i}")) | (F.col(f"min{j}") == F.col(f"max{j}"))
        found.append(F.when(~fixed, F.try_divide(n * ab - sa * sb, spread)).alias(f"r{i}_{j}"))
    # a projection of its own, so that the rows below are made of plain columns
    wide = wide.select(*found)
    cells = []
    for i, j in pairs:
        r = F.coalesce(F.nanvl(F.col(f"r{i}_{j}"), F.lit(None).cast("double")), F.lit(0.0)).alias("corr")
        cells += [F.struct(F.lit(cols[a]).alias("col_a"), F.lit(cols[b]).alias("col_b"), r) for a, b in {(i, j), (j, i)}]
    return wide.select(F.explode(F.array(*cells)).alias("r")).select("r.*")


def profile_summary(
    df: DataFrame, params: Params = DEFAULT, method: str = "approx", row: DataFrame | None = None, iqr: DataFrame | None = None
) -> DataFrame:
    """(metric, value): totals, box violations and shares, IQR fences and
    outlier shares of fare and distance, total missing cells. ``row`` and ``iqr``:
    the ``overview`` and ``iqr_report`` of df where they are at hand."""
    row = row if row is not None else overview(df, params)
    iqr = iqr if iqr is not None else iqr_report(df, ["fare_amount", "distance_km"], params, method)
    miss = missing_values(df, row).agg(F.sum("missing_count").alias("missing_cells"))
    box_long = row.select(
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value"))
                    for m in ("total_rows", "pickup_outside", "pickup_outside_share", "dropoff_outside",
                              "dropoff_outside_share")
                ]
            )
        ).alias("r")
    ).select("r.*")
    short = {"fare_amount": "fare", "distance_km": "distance"}
    iqr_long = iqr.select(
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.concat(F.col("column"), F.lit(f"_{m}")).alias("metric"), F.col(m).cast("double").alias("value")
                    )
                    for m in ("lower", "upper", "outlier_share")
                ]
            )
        ).alias("r")
    ).select("r.*")
    iqr_long = iqr_long.replace(
        {f"{c}_{m}": f"{s}_iqr_{m}" for c, s in short.items() for m in ("lower", "upper", "outlier_share")},
        subset=["metric"],
    )
    miss_long = miss.select(F.lit("missing_cells").alias("metric"), F.col("missing_cells").cast("double").alias("value"))
    return box_long.unionByName(iqr_long).unionByName(miss_long)
