"""Plan checks and the driver contract."""

import duckdb
import pytest

import __spark_entry__ as E
from farelens.operators import features as fe
from farelens.operators import profile as pr
from farelens.operators import quality as qu
from farelens.plans import stages
from farelens.plans.catalog import QUERIES
from farelens.sources import read_parquet, write_parquet
from tests.conftest import SF_SMALL
from tools.oracle_check import TABLES, digest


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _formatted(df) -> str:
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def _scans(df) -> int:
    p = df._jdf.queryExecution().optimizedPlan().toString()
    return p.count("Relation [")


def test_entry_runs(spark):
    out = E.entry(spark)
    rows = out.collect()
    assert out.columns == ["pickup_hour", "trips", "mean_fare"]
    assert 0 < len(rows) <= 24


def test_contract_keys():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 50


@pytest.mark.parametrize("report", ["quality", "missing", "correlation"])
def test_one_scan_per_report(spark, report):
    prof = stages.profile(spark, SF_SMALL)
    df = {
        "quality": qu.quality_report(stages.raw(spark, SF_SMALL)),
        "missing": pr.missing_values(prof),
        "correlation": pr.correlation(prof, ["fare_amount", "distance_km", "pickup_hour"]),
    }[report]
    assert _scans(df) == 1
    assert "Python" not in _plan(df)


def test_filters_and_pruning_reach_parquet_scan(spark, tmp_out):
    path = f"{tmp_out}/raw.parquet"
    write_parquet(stages.raw(spark, SF_SMALL), path)
    feats = fe.feature_table(read_parquet(spark, path))
    plan = _formatted(feats)
    pushed = plan.split("PushedFilters:")[1].split("\n")[0]
    for f in ("GreaterThanOrEqual(fare_amount,0.0)", "LessThanOrEqual(passenger_count,6)",
              "GreaterThanOrEqual(pickup_longitude,-79.0)", "IsNotNull(pickup_datetime_ts)"):
        assert f in pushed
    schema = plan.split("ReadSchema:")[1].split("\n")[0]
    assert "key" not in schema and "pickup_datetime:" not in schema


def test_dedup_then_groupby_hour_single_exchange_each(spark):
    plan = _plan(E.entry(spark))
    # dedup exchange + hour aggregate exchange (+ final sort), no extra shuffles
    assert plan.count("Exchange hashpartitioning") <= 2


FAST = [
    "features",
    "hourly_fare",
    "quality_report",
    "dedup_keys",
    "missing_values",
    "hist_fare",
    "pickup_heatmap",
    "heatmap_pivot",
    "correlation",
    "iqr_exact",
    "error_summary",
    "error_categories",
    "worst_predictions",
    "monthly_trips",
]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    import os

    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


@pytest.mark.parametrize("name", FAST)
def test_oracle_agreement_sf0001(spark, duck, name):
    s = digest(E.queries()[name](spark, SF_SMALL).toPandas())
    o = digest(duck.sql(E.oracle_sql()[name]).df())
    assert s[0] == o[0] and s[1] == o[1]
    assert s[2] == o[2], (sorted(set(s[3]) - set(o[3]))[:3], sorted(set(o[3]) - set(s[3]))[:3])


# --- every registered plan: JVM only, no data joins, bounded broadcasts ------

# model fits return small local tables; their plans hold no data operators
MODEL_QUERIES = {"fit_linear", "fit_forest", "fit_boosted", "model_comparison", "tune_forest", "tune_linear",
                 "feature_importance"}
# grouped aggregates whose keys come from a fixed set, not from the data
FIXED_GROUPS = {"correlation": "column pairs", "correlation_skip": "column pairs"}


def _children(node):
    c = node.children()
    return [c.apply(i) for i in range(c.size())]


def _physical(df):
    p = df._jdf.queryExecution().executedPlan()
    return p.executedPlan() if p.nodeName() == "AdaptiveSparkPlan" else p


def _nodes(node):
    yield node
    for k in _children(node):
        yield from _nodes(k)


def _bounded(node, fixed_groups: bool) -> bool:
    """True when the subtree yields a number of rows that does not grow with
    the data: a global aggregate, a driver-made table, or (named queries only)
    an aggregate grouped by a fixed key set."""
    name = node.nodeName()
    if "Aggregate" in name and (node.groupingExpressions().size() == 0 or fixed_groups):
        return True
    if name in ("Scan ExistingRDD", "LocalTableScan"):
        return True
    kids = _children(node)
    return bool(kids) and all(_bounded(k, fixed_groups) for k in kids)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - MODEL_QUERIES))
def test_plan_is_jvm_only_with_bounded_broadcasts(spark, name):
    root = _physical(E.queries()[name](spark, SF_SMALL))
    names = [n.nodeName() for n in _nodes(root)]
    assert not [n for n in names if "Python" in n or "Pandas" in n], names
    assert "RoundRobinPartitioning" not in root.toString()
    assert not {"CartesianProduct", "SortMergeJoin", "ShuffledHashJoin"} & set(names), names
    for n in _nodes(root):
        if n.nodeName() == "BroadcastExchange":
            assert _bounded(n, name in FIXED_GROUPS), (name, n.toString()[:2000])
