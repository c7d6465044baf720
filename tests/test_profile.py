import random
from decimal import Decimal

import numpy as np
from pyspark.sql import functions as F

from farelens.operators import profile as pr
from farelens.operators import quantiles as qn


def test_missing_values_by_kind(spark):
    df = spark.createDataFrame(
        [(1.0, "a", Decimal("1.50"), 1), (float("nan"), "  ", None, None), (None, None, Decimal("2.00"), 3)],
        "x double, s string, dec decimal(10,2), i int",
    )
    got = {r["column"]: (r["missing_count"], r["missing_pct"]) for r in pr.missing_values(df).collect()}
    assert got["x"][0] == 2  # null and NaN
    assert got["s"][0] == 2  # null and blank
    assert got["dec"][0] == 1  # decimal counts as numeric
    assert got["i"][0] == 1
    assert abs(got["x"][1] - 200 / 3) < 1e-9
    assert pr.column_kinds(df)["dec"] == "numeric"


def test_min_max_avg_std(spark):
    df = spark.createDataFrame([(1.0, 2), (3.0, 4)], "a double, b int")
    mm = pr.numeric_min_max(df).first()
    assert (mm["a_min"], mm["a_max"], mm["b_min"], mm["b_max"]) == (1.0, 3.0, 2, 4)
    av = pr.numeric_avg_std(df).first()
    assert av["a_avg"] == 2.0 and abs(av["a_std"] - np.std([1.0, 3.0], ddof=1)) < 1e-12
    one = pr.numeric_avg_std(df.limit(1)).first()
    assert one["a_std"] is None


def test_correlation_symmetric_unit_diagonal_constant_zero(spark):
    rnd = random.Random(3)
    rows = [(float(i), float(i) * 2 + rnd.random(), 5.0, (None if i % 5 == 0 else float(i))) for i in range(200)]
    df = spark.createDataFrame(rows, "a double, b double, c double, n double")
    cells = {(r["col_a"], r["col_b"]): r["corr"] for r in pr.correlation(df, ["a", "b", "c", "n"]).collect()}
    assert len(cells) == 16
    for (x, y), v in cells.items():
        assert abs(v - cells[(y, x)]) < 1e-12
    assert abs(cells[("a", "a")] - 1.0) < 1e-9 and abs(cells[("b", "b")] - 1.0) < 1e-9
    assert cells[("c", "c")] == 0.0 and cells[("a", "c")] == 0.0
    a = np.array([r[0] for r in rows])
    n0 = np.array([r[3] or 0.0 for r in rows])
    assert abs(cells[("a", "n")] - np.corrcoef(a, n0)[0, 1]) < 1e-9
    skip = {(r["col_a"], r["col_b"]): r["corr"] for r in pr.correlation(df, ["a", "n"], nulls="skip").collect()}
    assert abs(skip[("a", "n")] - 1.0) < 1e-9


def _np_percentile(xs, p):
    return float(np.percentile(np.array(xs), p * 100, method="linear"))


def test_exact_quantiles_match_numpy_with_hot_value(spark):
    rnd = random.Random(7)
    xs = [rnd.gauss(10, 3) for _ in range(3000)] + [4.25] * 1500  # one value holds a third of the rows
    xs += [float(rnd.randint(0, 20)) for _ in range(500)]
    df = spark.createDataFrame([(x,) for x in xs] + [(None,), (float("nan"),)], "x double")
    probs = [0.0, 0.01, 0.25, 0.3333, 0.5, 0.75, 0.99, 1.0]
    got = {r["prob"]: r["value"] for r in qn.exact_quantiles(df, ["x"], probs, blocks=16).collect()}
    for p in probs:
        assert abs(got[p] - _np_percentile(xs, p)) < 1e-9, p


def test_exact_quantiles_small_and_empty(spark):
    one = spark.createDataFrame([(3.0,)], "x double")
    assert {r["prob"]: r["value"] for r in qn.exact_quantiles(one, ["x"], [0.25, 0.5]).collect()} == {0.25: 3.0, 0.5: 3.0}
    empty = spark.createDataFrame([], "x double")
    got = qn.exact_quantiles(empty, ["x"], [0.5]).collect()
    assert len(got) == 1 and got[0]["value"] is None


def test_exact_quantiles_independent_of_block_count(spark):
    rnd = random.Random(11)
    xs = [float(rnd.randint(0, 50)) for _ in range(2000)]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    a = sorted(qn.exact_quantiles(df, ["x"], [0.1, 0.5, 0.9], blocks=1).collect())
    b = sorted(qn.exact_quantiles(df, ["x"], [0.1, 0.5, 0.9], blocks=64).collect())
    assert a == b


def test_approx_quantiles_within_rank_error(spark):
    rnd = random.Random(5)
    xs = sorted(rnd.random() for _ in range(5000))
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    got = {r["prob"]: r["value"] for r in qn.approx_quantiles(df, ["x"], [0.25, 0.5, 0.75], 0.01).collect()}
    for p, v in got.items():
        rank = sum(1 for x in xs if x <= v)
        assert abs(rank - p * len(xs)) <= 0.01 * len(xs) + 1


def test_iqr_report_fences_and_outliers(spark):
    xs = [float(i) for i in range(1, 101)] + [1000.0, -1000.0, float("nan"), None]
    df = spark.createDataFrame([(x, x) for x in xs], "a double, b double")
    r = {x["column"]: x for x in pr.iqr_report(df, ["a", "b"], method="exact").collect()}
    q1, q3 = _np_percentile(list(range(1, 101)) + [1000, -1000], 0.25), _np_percentile(list(range(1, 101)) + [1000, -1000], 0.75)
    assert abs(r["a"]["q1"] - q1) < 1e-9 and abs(r["a"]["q3"] - q3) < 1e-9
    assert r["a"]["outliers"] == 3  # 1000, -1000 and NaN (counts as above); null never
    assert r["b"]["outliers"] == 3


def test_exact_quantiles_several_columns_one_all_null(spark):
    # columns are ranked together (shared totals and rank jobs): each must
    # still get its own ranks, and an all-null column gives null values
    rnd = random.Random(5)
    xs = [rnd.uniform(-5, 5) for _ in range(1200)]
    ys = [float(rnd.randint(0, 9)) for _ in range(1200)]
    df = spark.createDataFrame([(x, y, None) for x, y in zip(xs, ys)], "x double, y double, z double")
    probs = [0.0, 0.2, 0.5, 0.95, 1.0]
    for blocks in (1, 5):
        got = {(r["column"], r["prob"]): r["value"]
               for r in qn.exact_quantiles(df, ["x", "y", "z"], probs, blocks=blocks).collect()}
        for p in probs:
            assert abs(got[("x", p)] - _np_percentile(xs, p)) < 1e-9, (blocks, p)
            assert abs(got[("y", p)] - _np_percentile(ys, p)) < 1e-9, (blocks, p)
            assert got[("z", p)] is None


def test_narrowing_ends_in_few_values(spark, monkeypatch):
    """Brackets and places far wider than FEW: many rounds, the same ranks."""
    monkeypatch.setattr(qn, "FEW", 7)
    monkeypatch.setattr(qn, "PARTS", 4)
    rnd = random.Random(13)
    xs = [rnd.gauss(0, 1e6) for _ in range(6000)] + [0.5] * 3000 + [float("-inf"), float("inf"), -0.0, 1e300]
    ys = [float(i // 3) for i in range(len(xs))]
    df = spark.createDataFrame(list(zip(xs, ys)), "x double, y double")
    wanted = {0, 1, 2999, 4500, 7000, len(xs) - 2, len(xs) - 1}
    probs = [r / (len(xs) - 1) for r in wanted]
    for blocks in (4, 64):
        found = qn.order_statistics(df, ["x", "y"], probs, lambda n: wanted, blocks)
        for i, values in enumerate((xs, ys)):
            n, at = found[i]
            assert n == len(values) and at == {r: sorted(values)[r] for r in wanted}


def test_what_comes_to_the_driver_is_bounded(spark, monkeypatch):
    """Ten thousand blocks over a nearly unique column: no place that is read holds more than FEW values."""
    monkeypatch.setattr(qn, "FEW", 40)
    seen = []
    narrowed = qn._narrowed

    def watched(rows, places):
        seen.append((rows.count(), max(p[4] for p in places)))
        return narrowed(rows, places)

    monkeypatch.setattr(qn, "_narrowed", watched)
    df = spark.range(0, 400_000, 1, 8).selectExpr("(id * 7919 % 400009) + 0.25 AS x")
    got = {r["prob"]: r["value"] for r in qn.exact_quantiles(df, ["x"], [0.1, 0.5, 0.9]).collect()}
    values = sorted(i * 7919 % 400009 + 0.25 for i in range(400_000))
    assert got == {p: _np_percentile(values, p) for p in (0.1, 0.5, 0.9)}
    kept, widest = seen[0]
    assert kept < 4000 and widest > qn.FEW  # of 400,000 rows; the places were narrowed further


def test_quantile_values_are_proved(spark):
    xs = [float(i) for i in range(2000)] + [7.0] * 1000 + [None, float("nan")]
    df = spark.createDataFrame([(x, None) for x in xs], "x double, z double")
    got = {(r["column"], r["prob"]): r for r in qn.proved_quantiles(df, ["x", "z"], [0.25, 0.5], 0.01).collect()}
    for p in (0.25, 0.5):
        r = got["x", p]
        assert r["rows"] == 3000 and r["within"]
        assert r["rows_below"] == sum(x < r["value"] for x in xs if x is not None and x == x)
        assert r["rows_upto"] == sum(x <= r["value"] for x in xs if x is not None and x == x)
        assert got["z", p]["rows"] == 0 and got["z", p]["within"] is None
    n, below, upto = F.lit(1000), F.lit(300), F.lit(301)
    flags = spark.range(1).select(*[qn.within(n, below, upto, p, 0.01).alias(f"p{k}") for k, p in enumerate((0.25, 0.3, 0.309, 0.35))]).first()
    assert tuple(flags) == (False, True, True, False)


def test_iqr_proof_counts_outliers(spark):
    xs = [float(i) for i in range(1, 1001)] + [1e6, -1e6, float("nan"), None]
    df = spark.createDataFrame([(x, None) for x in xs], "x double, z double")
    got = {r["column"]: r for r in pr.iqr_proof(df, ["x", "z"]).collect()}
    assert tuple(got["x"])[1:] == (1003, True, True, True, True)
    assert got["z"]["rows"] == 0 and got["z"]["q1_within"] is None


def test_pairwise_correlation_reads_once_and_matches_pairs(spark):
    rnd = random.Random(17)
    cols = ["a", "b", "c", "d"]
    rows = [tuple(None if rnd.random() < 0.3 else rnd.gauss(5, 2) + k * i / 100 for k in range(4)) for i in range(500)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    out = pr.correlation(df, cols, nulls="skip", centers={"a": 5.0})
    assert out._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 1
    for r in out.collect():
        i, j = cols.index(r["col_a"]), cols.index(r["col_b"])
        x, y = np.array([(t[i], t[j]) for t in rows if t[i] is not None and t[j] is not None]).T
        assert abs(r["corr"] - np.corrcoef(x, y)[0, 1]) < 1e-9
