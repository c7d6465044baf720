"""Samples, sinks, folds, metrics and loaders at their edges."""

import math
import os

import pytest
from pyspark.sql import functions as F

from farelens import session
from farelens.operators import features as fe
from farelens.operators import models as md
from farelens.operators import moments as mo
from farelens.operators import profile as pr
from farelens.params import SMALL_MODELS
from farelens.plans import stages
from farelens.sources import count_table, read_counts, write_counted, write_report_csv
from farelens.sources.sinks import path_exists
from tests.conftest import SF_SMALL


@pytest.mark.parametrize("fraction", [1e-7, 1e-4])
def test_tiny_fractions_within_three_sigma(spark, fraction):
    n = 2_000_000
    got = fe.hash_sample(spark.range(n), fraction, ["id"]).count()
    assert abs(got - n * fraction) <= 3 * math.sqrt(n * fraction) + 1


def test_checkpoint_folder_must_be_named(spark, monkeypatch):
    monkeypatch.setattr(session, "checkpoint_dir", lambda _: None)
    with pytest.raises(ValueError, match="shared folder"):
        session.ensure_checkpoint_dir(spark)


def test_report_sink_reads_its_input_once(spark, tmp_out):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    rows = spark.range(0, 1000, 1, 4).mapInArrow(counted, "id bigint")
    write_report_csv(rows.groupBy((F.col("id") % 3).alias("g")).count(), f"{tmp_out}/rep")
    assert seen.value == 1000 and os.path.exists(f"{tmp_out}/rep")


def test_path_exists(spark, tmp_out):
    assert path_exists(spark, tmp_out) and not path_exists(spark, f"{tmp_out}/none")


def test_folds_and_split_follow_the_key(spark):
    feats = stages.features(spark, SF_SMALL, carry=("key",))
    ids = ["label", "train", "fold"]
    first = md.vectors(feats, SMALL_MODELS)[1].select(*ids).collect()
    again = md.vectors(feats.repartition(7), SMALL_MODELS)[1].select(*ids).collect()
    assert sorted(first) == sorted(again)
    folds = [r.fold for r in first]
    assert set(folds) == {0, 1, 2} and all(abs(folds.count(k) / len(folds) - 1 / 3) < 0.03 for k in range(3))


def test_tune_linear_does_not_depend_on_partitions(spark):
    feats = stages.features(spark, SF_SMALL, carry=("key",)).where("passenger_count < 3")
    got = []
    for n in (3, 7):
        _, train, _ = md.vectorize(feats.repartition(n), SMALL_MODELS.with_(linear_grid={"regParam": (0.01, 0.1), "elasticNetParam": (0.0,)}))
        _, report = md.tune_linear(train, SMALL_MODELS.with_(linear_grid={"regParam": (0.01, 0.1), "elasticNetParam": (0.0,)}))
        got.append([(r.regParam, round(r.avg_rmse, 6), r.is_best) for r in report.collect()])
    assert got[0] == got[1]


def test_r2_counts_the_rows_it_measures(spark):
    rows = [(1.0, 1.5), (2.0, 1.5), (4.0, 4.5), (None, 9.0), (7.0, None)]
    got = md.regression_metrics(spark.createDataFrame(rows, "label double, prediction double")).first()
    mean, pairs = 7 / 3, rows[:3]
    want = 1 - sum((p - y) ** 2 for y, p in pairs) / sum((y - mean) ** 2 for y, _ in pairs)
    assert abs(got.r2 - want) < 1e-12


def test_row_cap_of_zero_is_a_cap(spark):
    feats = stages.features(spark, SF_SMALL)
    with pytest.raises(Exception):
        md.vectors(feats, SMALL_MODELS.with_(fit_row_cap=0))[1].collect()


def test_saved_models_compare_like_fitted_ones(spark, tmp_out):
    prep, train, test = md.vectorize(stages.features(spark, SF_SMALL, carry=("key",)), SMALL_MODELS)
    fitted = {"Linear": md.fit_linear(train, SMALL_MODELS), "RF": md.fit_forest(train, SMALL_MODELS), "GBT": md.fit_boosted(train, SMALL_MODELS)}
    for name, key in (("Linear", "lr"), ("RF", "rf"), ("GBT", "gbt")):
        md.save_model(fitted[name], f"{tmp_out}/{key}")
    md.save_model(prep, f"{tmp_out}/prep")
    saved = md.model_comparison(md.load_baselines(tmp_out), test)
    assert saved.collect() == md.model_comparison(fitted, test).collect()
    alone = md.regression_metrics(fitted["RF"].transform(test)).first()
    assert {r.metric: r.value for r in saved.where("model = 'RF'").collect()} == pytest.approx(alone.asDict())
    assert md.load_prep(f"{tmp_out}/prep").stages[1].mean == prep.stages[1].mean


def test_correlation_drops_missing_columns_and_multiplies_no_rows(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 4.5), (3.0, 5.0)], "a double, b double")
    for nulls in ("zero", "skip"):
        out = pr.correlation(df, ["a", "b", "none"], nulls, centers={"a": 2.0})
        assert {(r.col_a, r.col_b) for r in out.collect()} == {(x, y) for x in "ab" for y in "ab"}
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert plan.index("Generate") < plan.index("Aggregate")
    assert pr.correlation(df, ["none"]).count() == 0


def test_row_cap_is_exact_and_stays_in_place(spark):
    rows = spark.range(0, 30_000, 1, 6).select(F.concat(F.lit("k"), "id").alias("key"), (F.col("id") % 10).alias("v"))
    for n in (1, 17, 12_345, 29_999, 30_000, 50_000):
        capped = fe.row_cap(rows, n, ["key"])
        keys = {r.key for r in capped.collect()}
        assert len(keys) == min(n, 30_000)
        if n < 30_000:
            assert "SinglePartition" not in capped._jdf.queryExecution().executedPlan().toString()
            assert {r.key for r in fe.row_cap(rows.repartition(3), n, ["key"]).collect()} == keys
    assert fe.row_cap(rows, 0).count() == 0 and fe.row_cap(rows, 5, method="first").count() == 5
    # equal rows at the cut: as many as are due
    assert fe.row_cap(rows.select("v"), 12_345).count() == 12_345


def test_counts_are_taken_while_a_table_is_written(spark, tmp_out):
    rows = spark.range(5000).select("id", F.when(F.col("id") % 7 > 0, F.col("id").cast("string")).alias("s"), F.lit(1.5).alias("x"))
    spark.sparkContext.setJobGroup("counted", "")
    found = write_counted(rows, f"{tmp_out}/t")
    spark.sparkContext.setJobGroup("other", "")
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("counted")) <= 2  # the table and its counts
    assert found["__rows"] == 5000 and read_counts(spark, f"{tmp_out}/t") == found
    reread = spark.read.parquet(f"{tmp_out}/t")
    assert count_table(reread) == found == count_table(rows.repartition(7))
    assert count_table(reread.where("id <> 3")) != found
    assert count_table(reread.withColumn("s", F.lit("other")))["s"] != found["s"]
    empty = write_counted(rows.where("id < 0"), f"{tmp_out}/e")
    assert set(empty.values()) == {0} and read_counts(spark, f"{tmp_out}/e") == empty


def test_a_save_that_breaks_off_changes_nothing(spark, tmp_out):
    _, train, _ = md.vectorize(stages.features(spark, SF_SMALL, carry=("key",)), SMALL_MODELS)
    first, second = (md.fit_forest(train, SMALL_MODELS.with_(forest_trees=n)) for n in (2, 3))
    md.save_model(first, f"{tmp_out}/base")
    tuned = f"{tmp_out}/tuned"
    first.write().save(f"{tuned}/00000000000000000001-broken")  # saved, but never published
    assert path_exists(spark, tuned) and md.saved(tuned) is None
    assert md.load_forest(spark, tuned, f"{tmp_out}/base").getNumTrees == 2
    md.save_model(second, tuned)
    assert md.load_forest(spark, tuned, f"{tmp_out}/base").getNumTrees == 3
    first.write().save(f"{tuned}/99999999999999999999-broken")
    assert md.load_forest(spark, tuned, f"{tmp_out}/base").getNumTrees == 3
    with pytest.raises(FileNotFoundError):
        md.load_linear(f"{tmp_out}/none")


def test_linear_grid_from_moments_equals_mllib(spark):
    from pyspark.ml.regression import LinearRegression

    _, frame = md.vectors(stages.features(spark, SF_SMALL, carry=("key",)), SMALL_MODELS)
    train = md.train_rows(frame).persist()
    folds = mo.collect(mo.linear_moments(train, 6))
    whole, worst = sum(folds.values()), 0.0
    for reg in SMALL_MODELS.linear_grid["regParam"]:
        for mix in SMALL_MODELS.linear_grid["elasticNetParam"]:
            m = LinearRegression(regParam=reg, elasticNetParam=mix, tol=1e-12, maxIter=1000).fit(train)
            own = mo.solve(whole, reg, mix)
            worst = max(worst, abs(m.intercept - own[0]), *map(abs, m.coefficients.toArray() - own[1:]))
    assert worst < 1e-6
    m = LinearRegression(regParam=0.1, elasticNetParam=0.5, tol=1e-12, maxIter=1000).fit(train.where("fold <> 1"))
    measured = md.regression_metrics(m.transform(train.where("fold = 1"))).first().rmse
    assert abs(measured - mo.rmse(folds[1], mo.solve(whole - folds[1], 0.1, 0.5))) < 1e-6
    tuned, report = md.tune_linear(train, SMALL_MODELS)
    best = [r for r in report.collect() if r.is_best == "true"]
    assert len(best) == 1 and tuned.bestModel.getRegParam() == best[0].regParam


def test_moments_of_odd_columns():
    import numpy as np

    rng = np.random.default_rng(5)
    x = np.column_stack([np.ones(50), rng.normal(size=(50, 2)), np.full(50, 3.0)])
    y = 2 + x[:, 1] - 4 * x[:, 2]
    rows = np.column_stack([x, y])
    assert np.allclose(mo.solve(rows.T @ rows), [2, 1, -4, 0], atol=1e-9)  # a constant column gets no weight
    flat = np.column_stack([x, np.full(50, 7.0)])
    assert np.allclose(mo.solve(flat.T @ flat, 0.1, 1.0), [7, 0, 0, 0])
    twin = np.column_stack([x[:, :2], x[:, 1], y])
    assert np.allclose(twin[:, :3] @ mo.solve(twin.T @ twin), np.linalg.lstsq(twin[:, :3], y, rcond=None)[0] @ twin[:, :3].T)


def test_the_entry_does_without_the_corpus_packages(monkeypatch):
    import importlib
    import sys

    import __spark_entry__ as entry

    for name in [n for n in sys.modules if n.startswith("farelens.llm") or n == "corpus_pipeline"]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, "public_tokenizers", None)
    try:
        again = importlib.reload(entry)
        assert "hourly_fare" in again.queries() and not any(n.startswith("op1") for n in again.queries())
        assert set(again.oracle_sql()) <= set(again.queries())
    finally:
        monkeypatch.undo()
        importlib.reload(entry)


def test_a_forest_in_parts_goes_on_where_it_broke_off(spark, tmp_out, monkeypatch):
    _, train, test = md.vectorize(stages.features(spark, SF_SMALL, carry=("key",)), SMALL_MODELS)
    params, fitted, fit = SMALL_MODELS.with_(forest_trees=7, forest_depth=3), [], md.fit_forest

    def counted(train, p):
        if len(fitted) == 2 and not monkeypatch_done:
            raise RuntimeError("broken off")
        fitted.append((p.forest_trees, p.seed))
        return fit(train, p)

    monkeypatch_done = []
    monkeypatch.setattr(md, "fit_forest", counted)
    with pytest.raises(RuntimeError):
        md.fit_forest_parts(train, tmp_out, params, part_trees=3)
    monkeypatch_done.append(True)
    parts = md.fit_forest_parts(train, tmp_out, params, part_trees=3)
    assert fitted == [(3, params.seed), (3, params.seed + 1), (1, params.seed + 2)]  # the first two once
    assert md.fit_forest_parts(train, tmp_out, params, part_trees=3) and len(fitted) == 3
    scored = md.averaged(parts, test)
    assert scored.columns == [*test.columns, "prediction"]
    row = scored.first()
    assert row.prediction == pytest.approx(sum(p.predict(row.features) * p.getNumTrees for p in parts) / 7)
    spread = test.agg(F.stddev_pop("label")).first()[0]
    assert md.regression_metrics(scored).first().rmse < 1.1 * spread
