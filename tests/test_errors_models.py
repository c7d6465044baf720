import os

from pyspark.sql import functions as F

from farelens.operators import errors as er
from farelens.operators import features as fe
from farelens.operators import models as md
from farelens.params import SMALL_MODELS
from farelens.plans import stages
from tests.conftest import SF_SMALL


def _scored(spark):
    rows = [(10.0, 10.4), (10.0, 11.5), (0.0, 3.0), (20.0, 24.0), (5.0, 12.0), (8.0, 30.0)]
    return spark.createDataFrame(rows, "label double, prediction double")


def test_prediction_errors_round_after_computing(spark):
    df = spark.createDataFrame([(1.004, 2.0)], "label double, prediction double")
    r = er.prediction_errors(df).first()
    assert (r["label"], r["prediction"], r["error"], r["absolute_error"]) == (1.0, 2.0, 1.0, 1.0)
    assert r["percentage_error"] == 99.2  # from unrounded 0.996 / 1.004


def test_error_categories_and_shares(spark):
    res = er.prediction_errors(_scored(spark))
    got = {r["error_category"]: (r["count"], r["percentage"]) for r in er.error_categories(res).collect()}
    assert got["Excellent (<$1)"] == (1, 16.67)
    assert got["Good ($1-$2)"] == (1, 16.67)
    assert got["Fair ($2-$5)"] == (2, 33.33)
    assert got["Poor ($5-$10)"] == (1, 16.67)
    assert got["Very Poor (>$10)"] == (1, 16.67)


def test_error_summary_exact_and_approx(spark):
    res = er.prediction_errors(_scored(spark))
    ex = er.error_summary(res, median="exact").first()
    assert ex["total_predictions"] == 6
    assert ex["median_absolute_error"] == 3.5
    assert ex["predictions_within_1_dollar"] == 1 and ex["pct_within_5_dollars"] == 66.67
    assert ex["max_error"] == 22.0 and ex["min_error"] == 0.4
    ap = er.error_summary(res, median="approx").first()
    assert ap["median_absolute_error"] in (3.0, 4.0)


def test_best_worst_deterministic(spark):
    res = er.prediction_errors(_scored(spark))
    assert [r["absolute_error"] for r in er.best_predictions(res, 2).collect()] == [0.4, 1.5]
    assert [r["absolute_error"] for r in er.worst_predictions(res, 2).collect()] == [22.0, 7.0]
    plan = er.best_predictions(res, 2)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_error_describe_typed(spark):
    res = er.prediction_errors(_scored(spark))
    d = {r["summary"]: r for r in er.error_describe(res).collect()}
    assert d["count"]["abs_error"] == 6.0 and d["count"]["percentage_error"] == 5.0
    assert d["max"]["abs_error"] == 22.0
    strings = {r["summary"]: r for r in er.describe_strings(res).collect()}
    assert float(strings["max"]["abs_error"]) == 22.0


def test_regression_metrics_equal_evaluator(spark):
    pred = _scored(spark)
    one = md.regression_metrics(pred).first().asDict()
    ev = md.evaluator_metrics(pred)
    for k in md.METRICS:
        assert abs(one[k] - ev[k]) < 1e-9, k


def test_baseline_improvement_directions(spark):
    m = spark.createDataFrame([(5.0, 2.0, 0.6)], "rmse double, mae double, r2 double")
    got = {r["metric"]: r["improvement_pct"] for r in md.baseline_improvement(m).collect()}
    assert abs(got["rmse"] - (5.8078 - 5.0) / 5.8078 * 100) < 1e-9
    assert abs(got["r2"] - (0.6 - 0.5377) / 0.5377 * 100) < 1e-9


def _model_input(spark):
    # a label that depends on the features, so a fit must beat the mean
    f = stages.features(spark, SF_SMALL)
    lab = F.lit(2.5) + F.lit(1.6) * F.col("distance_km") + F.lit(0.01) * ((F.col("pickup_hour") * F.col("passenger_count")) % 50)
    return f.withColumn("label", lab)


def test_split_disjoint_and_complete(spark):
    f = _model_input(spark)
    train, test = fe.train_test_split(f, 0.8, 42)
    n, a, b = f.count(), train.count(), test.count()
    assert a + b == n and 0.7 * n < a < 0.9 * n
    assert train.intersect(test).count() == 0
    a2, _ = fe.train_test_split(f.repartition(5), 0.8, 42)
    assert sorted(a2.collect()) == sorted(train.collect())
    parts = dict(f.groupBy(fe.split_part(f.columns, 0.8, 42)).count().collect())
    assert parts == {"train": a, "test": b}


def test_linear_fit_beats_mean_and_round_trips(spark, tmp_out):
    _, train, test = md.vectorize(_model_input(spark), SMALL_MODELS)
    model = md.fit_linear(train, SMALL_MODELS)
    m = md.regression_metrics(model.transform(test)).first()
    std = test.agg(F.stddev("label")).first()[0]
    assert m["rmse"] < 0.2 * std
    path = os.path.join(tmp_out, "lr")
    md.save_model(model, path)
    again = md.load_linear(path)
    a = [r["prediction"] for r in model.transform(test).orderBy("label").collect()]
    b = [r["prediction"] for r in again.transform(test).orderBy("label").collect()]
    assert a == b


def test_forest_importance_and_fallback_loader(spark, tmp_out):
    _, train, _ = md.vectorize(_model_input(spark), SMALL_MODELS)
    rf = md.fit_forest(train, SMALL_MODELS)
    imp = md.feature_importance(rf, SMALL_MODELS.feature_cols).collect()
    assert imp[0]["feature"] == "distance_km"
    assert abs(sum(r["importance"] for r in imp) - 1.0) < 1e-9
    base = os.path.join(tmp_out, "rf")
    md.save_model(rf, base)
    loaded = md.load_forest(spark, os.path.join(tmp_out, "missing_tuned"), base)
    assert loaded.getNumTrees == rf.getNumTrees


def test_tune_linear_report(spark):
    _, train, _ = md.vectorize(_model_input(spark), SMALL_MODELS)
    _, rep = md.tune_linear(train, SMALL_MODELS)
    rows = rep.collect()
    assert len(rows) == 12
    assert sum(1 for r in rows if r["is_best"] == "true") == 1
    assert {r["regularization"] for r in rows} == {"Ridge (L2)", "Lasso (L1)", "ElasticNet (L1+L2)"}


def test_scaler_fit_on_train_option(spark):
    p = SMALL_MODELS.with_(scaler_fit_on="train")
    prep, train, test = md.vectorize(_model_input(spark), p)
    assert train.count() + test.count() == _model_input(spark).count()
