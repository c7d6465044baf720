"""Vectors, regression fits, tuning, metrics and model artifacts (MLlib).

Fits are the one place that leaves the SQL plan: MLlib runs its own loops of
distributed aggregation jobs (one normal-equation pass for L2 linear models,
one histogram aggregation per tree level for forests and boosting). The linear grid
needs no fit per setting: ``moments`` solves it from one aggregate. The caller
keeps the vectors once around its fits (``cached``); the fits add no copy. A lost
executor's cached blocks are recomputed from lineage; boosting also checkpoints
to the session's checkpoint folder.
"""

from __future__ import annotations

import time
import uuid
from contextlib import contextmanager
from typing import NamedTuple

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import (
    GBTRegressionModel,
    GBTRegressor,
    LinearRegression,
    LinearRegressionModel,
    RandomForestRegressionModel,
    RandomForestRegressor,
)
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from ..params import DEFAULT, Params
from ..sources.sinks import persist_for_passes, publish, published
from . import moments as mo
from .features import below_fraction, hash_sample, row_cap

METRICS = ("rmse", "mae", "r2")


class Tuned(NamedTuple):
    """The outcome of a grid: its best setting, fitted on all of train."""

    bestModel: LinearRegressionModel  # the name that MLlib's cross-validation uses


@contextmanager
def cached(df: DataFrame):
    """Persist around a multi-pass fit, release afterwards."""
    df = persist_for_passes(df)
    try:
        yield df
    finally:
        df.unpersist()


# --- M1-M3: vectors -----------------------------------------------------------


def assembler(cols: tuple[str, ...] | list[str], out: str = "features_raw") -> VectorAssembler:
    """Features in their fixed order; a null or NaN input raises (the default
    ``handleInvalid="error"``)."""
    return VectorAssembler(inputCols=list(cols), outputCol=out)


def prep_pipeline(cols, out: str = "features") -> Pipeline:
    """Assemble + standardise (mean and sample std; a zero-std slot gives 0)."""
    scaler = StandardScaler(withMean=True, withStd=True, inputCol="features_raw", outputCol=out)
    return Pipeline(stages=[assembler(cols), scaler])


def vectors(fe: DataFrame, params: Params = DEFAULT):
    """(prep_model, frame) with columns ``label, features, train, fold``.

    Split and fold are decided by a hash of the trip key where the feature table
    carries it, else of the feature values, so they hold under any partitioning.
    ``params.scaler_fit_on == "all"`` keeps the original order (scaler fitted on
    every row, test included); ``"train"`` fits it on the training rows only."""
    by = ["key"] if "key" in fe.columns else ["label", *params.feature_cols]
    if params.fit_fraction is not None:
        fe = hash_sample(fe, params.fit_fraction, by, params.seed + 1)
    if params.fit_row_cap is not None:
        fe = row_cap(fe, params.fit_row_cap, by)
    fold = F.lit(params.cv_folds - 1)
    for k in range(params.cv_folds - 2, -1, -1):  # nested shares give equal folds
        fold = F.when(below_fraction(by, (k + 1) / params.cv_folds, params.seed + 2), F.lit(k)).otherwise(fold)
    fe = fe.withColumns({"train": below_fraction(by, params.train_fraction, params.seed), "fold": fold})
    prep_model = prep_pipeline(params.feature_cols).fit(fe if params.scaler_fit_on == "all" else fe.where("train"))
    return prep_model, prep_model.transform(fe).select("label", "features", "train", "fold")


def train_rows(frame: DataFrame) -> DataFrame:
    return frame.where("train").select("label", "features", "fold")


def test_rows(frame: DataFrame) -> DataFrame:
    return frame.where(~F.col("train")).select("label", "features")


def vectorize(fe: DataFrame, params: Params = DEFAULT):
    """(prep_model, train, test) of ``vectors``."""
    prep_model, frame = vectors(fe, params)
    return prep_model, train_rows(frame), test_rows(frame)


def scaled_columns(prep_model: PipelineModel, fe: DataFrame, cols) -> DataFrame:
    """The standardised slots as plain double columns ``z_<feature>``."""
    arr = vector_to_array(F.col("features"))
    return prep_model.transform(fe).select(
        "label", *[arr[i].alias(f"z_{c}") for i, c in enumerate(cols)]
    )


# --- M4-M6: fits --------------------------------------------------------------


def linear(params: Params = DEFAULT) -> LinearRegression:
    return LinearRegression(regParam=params.linear_reg, elasticNetParam=params.linear_elastic_net)


def forest(params: Params = DEFAULT) -> RandomForestRegressor:
    return RandomForestRegressor(numTrees=params.forest_trees, maxDepth=params.forest_depth, seed=params.seed)


def boosted(params: Params = DEFAULT) -> GBTRegressor:
    return GBTRegressor(maxIter=params.boosted_rounds, maxDepth=params.boosted_depth, seed=params.seed, checkpointInterval=10)


def fit_linear(train: DataFrame, params: Params = DEFAULT):
    return linear(params).fit(train)


def fit_forest(train: DataFrame, params: Params = DEFAULT):
    return forest(params).fit(train)


def fit_forest_parts(train: DataFrame, folder: str, params: Params = DEFAULT, part_trees: int = 10) -> list[RandomForestRegressionModel]:
    """The forest of ``params`` as smaller forests of ``part_trees`` trees with seeds of
    their own, each saved below ``folder`` when it is fitted. A rerun after a break fits
    only the parts that were not saved whole. ``averaged`` scores them as one forest."""
    parts = []
    for i, begin in enumerate(range(0, params.forest_trees, part_trees)):
        path = f"{folder}/part-{i:04d}"
        if saved(path) is None:
            trees = min(part_trees, params.forest_trees - begin)
            save_model(fit_forest(train, params.with_(forest_trees=trees, seed=params.seed + i)), path)
        parts.append(_load(RandomForestRegressionModel, path))
    return parts


def averaged(parts: list[RandomForestRegressionModel], frame: DataFrame, prediction: str = "prediction") -> DataFrame:
    """``frame`` with the mean prediction of all trees of the parts, in one pass."""
    scored = frame
    for i, part in enumerate(parts):
        scored = part.copy({part.predictionCol: f"__part{i}"}).transform(scored)
    trees = [p.getNumTrees for p in parts]
    mean = sum((F.col(f"__part{i}") * n for i, n in enumerate(trees)), F.lit(0.0)) / sum(trees)
    return scored.withColumn(prediction, mean).drop(*[f"__part{i}" for i in range(len(parts))])


def fit_boosted(train: DataFrame, params: Params = DEFAULT):
    return boosted(params).fit(train)


# --- M7, M11, M13: metrics ----------------------------------------------------


def _metrics(label: str, prediction: str) -> dict[str, Column]:
    """rmse, mae, r2 over the rows that have both values."""
    e = F.col(prediction) - F.col(label)
    known = F.when(e.isNotNull(), F.col(label))
    return {
        "rmse": F.sqrt(F.avg(e * e)),
        "mae": F.avg(F.abs(e)),
        "r2": F.lit(1.0) - F.try_divide(F.sum(e * e), F.var_pop(known) * F.count(known)),
    }


def regression_metrics(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """rmse, mae, r2 in ONE aggregate pass (``RegressionEvaluator`` runs one
    job per metric). r2 = 1 - SS_res / SS_tot with SS_tot = var_pop * n;
    a constant label gives a null r2."""
    return pred.agg(*[x.alias(m) for m, x in _metrics(label, prediction).items()])


def evaluator_metrics(pred: DataFrame) -> dict[str, float]:
    """The same three numbers through ``RegressionEvaluator`` (3 jobs)."""
    return {
        m: RegressionEvaluator(labelCol="label", predictionCol="prediction", metricName=m).evaluate(pred)
        for m in METRICS
    }


def metrics_long(metrics: DataFrame, model: str) -> DataFrame:
    """One-row (rmse, mae, r2) -> (model, metric, value)."""
    return metrics.unpivot([], list(METRICS), "metric", "value").select(
        F.lit(model).alias("model"), "metric", "value"
    )


def model_comparison(models: dict, test: DataFrame) -> DataFrame:
    """(model, metric, value) for each fitted model, in one pass over the test set:
    every model adds its own prediction column."""
    scored = test.select("label", "features")
    for i, model in enumerate(models.values()):
        scored = model.copy({model.predictionCol: f"p{i}"}).transform(scored)
    found = {(name, m): x for i, name in enumerate(models) for m, x in _metrics("label", f"p{i}").items()}
    wide = scored.agg(*[x.alias(f"m{k}") for k, x in enumerate(found.values())])
    cells = [
        F.struct(F.lit(name).alias("model"), F.lit(m).alias("metric"), F.col(f"m{k}").alias("value"))
        for k, (name, m) in enumerate(found)
    ]
    return wide.select(F.explode(F.array(*cells)).alias("r")).select("r.*")


def baseline_improvement(metrics: DataFrame, baseline: dict | None = None) -> DataFrame:
    """(metric, baseline, measured, improvement_pct): lower is better for
    rmse and mae, higher for r2."""
    b = baseline or DEFAULT.baseline_linear
    rows = []
    for m in METRICS:
        base = F.lit(float(b[m]))
        better = (base - F.col(m)) if m != "r2" else (F.col(m) - base)
        rows.append(
            F.struct(
                F.lit(m).alias("metric"),
                base.alias("baseline"),
                F.col(m).alias("measured"),
                (better / base * 100).alias("improvement_pct"),
            )
        )
    return metrics.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


# --- M8-M9: tuning ------------------------------------------------------------


def _cv(estimator, grid, params: Params, parallelism: int) -> CrossValidator:
    """Folds come from the ``fold`` column of ``vectors``."""
    return CrossValidator(
        estimator=estimator,
        estimatorParamMaps=grid,
        evaluator=RegressionEvaluator(metricName="rmse"),
        numFolds=params.cv_folds,
        foldCol="fold",
        parallelism=parallelism,
    )


def _cv_report(spark: SparkSession, cv_model, grid, names: list[str]) -> DataFrame:
    """One row per setting: its parameters, mean rmse over folds, best flag.
    Bounded by the grid size (metadata of the fit, not data rows)."""
    metrics = list(cv_model.avgMetrics)
    best = min(range(len(metrics)), key=lambda i: metrics[i])
    rows = []
    for i, pm in enumerate(grid):
        vals = {p.name: float(v) for p, v in pm.items()}
        rows.append((*[vals[n] for n in names], float(metrics[i]), i == best))
    fields = [StructField(n, DoubleType(), False) for n in names]
    fields += [StructField("avg_rmse", DoubleType(), False), StructField("is_best", StringType(), False)]
    return spark.createDataFrame([(*r[:-1], str(r[-1]).lower()) for r in rows], StructType(fields))


def tune_forest(train: DataFrame, params: Params = DEFAULT):
    """Grid over numTrees x maxDepth, k folds on rmse, best refit on all of
    train. Returns (cv_model, report)."""
    rf = RandomForestRegressor(seed=params.seed)
    grid = (
        ParamGridBuilder()
        .addGrid(rf.numTrees, list(params.forest_grid["numTrees"]))
        .addGrid(rf.maxDepth, list(params.forest_grid["maxDepth"]))
        .build()
    )
    cvm = _cv(rf, grid, params, params.forest_parallelism).fit(train)
    return cvm, _cv_report(train.sparkSession, cvm, grid, ["numTrees", "maxDepth"])


def with_test_rmse(report: DataFrame, cv_model, test: DataFrame) -> DataFrame:
    """The grid report with ``test_rmse`` in the row of the best setting: the model
    refitted on all of train, scored on test."""
    rmse = regression_metrics(cv_model.bestModel.transform(test)).first()["rmse"]
    return report.withColumn("test_rmse", F.when(F.col("is_best") == "true", F.lit(rmse)))


def tune_linear(train: DataFrame, params: Params = DEFAULT):
    """Grid over regParam x elasticNetParam, k folds, from the folds' moments (see
    ``moments``): one aggregate, no fit per setting and fold. Returns (tuned, report);
    ``tuned.bestModel`` is the best setting fitted by MLlib on all of train."""
    grid = [(r, a) for r in params.linear_grid["regParam"] for a in params.linear_grid["elasticNetParam"]]
    folds = mo.collect(mo.linear_moments(train, len(params.feature_cols)))
    whole = sum(folds.values())
    rmse = []
    for reg, mix in grid:
        parts = []
        for held in folds.values():
            rest = whole - held
            if held[0, 0] and rest[0, 0]:
                parts.append(mo.rmse(held, mo.solve(rest, reg, mix)))
        rmse.append(sum(parts) / len(parts))
    best = min(range(len(grid)), key=lambda i: rmse[i])
    fitted = LinearRegression(regParam=grid[best][0], elasticNetParam=grid[best][1]).fit(train)
    rows = [(float(r), float(a), e, str(i == best).lower(), mo.regularisation(a)) for i, ((r, a), e) in enumerate(zip(grid, rmse))]
    schema = "regParam double not null, elasticNetParam double not null, avg_rmse double not null, is_best string not null, regularization string not null"
    return Tuned(fitted), train.sparkSession.createDataFrame(rows, schema)


# --- M12, S7-S9: importance and artifacts ------------------------------------


def feature_importance(model, cols) -> DataFrame:
    """(feature, importance) descending; bounded by the feature count."""
    spark = SparkSession.getActiveSession()
    rows = [(c, float(v)) for c, v in zip(cols, model.featureImportances.toArray())]
    schema = StructType([StructField("feature", StringType(), False), StructField("importance", DoubleType(), False)])
    return spark.createDataFrame(rows, schema).orderBy(F.col("importance").desc(), "feature")


def save_model(model, path: str) -> None:
    """Save the model in a folder of its own below ``path`` and, as the last step, name
    that folder as the one to load. A save that breaks off changes nothing: what was
    saved before, if anything, is loaded."""
    version = f"{time.time_ns():020d}-{uuid.uuid4().hex}"
    model.write().save(f"{path}/{version}")
    publish(SparkSession.getActiveSession(), path, version)


def saved(path: str) -> str | None:
    """The folder of the model last saved whole at ``path``; None if there is none."""
    version = published(SparkSession.getActiveSession(), path)
    return version and f"{path}/{version}"


def _load(kind, path: str):
    if (folder := saved(path)) is None:
        raise FileNotFoundError(f"no model was saved at {path}")
    return kind.load(folder)


def load_forest(spark: SparkSession, tuned_path: str, baseline_path: str) -> RandomForestRegressionModel:
    """The tuned forest if one was saved whole, else the baseline forest."""
    return _load(RandomForestRegressionModel, tuned_path if saved(tuned_path) else baseline_path)


def load_linear(path: str) -> LinearRegressionModel:
    return _load(LinearRegressionModel, path)


def load_boosted(path: str) -> GBTRegressionModel:
    return _load(GBTRegressionModel, path)


def load_prep(path: str) -> PipelineModel:
    """The fitted assembler and scaler."""
    return _load(PipelineModel, path)


def load_baselines(folder: str) -> dict:
    """The three saved baseline models, by the names of ``model_comparison``."""
    return {
        "Linear": load_linear(f"{folder}/lr"),
        "RF": _load(RandomForestRegressionModel, f"{folder}/rf"),
        "GBT": load_boosted(f"{folder}/gbt"),
    }
