"""Feature vectors, hold-out model search and the run log.

* ``assemble`` — ``VectorAssembler`` (nulls raise: impute first).
* ``grid`` — ``ParamGridBuilder`` from ``{param_name: values}``.
* ``holdout_search`` — fit every grid point on one cached training split,
  score RMSE on the validation split, best = strictly smallest (first wins
  ties).  Independent fits may run from a small thread pool
  (``parallelism``), each one an ordinary distributed Spark ML job.  Linear
  regressions are not fitted point by point: all of a grid come from one pass.
  Neither are boosted trees nor, on larger tables, forests (``tessera.models.cells``).
* ``run_log`` — the results as an append-only DataFrame
  ``(experiment, run_name, family, params, metric, value, is_best, model_path)``.
"""

from __future__ import annotations

import os
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.ml.stat import Correlation
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import (
    BooleanType,
    DoubleType,
    MapType,
    StringType,
    StructField,
    StructType,
)

from tessera.models.cells import fit_points
from tessera.models.elastic import grid_rmse, solve, sufficient

FAMILIES = {
    "RF": RandomForestRegressor,
    "LR": LinearRegression,
    "GBT": GBTRegressor,
}

# --- fixed values: grids, names and run-name formats of the reference's training run ---
DEFAULT_GRIDS = {
    "RF": {"numTrees": [50, 100, 150], "maxDepth": [10, 15], "maxBins": [32, 64]},
    "LR": {"regParam": [0.1, 0.01, 0.001], "elasticNetParam": [0.0, 0.5, 1.0]},
    "GBT": {"maxDepth": [10, 15], "maxBins": [32, 64]},
}
DEFAULT_EXPERIMENT = "Reg. Models - Price Prediction"
RUN_NAME_ABBREVIATIONS = {"elasticNetParam": "elasticNet"}  # e.g. LR_regParam_0.1_elasticNet_0.5
BEST_RUN_NAME = "Best_{family}_Model"
RUN_METRIC, BEST_METRIC = "rmse", "best_rmse"
# --- end of fixed values ---

RUN_LOG_SCHEMA = StructType([
    StructField("experiment", StringType()),
    StructField("run_name", StringType()),
    StructField("family", StringType()),
    StructField("params", MapType(StringType(), StringType())),
    StructField("metric", StringType()),
    StructField("value", DoubleType()),
    StructField("is_best", BooleanType()),
    StructField("model_path", StringType()),
])


def assemble(df: DataFrame, cols, out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(cols), outputCol=out).transform(df)


def correlation_matrix(df: DataFrame, features_col: str = "features", method: str = "pearson"):
    """Pearson matrix of a vector column (a k×k DenseMatrix on the driver)."""
    return Correlation.corr(df, features_col, method).head()[0]


def make_estimator(family: str, label: str, features: str, seed: int | None = 42):
    est = FAMILIES[family](labelCol=label, featuresCol=features)
    if seed is not None and est.hasParam("seed"):
        est = est.setSeed(seed)
    return est


def grid(estimator, spec: dict):
    b = ParamGridBuilder()
    for name, values in spec.items():
        b = b.addGrid(estimator.getParam(name), list(values))
    return b.build()


def run_name(family: str, params: dict) -> str:
    return family + "".join(f"_{RUN_NAME_ABBREVIATIONS.get(k, k)}_{v}" for k, v in params.items())


@dataclass
class Run:
    family: str
    params: dict
    rmse: float
    model: object = field(repr=False, default=None)
    model_path: str | None = None


def _fmt(v) -> str:
    return repr(v) if isinstance(v, float) else str(v)


def holdout_search(family: str, spec: dict, train: DataFrame, val: DataFrame, label: str,
                   features: str = "features", seed: int | None = 42, parallelism: int = 1,
                   save_dir: str | None = None) -> list[Run]:
    """Fit each grid point on ``train``, RMSE on ``val``.  Runs keep grid order."""
    return search_grids({family: spec}, train, val, label, features, seed, parallelism, save_dir)


def search_grids(grids: dict, train: DataFrame, val: DataFrame, label: str,
                 features: str = "features", seed: int | None = 42, parallelism: int = 1,
                 save_dir: str | None = None) -> list[Run]:
    """Every grid point of every family; with ``parallelism > 1`` all of them
    share one pool, so fits of different families overlap.  Runs come back in
    family order, then grid order.  Where ``fit_points`` fits the tree families' points
    together, only their models are left to be made one by one."""
    evaluator = RegressionEvaluator(labelCol=label, predictionCol="prediction", metricName="rmse")
    tasks = []
    for family, spec in grids.items():
        if family == "LR" and set(spec) <= {"regParam", "elasticNetParam"}:
            tasks.append((family, None, 0, spec))
            continue
        est = make_estimator(family, label, features, seed)
        if family == "RF":       # a pass goes one level down in each tree, not down from all roots; the model is the same
            est = est.setCacheNodeIds(True)
        tasks += [(family, est, i, pm) for i, pm in enumerate(grid(est, spec))]

    trees = [t for t in tasks if t[1] is not None]
    together = fit_points([(f, e, pm) for f, e, _, pm in trees], train, val, label, features, seed) if trees else {}
    fitted = {(trees[k][0], trees[k][2]): point for k, point in together.items()}

    def linear(spec):
        """All points of a linear grid: one pass over ``train``, one over ``val``."""
        stats = sufficient(train, None, label, vector=features)
        settings = [{p.name: pm[p] for p in pm} for pm in grid(make_estimator("LR", label, features, seed), spec)]
        points = [solve(stats, s.get("regParam", 0.0), s.get("elasticNetParam", 0.0)) for s in settings]
        runs = []
        for i, (params, point, score) in enumerate(zip(settings, points, grid_rmse(val, points, label))):
            path = os.path.join(save_dir, f"LR_{i:03d}") if save_dir else None
            if path:
                point.save(train.sparkSession, path)
            runs.append(Run("LR", params, score, point, path))
        return runs

    def one(task):
        family, est, i, pm = task
        if est is None:
            return linear(pm)
        params = {p.name: pm[p] for p in pm}
        path = os.path.join(save_dir, f"{family}_{i:03d}") if save_dir else None
        if (family, i) in fitted:
            score, stored = fitted[family, i]
            return [Run(family, params, score, stored(path), path)]
        model = est.fit(train, pm)
        score = evaluator.evaluate(model.transform(val))
        if path:
            model.write().overwrite().save(path)
        return [Run(family, params, float(score), model, path)]

    if parallelism > 1:
        # inheritable: pool threads keep the caller's job group / description / pool.  A wrapper
        # holds one copy of those properties and gives it to every thread that calls it, so each
        # task has its own: Spark keeps a running query's id there
        own = [inheritable_thread_target(train.sparkSession)(one) for _ in tasks]
        with ThreadPoolExecutor(max_workers=parallelism) as pool:
            return [r for runs in pool.map(lambda run, task: run(task), own, tasks) for r in runs]
    return [r for t in tasks for r in one(t)]


def best_run(runs: list[Run]) -> Run | None:
    best = None
    for r in runs:  # strict '<': the first of equal scores wins
        if best is None or r.rmse < best.rmse:
            best = r
    return best


def run_log(spark: SparkSession, experiment: str, runs: list[Run]) -> DataFrame:
    """One row per fit plus one ``Best_<family>`` row per family (``best_rmse``)."""
    rows = []
    families = []
    for r in runs:
        if r.family not in families:
            families.append(r.family)
        rows.append((experiment, run_name(r.family, r.params), r.family,
                     {k: _fmt(v) for k, v in r.params.items()}, RUN_METRIC, r.rmse, False,
                     r.model_path))
    for fam in families:
        b = best_run([r for r in runs if r.family == fam])
        rows.append((experiment, BEST_RUN_NAME.format(family=fam), fam,
                     {k: _fmt(v) for k, v in b.params.items()}, BEST_METRIC, b.rmse, True,
                     b.model_path))
    return spark.createDataFrame(rows, RUN_LOG_SCHEMA)


def append_run_log(log: DataFrame, path: str) -> DataFrame:
    """Append to the run-log table and return the whole table."""
    log.write.mode("append").parquet(path)
    return log.sparkSession.read.schema(RUN_LOG_SCHEMA).parquet(path)
