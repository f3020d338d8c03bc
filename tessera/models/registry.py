"""Registry of fitted models: the run log kept as a table, best runs, saved models read back."""

from __future__ import annotations

import os

from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.regression import GBTRegressionModel, RandomForestRegressionModel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tessera.models.elastic import LinearPoint
from tessera.models.search import RUN_LOG_SCHEMA, RUN_METRIC

LOADERS = {"RF": RandomForestRegressionModel, "GBT": GBTRegressionModel}


class UnknownModel(ValueError):
    pass


def register_runs(log: DataFrame, path: str, run_id: str) -> DataFrame:
    """Add a search's log to the table below ``path`` and return the whole table.

    A search owns the folder of its ``run_id`` and replaces it, so a repeated or retried
    append adds nothing and another search's rows are never touched."""
    log.write.mode("overwrite").parquet(os.path.join(path, f"run_id={run_id}"))
    return read_runs(log.sparkSession, path)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    schema = StructType([*RUN_LOG_SCHEMA.fields, StructField("run_id", StringType())])
    return spark.read.schema(schema).parquet(path)


def best_runs(runs: DataFrame, by=("experiment", "family")) -> DataFrame:
    """The fit of the smallest score of every group; of equal ones the first by run id and name."""
    order = Window.partitionBy(*by).orderBy(F.col("value").asc_nulls_last(), "run_id", "run_name")
    fits = runs.where((F.col("metric") == RUN_METRIC) & ~F.col("is_best"))
    return fits.withColumn("place", F.row_number().over(order)).where("place = 1").drop("place")


def load_model(spark: SparkSession, family: str, path: str):
    """A saved model of any family, ready to ``transform``."""
    if family in LOADERS:
        return LOADERS[family].load(path)
    if family != "LR":
        raise UnknownModel(f"unknown model family {family!r}")
    return LinearPoint.load(spark, path)


def rescore(spark: SparkSession, runs: DataFrame, data: DataFrame, label: str) -> DataFrame:
    """(family, run_name, logged, scored) of the given runs, one row a saved model: its score
    on ``data`` after it was read back."""
    evaluator = RegressionEvaluator(labelCol=label, predictionCol="prediction", metricName=RUN_METRIC)
    rows = [(r.family, r.run_name, r.value, float(evaluator.evaluate(load_model(spark, r.family, r.model_path).transform(data))))
            for r in runs.where("model_path is not null").collect()]       # one row a group, see best_runs
    return spark.createDataFrame(rows, "family string, run_name string, logged double, scored double")
