"""Elastic-net linear regression from sufficient statistics.

One pass over the rows gives the co-moments of features and label (k x k numbers).  Every
point of a grid of penalties is then a small problem on the driver: ridge points are one
linear system, points with an L1 part are solved by cyclic coordinate descent.  The
objective is the one of ``pyspark.ml.regression.LinearRegression`` with its defaults
(features and label standardised, intercept fitted and not penalised):

    1/2 w'Gw - c'w + lambda/s_y * ((1 - alpha)/2 |w|^2 + alpha |w|_1)

with G and c the correlations and w the coefficients in standard deviations."""

from __future__ import annotations

import json
import os
from dataclasses import dataclass

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.moments import co_moments

SWEEPS = 100_000
TOLERANCE = 1e-12


class NoConvergence(RuntimeError):
    pass


@dataclass
class Sufficient:
    """Number of rows, means and central co-moments (sums) of the features, then the label."""
    features: list
    n: float
    mean: np.ndarray
    cross: np.ndarray
    vector: str | None = None


@dataclass
class LinearPoint:
    """A fitted point: ``intercept + sum(coefficient * feature)``."""
    features: list
    reg_param: float
    elastic_net: float
    coefficients: list
    intercept: float
    vector: str | None = None          # the vector column it predicts from, if not from the features' own columns

    def expression(self) -> Column:
        """The prediction, from the features' own columns or from a vector column of them."""
        vector = self.vector
        values = vector_to_array(F.col(vector)) if vector else None
        out = F.lit(float(self.intercept))
        for i, (name, c) in enumerate(zip(self.features, self.coefficients)):
            out = out + F.lit(float(c)) * (values[i] if vector else F.col(name).cast("double"))
        return out

    def transform(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        return df.withColumn(out, self.expression())

    def save(self, spark: SparkSession, path: str) -> None:
        """One JSON row."""
        spark.createDataFrame([(json.dumps(self.__dict__),)], "value string").coalesce(1).write.mode("overwrite").text(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "LinearPoint":
        return cls(**json.loads(spark.read.text(os.path.join(path, "*.txt")).first()[0]))


def vector_names(df: DataFrame, vector: str) -> list:
    """Names of the entries of a vector column, as its assembler noted them."""
    noted = df.schema[vector].metadata.get("ml_attr", {})
    named = sorted((a["idx"], a["name"]) for kind in noted.get("attrs", {}).values() for a in kind if "name" in a)
    size = noted.get("num_attrs") or len(named)
    if not size:
        first = df.select(F.size(vector_to_array(vector)).alias("k")).first()
        size = first.k if first else 0
    names = dict(named)
    return [names.get(i, f"f{i}") for i in range(size)]


def sufficient(df: DataFrame, features, label: str, vector: str | None = None) -> Sufficient:
    """One job.  Rows with a null feature or label do not count.  ``vector`` names a vector
    column that holds the features, whose names are then taken from it if not given."""
    features = vector_names(df, vector) if features is None else list(features)
    if vector:
        values = vector_to_array(F.col(vector))
        columns = {f: values[i] for i, f in enumerate(features)}
    else:
        columns = {f: F.col(f) for f in features}
    columns = {**{f"c{i}": c for i, c in enumerate(columns.values())}, "y": F.col(label)}
    rows = df.select(*[c.cast("double").alias(n) for n, c in columns.items()]).dropna("any")
    state = co_moments(rows, list(columns)).first()
    k = len(columns)
    size, mean, cross = (np.array(state[p]).reshape(k, k) for p in ("size", "mean", "cross"))
    return Sufficient(features, float(size[0, 0]), np.diag(mean).copy(), cross, vector)


def solve(stats: Sufficient, reg_param: float, elastic_net: float) -> LinearPoint:
    """The minimum for one penalty.  A constant feature gets coefficient zero; a constant
    label is its own intercept."""
    k = len(stats.features)
    spread = np.sqrt(np.maximum(np.diag(stats.cross), 0.0) / max(stats.n, 1))
    w = np.zeros(k)
    if stats.n and spread[k] > 0:
        use = np.flatnonzero(spread[:k] > 0)
        scale = stats.n * spread[use]
        G = stats.cross[np.ix_(use, use)] / (scale[:, None] * spread[use])
        c = stats.cross[use, k] / (scale * spread[k])
        l1 = reg_param / spread[k] * elastic_net
        l2 = reg_param / spread[k] * (1 - elastic_net)
        w[use] = _ridge(G, c, l2) if l1 == 0 else _descend(G, c, l1, l2)
        w[use] *= spread[k] / spread[use]
    intercept = stats.mean[k] - float(w @ stats.mean[:k])
    return LinearPoint(list(stats.features), float(reg_param), float(elastic_net), [float(x) for x in w], float(intercept),
                       stats.vector)


def _ridge(G: np.ndarray, c: np.ndarray, l2: float) -> np.ndarray:
    return np.linalg.lstsq(G + l2 * np.eye(len(c)), c, rcond=None)[0]


def _descend(G: np.ndarray, c: np.ndarray, l1: float, l2: float) -> np.ndarray:
    w = np.zeros(len(c))
    for _ in range(SWEEPS):
        moved = 0.0
        for j in range(len(c)):
            rest = c[j] - G[j] @ w + G[j, j] * w[j]
            new = np.sign(rest) * max(abs(rest) - l1, 0.0) / (G[j, j] + l2)
            moved = max(moved, abs(new - w[j]))
            w[j] = new
        if moved <= TOLERANCE:
            return w
    raise NoConvergence(f"no fixed point in {SWEEPS} sweeps")


def elastic_net_grid(stats: Sufficient, reg_params, elastic_nets) -> list[LinearPoint]:
    """Every point of the grid, from the same statistics: no further pass over the rows."""
    return [solve(stats, r, a) for r in reg_params for a in elastic_nets]


def coefficient_rows(spark: SparkSession, points: list[LinearPoint], digits: int | None = None) -> DataFrame:
    """(reg_param, elastic_net, term, value) of all points; the intercept is a term too."""
    rows = [(p.reg_param, p.elastic_net, t, v) for p in points
            for t, v in [("intercept", p.intercept), *zip(p.features, p.coefficients)]]
    out = spark.createDataFrame(rows, "reg_param double, elastic_net double, term string, value double")
    return out if digits is None else out.withColumn("value", F.round("value", digits))


def grid_rmse(df: DataFrame, points: list[LinearPoint], label: str) -> list[float]:
    """Every point's RMSE, all from one pass over ``df``."""
    errors = [F.sqrt(F.avg(F.pow(F.col(label).cast("double") - p.expression(), 2))).alias(f"e{i}") for i, p in enumerate(points)]
    return [float("nan") if e is None else float(e) for e in df.agg(*errors).first()]


def optimality(df: DataFrame, points: list[LinearPoint], label: str) -> DataFrame:
    """(reg_param, elastic_net, feature, gap): how far every coefficient is from the optimality
    condition, from the residuals of the rows themselves (one pass; it does not use the
    co-moments).  With g the mean product of standardised residual and feature less the
    ridge part, the gap is |g - l1 sign(w)| where w is not zero and max(|g| - l1, 0) where it is."""
    spark = df.sparkSession
    features, vector = points[0].features, points[0].vector
    column = (lambda i, f: vector_to_array(F.col(vector))[i]) if vector else (lambda i, f: F.col(f).cast("double"))
    y = F.col(label).cast("double")
    rows = df.select(y.alias("y"), *[column(i, f).alias(f"x{i}") for i, f in enumerate(features)],
                     *[(y - p.expression()).alias(f"r{i}") for i, p in enumerate(points)]).dropna("any")
    def spread_of(c: str) -> Column:        # exactly zero for a constant column
        return F.when(F.min(c) < F.max(c), F.stddev_pop(c)).otherwise(0.0)

    wanted = [spread_of("y").alias("s")] + [spread_of(f"x{i}").alias(f"s{i}") for i in range(len(features))]
    wanted += [F.covar_pop(f"r{p}", f"x{i}").alias(f"g{p}_{i}") for p in range(len(points)) for i in range(len(features))]
    found = rows.agg(*wanted).first()
    out = []
    for p, point in enumerate(points):
        l1 = point.reg_param * point.elastic_net / found.s if found.s else 0.0
        l2 = point.reg_param * (1 - point.elastic_net) / found.s if found.s else 0.0
        for i, f in enumerate(features):
            spread, gap = found[f"s{i}"], 0.0
            if spread and found.s:
                w = point.coefficients[i] * spread / found.s
                g = found[f"g{p}_{i}"] / (found.s * spread) - l2 * w
                gap = abs(g - l1 * np.sign(w)) if w else max(abs(g) - l1, 0.0)
            out.append((point.reg_param, point.elastic_net, f, float(gap)))
    return spark.createDataFrame(out, "reg_param double, elastic_net double, feature string, gap double")
