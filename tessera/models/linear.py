"""Closed-form least-squares line (one feature, no regularisation).

``regr_slope`` / ``regr_intercept`` / ``regr_r2`` are mergeable aggregates:
one pass, map-side partial aggregation, no iterative solver.  For several
features or regularisation use ``LinearRegression`` via ``holdout_search``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def fit_line(df: DataFrame, label, feature, digits: dict | None = None) -> DataFrame:
    """One row ``(slope, intercept, r2, n)`` of ``label ~ feature``."""
    y, x = _as_col(label), _as_col(feature)
    digits = digits or {}
    out = {
        "slope": F.regr_slope(y, x),
        "intercept": F.regr_intercept(y, x),
        "r2": F.regr_r2(y, x),
        "n": F.regr_count(y, x),
    }
    return df.agg(*[(F.round(c, digits[k]) if k in digits else c).alias(k) for k, c in out.items()])


def predict_line(df: DataFrame, line: DataFrame, feature, out: str = "prediction") -> DataFrame:
    """Batch scoring with a fitted line: its two coefficients (one row) become
    literals of a projection, so scoring is a map-only stage."""
    row = line.select("slope", "intercept").first()
    return df.withColumn(out, F.lit(row["intercept"]) + F.lit(row["slope"]) * _as_col(feature))
