"""Aggregations: grouped means, global means, counts, RMSE.

All are single ``agg`` calls: one job, map-side partial aggregation, so a
hot group costs one partial row per task, never a gathered group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.scalars import to_decimal_via_float


def _as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _round(c: Column, digits: int | None) -> Column:
    return c if digits is None else F.round(c, digits)


def group_mean(df: DataFrame, keys, value, alias: str, as_decimal: tuple | None = (10, 2),
               round_digits: int | None = None) -> DataFrame:
    """Mean of ``value`` per group; optionally narrowed float -> decimal(p, s)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    m = _round(F.avg(_as_col(value)), round_digits)
    if as_decimal:
        m = to_decimal_via_float(m, *as_decimal)
    return df.groupBy(*keys).agg(m.alias(alias))


def global_means(df: DataFrame, cols, digits=None) -> DataFrame:
    """Means of many columns in ONE job (not one job per column).

    ``digits`` is None, an int, or a dict ``{col: digits}``."""
    exprs = []
    for c in cols:
        d = digits.get(c) if isinstance(digits, dict) else digits
        exprs.append(_round(F.avg(F.col(c)), d).alias(c))
    return df.agg(*exprs)


def row_count(df: DataFrame, alias: str = "n_rows") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(alias))


def rmse(df: DataFrame, label, prediction, alias: str = "rmse",
         digits: int | None = None) -> DataFrame:
    """``sqrt(mean((label - prediction)^2))`` as a one-row DataFrame."""
    err = _as_col(label) - _as_col(prediction)
    return df.agg(_round(F.sqrt(F.avg(err * err)), digits).alias(alias))
