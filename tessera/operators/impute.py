"""Mean imputation.

Means of all columns come from ONE aggregate; the resulting single row of
k numbers (bounded by the column count, not the data) fills nulls with
``fillna``.  Like ``fillna``, NaN is filled too.  An all-null column has no
mean and is left as is (reported by ``mean_impute(..., strict=True)``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class NoMean(ValueError):
    pass


def column_means(df: DataFrame, cols) -> dict:
    row = df.agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in cols]).first()
    return {c: row[c] for c in cols}


def impute_with(df: DataFrame, means: dict) -> DataFrame:
    """Cast the columns of ``means`` to double and fill their nulls (and NaN)
    with the given means; columns without a mean are only cast."""
    out = df.withColumns({c: F.col(c).cast("double") for c in means})
    fill = {c: m for c, m in means.items() if m is not None}
    return out.fillna(fill) if fill else out


def mean_impute(df: DataFrame, cols, fit_on: DataFrame | None = None,
                strict: bool = False) -> DataFrame:
    """Cast ``cols`` to double and fill nulls with their mean.

    ``fit_on`` computes the means on another frame (e.g. the training split,
    to avoid leakage); default is ``df`` itself."""
    cols = list(cols)
    out = df.withColumns({c: F.col(c).cast("double") for c in cols})
    means = column_means(fit_on if fit_on is not None else out, cols)
    missing = [c for c, m in means.items() if m is None]
    if missing and strict:
        raise NoMean(f"no mean for all-null columns {missing}")
    fill = {c: m for c, m in means.items() if m is not None}
    return out.fillna(fill) if fill else out
