"""Correlation ranking and threshold feature selection.

One pass: every (feature, target) pair contributes ``covar_pop`` and two
``var_pop`` buffers to a single aggregate (mergeable, numerically stable —
no raw sums of squares).  A zero-variance column yields a null ``r``
instead of a divide-by-zero error under ANSI mode, and null never passes a
threshold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _pearson(x: Column, y: Column) -> Column:
    vx, vy = F.var_pop(x), F.var_pop(y)
    return F.when((vx > 0) & (vy > 0), F.covar_pop(x, y) / F.sqrt(vx * vy))


def correlation_ranking(df: DataFrame, features, target, digits: int | None = None,
                        feature_col: str = "feature", value_col: str = "r",
                        include_target: bool = False) -> DataFrame:
    """Long DataFrame ``(feature, r)`` of Pearson r against ``target``,
    ordered by ``|r|`` descending (nulls last).

    ``features`` is a list of names or a dict ``{name: Column}``; ``target``
    a name or Column.  ``include_target`` adds the target's own row (r = 1
    unless it is constant), as the last column of a correlation matrix has."""
    feats = features if isinstance(features, dict) else {f: F.col(f) for f in features}
    if include_target and isinstance(target, str) and target not in feats:
        feats = {**feats, target: F.col(target)}
    y = _as_col(target).cast("double")
    exprs = []
    for i, (name, x) in enumerate(feats.items()):
        r = _pearson(_as_col(x).cast("double"), y)
        if digits is not None:
            r = F.round(r, digits)
        exprs.append(r.alias(f"c{i}"))
    wide = df.agg(*exprs)
    # one row -> one row per feature, without a driver round trip
    pairs = F.array(*[F.struct(F.lit(name).alias(feature_col), F.col(f"c{i}").alias(value_col))
                      for i, name in enumerate(feats)])
    long = wide.select(F.inline(pairs))
    return long.orderBy(F.abs(F.col(value_col)).desc_nulls_last(), F.col(feature_col))


def select_features(ranking: DataFrame, threshold: float = 0.1, exclude=(),
                    feature_col: str = "feature", value_col: str = "r") -> DataFrame:
    """Features with ``|r| > threshold`` (strict); excluded names dropped."""
    out = ranking.filter(F.abs(F.col(value_col)) > F.lit(threshold))
    if exclude:
        out = out.filter(~F.col(feature_col).isin(list(exclude)))
    return out
