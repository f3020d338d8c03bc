"""Train-and-validate recipe: impute -> correlation selection -> split ->
hold-out grid search per model family -> run log.

Differences from a naive loop, all for scale:
* means of all columns in ONE job; correlations against the label in ONE
  job (not a driver-side matrix walk);
* the assembled train / validation splits are persisted once and reused by
  every fit;
* ``split='key'`` gives a layout-independent split by a key column.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.models import DEFAULT_EXPERIMENT, DEFAULT_GRIDS, assemble, run_log, search_grids
from tessera.operators import (
    balance,
    column_means,
    correlation_ranking,
    impute_with,
    key_split,
    random_split,
    select_features,
    split_parts,
)


class NoFeatureSelected(ValueError):
    pass


@dataclass
class TrainResult:
    selected: list
    ranking: DataFrame
    runs: list
    log: DataFrame


@dataclass
class Preparation:
    """What is learnt before fitting: imputation means and chosen features."""
    means: dict
    selected: list
    ranking: DataFrame


def fit_preparation(df: DataFrame, feature_columns, label: str,
                    threshold: float = 0.1) -> Preparation:
    """Means of features and label (one job, the label is imputed too as in
    the reference), |r| ranking against the label including the label's own
    row (one job), and the features with ``|r| > threshold``."""
    cols = list(feature_columns)
    means = column_means(df, cols + [label])
    data = impute_with(df, means)
    ranking = correlation_ranking(data, cols, label, include_target=True)
    chosen = select_features(ranking, threshold, exclude=[label]).collect()
    selected = [r["feature"] for r in chosen]  # at most len(feature_columns) names
    if not selected:
        raise NoFeatureSelected(f"no feature has |r| > {threshold} with {label}")
    return Preparation(means, selected, ranking)


def apply_preparation(df: DataFrame, prep: Preparation, label: str,
                      features_col: str = "selected_features", keep=()) -> DataFrame:
    data = impute_with(df, prep.means)
    return assemble(data, prep.selected, features_col).select(*keep, label, features_col)


def prepare(df: DataFrame, feature_columns, label: str, threshold: float = 0.1,
            features_col: str = "selected_features", keep=()):
    """Fit the preparation on ``df`` and apply it to ``df`` itself."""
    prep = fit_preparation(df, feature_columns, label, threshold)
    return apply_preparation(df, prep, label, features_col, keep), prep.selected, prep.ranking


def split(df: DataFrame, how: str = "random", key: str | None = None, seed: int = 42,
          weights=(0.8, 0.2)):
    if how == "key":
        if key is None:
            raise ValueError("key split needs a key column")
        n = 10
        return split_parts(key_split(df, key, int(round(weights[0] * n)), n, hashed=True))
    return tuple(random_split(df, weights, seed))


def train_and_validate(df: DataFrame, feature_columns, label: str = "price", grids=None,
                       threshold: float = 0.1, split_how: str = "random", key: str | None = None,
                       seed: int = 42, experiment: str = DEFAULT_EXPERIMENT,
                       parallelism: int = 1, save_dir: str | None = None,
                       fit_on: str = "all") -> TrainResult:
    """Impute -> select -> split -> grid search per family -> run log.

    ``fit_on="all"`` learns means and features on the whole table before the
    split (the reference's order); ``fit_on="train"`` splits first and learns
    them on the training part only, so validation rows never leak in."""
    if fit_on not in ("all", "train"):
        raise ValueError(f"fit_on must be 'all' or 'train', not {fit_on!r}")
    grids = DEFAULT_GRIDS if grids is None else grids
    keep = [key] if (split_how == "key" and key) else []
    needed = list(dict.fromkeys([*keep, *feature_columns, label]))
    # one pass over the input feeds both splits; each split is then cached
    # as-is (a random split re-sorts its input on every use otherwise)
    if fit_on == "all":
        prep = fit_preparation(df, feature_columns, label, threshold)
        data = balance(apply_preparation(df, prep, label, keep=keep))
        data = data.persist(StorageLevel.MEMORY_AND_DISK)
        train, val = split(data, split_how, key, seed)
    else:
        data = balance(df.select(*needed)).persist(StorageLevel.MEMORY_AND_DISK)
        train_raw, val_raw = split(data, split_how, key, seed)
        prep = fit_preparation(train_raw, feature_columns, label, threshold)
        train = apply_preparation(train_raw, prep, label, keep=keep)
        val = apply_preparation(val_raw, prep, label, keep=keep)
    train = train.persist(StorageLevel.MEMORY_AND_DISK)
    val = val.persist(StorageLevel.MEMORY_AND_DISK)
    train.count()
    val.count()
    data.unpersist()
    try:
        runs = search_grids(grids, train, val, label, "selected_features", seed, parallelism,
                            save_dir)
    finally:
        train.unpersist()
        val.unpersist()
    spark = df.sparkSession
    return TrainResult(prep.selected, prep.ranking, runs, run_log(spark, experiment, runs))


def scored(model, df: DataFrame, keep=()) -> DataFrame:
    """Batch scoring: the model's ``prediction`` next to the kept columns."""
    return model.transform(df).select(*keep, F.col("prediction"))
