"""Relational and feature operators, each a DataFrame composition."""

from tessera.operators.aggregate import global_means, group_mean, rmse, row_count
from tessera.operators.columns import copy_as_id, drop_columns, has_columns, rename, with_constant
from tessera.operators.dedup import drop_duplicates, duplicate_keys, keep_one
from tessera.operators.encode import discover_values, one_hot
from tessera.operators.filters import drop_corrupt, filter_equal, filter_not_equal
from tessera.operators.impute import column_means, impute_with, mean_impute
from tessera.operators.joins import bounded_broadcast, enrich, materialise
from tessera.operators.moments import co_moments, correlation_matrix
from tessera.operators.partitioning import balance
from tessera.operators.profile import preview, table_profile
from tessera.operators.sets import distinct_values, union_all, union_by_name
from tessera.operators.skew import heavy_keys, skew_join
from tessera.operators.split import key_split, random_split, random_split_labelled, split_parts
from tessera.operators.stats import correlation_ranking, select_features

__all__ = [
    "balance", "bounded_broadcast", "co_moments", "column_means", "copy_as_id", "correlation_matrix",
    "correlation_ranking",
    "discover_values", "distinct_values", "drop_columns", "drop_corrupt",
    "drop_duplicates", "duplicate_keys", "enrich", "filter_equal",
    "filter_not_equal", "global_means", "group_mean", "has_columns", "heavy_keys", "impute_with", "keep_one",
    "key_split", "materialise", "mean_impute", "one_hot", "preview",
    "random_split", "random_split_labelled", "rename", "rmse", "row_count",
    "select_features", "skew_join", "split_parts", "table_profile", "union_all",
    "union_by_name", "with_constant",
]
