"""Named query plans over the driver tables and recipes for the real sources."""

from tessera.plans import catalogue as c
from tessera.plans.oracle import ORACLE_SQL

QUERIES = {
    "feature_table": c.feature_table,
    "snapshot_scan": c.snapshot_scan,
    "picked_files": c.picked_files,
    "schema_unify": c.schema_unify,
    "first_wins_schema": c.first_wins_schema,
    "keyed_object_scan": c.keyed_object_scan,
    "csv_scan": c.csv_scan,
    "csv_inferred": c.csv_inferred,
    "parquet_scan": c.parquet_scan,
    "partitioned_scan": c.partitioned_scan,
    "versioned_table": c.versioned_table,
    "paged_records": c.paged_records,
    "offset_pages": c.offset_pages,
    "source_registry": c.source_registry,
    "document_collection": c.document_collection,
    "table_profile": c.table_profile_q,
    "rename_drop": c.rename_drop,
    "constant_column": c.constant_column,
    "filter_equal": c.filter_equal_q,
    "filter_not_equal_null": c.filter_not_equal_null,
    "corrupt_filter": c.corrupt_filter,
    "surrogate_key": c.surrogate_key_q,
    "mixed_concat_key": c.mixed_concat_key,
    "separated_key": c.separated_key,
    "canonicalise": c.canonicalise_q,
    "canonicalise_rules": c.canonicalise_rules,
    "casts": c.casts,
    "year_from_name": c.year_from_name_q,
    "left_join": c.left_join,
    "left_join_two_keys_null": c.left_join_two_keys_null,
    "star_join_two_keys": c.star_join_two_keys,
    "left_join_fanout": c.left_join_fanout,
    "skewed_join": c.skewed_join,
    "union_positional": c.union_positional,
    "union_by_name": c.union_by_name_q,
    "distinct_values": c.distinct_values_q,
    "keyed_dedup": c.keyed_dedup,
    "first_order_per_customer": c.first_order_per_customer,
    "drop_duplicates_count": c.drop_duplicates_count,
    "group_mean_decimal": c.group_mean_decimal,
    "global_means": c.global_means_q,
    "mean_impute": c.mean_impute_q,
    "one_hot": c.one_hot_q,
    "one_hot_discovered": c.one_hot_discovered,
    "correlation_ranking": c.correlation_ranking_q,
    "correlation_matrix": c.correlation_matrix_q,
    "feature_selection": c.feature_selection,
    "key_split": c.key_split_q,
    "rmse": c.rmse_q,
    "linear_regression": c.linear_regression,
    "elastic_net_grid": c.elastic_net_grid_q,
    "vector_features": c.vector_features,
    "random_split": c.random_split_q,
    "random_forest": c.random_forest,
    "gbt": c.gbt,
    "model_search": c.model_search,
    "run_log": c.run_log_q,
    "model_registry": c.model_registry,
    "incremental_ingest": c.incremental_ingest,
}

# SURVEY §2 operator ids exercised by each query (traceability).
COVERS = {
    "feature_table": "P1 P8 F1 F5 F6 M1 A1 J1 J2",
    "snapshot_scan": "S1 S2 S6 K3",
    "picked_files": "S5 S8 K1",
    "schema_unify": "S2 S3 U1",
    "first_wins_schema": "S1 S2 S3 S6",
    "keyed_object_scan": "S4",
    "csv_scan": "S7 K4",
    "csv_inferred": "S7 K4",
    "parquet_scan": "S9 K2",
    "partitioned_scan": "S10 K3",
    "versioned_table": "S10 K3",
    "paged_records": "S11",
    "offset_pages": "S11",
    "source_registry": "S12 A3",
    "document_collection": "K5 P10",
    "table_profile": "K6 A3",
    "rename_drop": "P3 P4 P6 P10",
    "constant_column": "P2",
    "filter_equal": "P7",
    "filter_not_equal_null": "P8",
    "corrupt_filter": "P9",
    "surrogate_key": "F1 F2 F3",
    "mixed_concat_key": "F4",
    "separated_key": "F4",
    "canonicalise": "F1 F5",
    "canonicalise_rules": "F1 F5",
    "casts": "F7 F8",
    "year_from_name": "F9 S6",
    "left_join": "J1",
    "left_join_two_keys_null": "J1",
    "star_join_two_keys": "J1 J2",
    "left_join_fanout": "J3",
    "skewed_join": "J1 J3",
    "union_positional": "U2",
    "union_by_name": "U1",
    "distinct_values": "U3",
    "keyed_dedup": "U4",
    "first_order_per_customer": "U4",
    "drop_duplicates_count": "U4",
    "group_mean_decimal": "A1 F7",
    "global_means": "A2",
    "mean_impute": "M2 F10",
    "one_hot": "M1 F6",
    "one_hot_discovered": "M1 U3",
    "correlation_ranking": "A4 M4",
    "correlation_matrix": "A4",
    "feature_selection": "M5",
    "key_split": "M6",
    "rmse": "A5",
    "linear_regression": "M8",
    "elastic_net_grid": "M8 M10",
    "vector_features": "M3 M2",
    "random_split": "M6",
    "random_forest": "M7 M12 M3",
    "gbt": "M9 M12",
    "model_search": "M8 M7 M10 M11 M13 A4 M4 M5 A5",
    "run_log": "M13 M11",
    "model_registry": "M8 M11 M12 M13",
    "incremental_ingest": "T1 U4",
}

__all__ = ["COVERS", "ORACLE_SQL", "QUERIES"]
