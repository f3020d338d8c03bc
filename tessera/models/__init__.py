"""Spark ML wrappers: vectors, grids, hold-out search, run log."""

from tessera.models.elastic import (
    LinearPoint,
    coefficient_rows,
    elastic_net_grid,
    grid_rmse,
    optimality,
    sufficient,
)
from tessera.models.registry import best_runs, load_model, read_runs, register_runs, rescore
from tessera.models.search import (
    DEFAULT_EXPERIMENT,
    DEFAULT_GRIDS,
    RUN_LOG_SCHEMA,
    Run,
    append_run_log,
    assemble,
    best_run,
    correlation_matrix,
    grid,
    holdout_search,
    make_estimator,
    run_log,
    run_name,
    search_grids,
)

__all__ = [
    "LinearPoint", "best_runs", "coefficient_rows", "elastic_net_grid", "grid_rmse", "load_model", "optimality",
    "read_runs", "register_runs", "rescore", "sufficient", "DEFAULT_EXPERIMENT", "DEFAULT_GRIDS", "RUN_LOG_SCHEMA", "Run", "append_run_log", "assemble", "best_run",
    "correlation_matrix", "grid", "holdout_search", "make_estimator", "run_log", "run_name",
    "search_grids",
]
