"""Projection-level operators: select, rename, drop, constants, id copy.

All of them emit a single ``select`` so Catalyst sees one projection and
column pruning reaches the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def has_columns(df: DataFrame, *cols: str) -> bool:
    """Plan-time guard: apply a step only if its columns exist."""
    return all(c in df.columns for c in cols)


def rename(df: DataFrame, mapping: dict) -> DataFrame:
    """Rename many columns at once; names that are absent are ignored."""
    present = {k: v for k, v in mapping.items() if k in df.columns}
    return df.withColumnsRenamed(present) if present else df


def drop_columns(df: DataFrame, *cols: str) -> DataFrame:
    """Drop columns; absent names are ignored."""
    return df.drop(*cols)


def with_constant(df: DataFrame, name: str, value, dtype: str | None = None) -> DataFrame:
    col = F.lit(value)
    if dtype:
        col = col.cast(dtype)
    return df.withColumn(name, col)


def copy_as_id(df: DataFrame, source: str, id_col: str = "_id", dtype: str | None = None) -> DataFrame:
    """``_id = source`` (optionally cast, e.g. to string for a document key)."""
    col = F.col(source)
    if dtype:
        col = col.cast(dtype)
    return df.withColumn(id_col, col)
