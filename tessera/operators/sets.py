"""Set operations: unions and distinct values."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame


def union_by_name(frames, allow_missing: bool = True) -> DataFrame:
    """Union by column name; columns missing on one side become null."""
    frames = list(frames)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), frames)


def union_all(frames) -> DataFrame:
    """Positional UNION ALL (duplicates kept).  Column names come from the
    first frame; types are widened by Catalyst."""
    frames = list(frames)
    return reduce(lambda a, b: a.union(b), frames)


def distinct_values(df: DataFrame, *cols: str) -> DataFrame:
    """Distinct values (null is a value), computed as a partial+final aggregate."""
    return df.select(*cols).distinct()
