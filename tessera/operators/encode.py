"""Indicator (one-hot) columns named by category value.

A fixed vocabulary is the default: it keeps the output schema stable even
when a value is absent from the data (absent -> an all-zero column) and
needs no job.  Discovering the vocabulary runs one distributed ``distinct``
and brings back the values, never the data; more than ``max_values`` of
them (default ``MAX_CATEGORIES``: each becomes a column) are an error.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.scalars import indicator


class TooManyCategories(ValueError):
    pass


MAX_CATEGORIES = 1000


def discover_values(df: DataFrame, column: str, max_values: int = MAX_CATEGORIES) -> list:
    rows = df.select(column).distinct().limit(max_values + 1).collect()
    if len(rows) > max_values:
        raise TooManyCategories(f"{column} has more than {max_values} distinct values")
    return sorted((r[0] for r in rows if r[0] is not None), key=str)


def one_hot(df: DataFrame, column: str, values=None, names=None, prefix: str = "",
            drop: bool = True, max_values: int = MAX_CATEGORIES, extend: bool = False) -> DataFrame:
    """Add one INT 0/1 column per value (null category -> all zeros).

    ``extend`` adds a column for every value found beyond the given ones.

    Column names are ``prefix + value`` unless ``names`` maps value -> name.
    Name clashes with existing columns (compared case-insensitively, as
    Spark resolves names) raise instead of overwriting silently."""
    if values is None:
        values = discover_values(df, column, max_values)
    elif extend:
        values = [*values, *(v for v in discover_values(df, column, max_values) if v not in values)]
    names = names or {}
    existing = {c.lower() for c in df.columns if not (drop and c == column)}
    new_cols = []
    for v in values:
        name = names.get(v, f"{prefix}{v}")
        if name.lower() in existing:
            raise ValueError(f"indicator column {name!r} clashes with an existing column")
        existing.add(name.lower())
        new_cols.append(indicator(column, v).alias(name))
    keep = [F.col(c) for c in df.columns if not (drop and c == column)]
    return df.select(*keep, *new_cols)
