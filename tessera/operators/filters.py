"""Row filters.  Plain ``filter`` so predicates push down to the scan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CORRUPT_COLUMN = "_corrupt_record"


def filter_equal(df: DataFrame, **equals) -> DataFrame:
    """Keep rows whose columns equal the given values (null never equals)."""
    cond = None
    for name, value in equals.items():
        c = F.col(name) == F.lit(value)
        cond = c if cond is None else (cond & c)
    return df if cond is None else df.filter(cond)


def filter_not_equal(df: DataFrame, column: str, value) -> DataFrame:
    """``column <> value`` with SQL three-valued logic: nulls are dropped too."""
    return df.filter(F.col(column) != F.lit(value))


def drop_corrupt(df: DataFrame, column: str = CORRUPT_COLUMN) -> DataFrame:
    """Keep rows the PERMISSIVE reader parsed cleanly, then drop the marker.

    Run this *before* keyed dedup: a row can carry a valid key and a corrupt
    marker at once, and deduplicating first could keep the bad row and lose
    the key."""
    if column not in df.columns:
        return df
    return df.filter(F.col(column).isNull()).drop(column)
