"""Small scalar helpers: indicators, casts, year from a file name."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def indicator(c, value) -> Column:
    """1 when ``c == value`` else 0; null compares as 0 (INT)."""
    return F.when(_as_col(c) == F.lit(value), F.lit(1)).otherwise(F.lit(0))


def to_decimal_via_float(c, precision: int = 10, scale: int = 2, safe: bool = False) -> Column:
    """Narrow to float first, then to decimal — the two-step chain changes
    cents for some values (12345.675 -> 12345.67) and is kept on purpose.

    Values that do not fit raise under ANSI mode; ``safe=True`` makes them
    null instead (``try_cast``)."""
    as_float = _as_col(c).cast("float")
    target = f"decimal({precision},{scale})"
    return as_float.try_cast(target) if safe else as_float.cast(target)


def to_double(c) -> Column:
    """Booleans become 1.0 / 0.0; numbers widen to double."""
    return _as_col(c).cast("double")


def year_from_name(c, pattern: str = r"\d{4}") -> Column:
    """First 4-digit run of a name as INT, null when there is none."""
    found = F.regexp_extract(_as_col(c), pattern, 0)
    return F.when(found == "", F.lit(None)).otherwise(found).cast("int")
