"""Surrogate keys built by string concatenation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def surrogate_key(name, suffix) -> Column:
    """``lower(name with whitespace -> '_') || suffix``; null if any part is null."""
    slug = F.lower(F.regexp_replace(_as_col(name), r"[\s]", "_"))
    return F.concat(slug, _as_col(suffix).cast("string"))


def concat_key(*parts, sep: str | None = None) -> Column:
    """Concatenate parts cast to string.  Without ``sep`` (the reference's
    form) distinct tuples may collide ("1"+"12" == "11"+"2"); pass a ``sep``
    for a collision-free key.  Null if any part is null in both forms."""
    cols = [_as_col(p).cast("string") for p in parts]
    if sep is None:
        return F.concat(*cols)
    # concat_ws skips nulls; keep the null-if-any-null contract explicitly
    any_null = None
    for c in cols:
        any_null = c.isNull() if any_null is None else (any_null | c.isNull())
    return F.when(any_null, F.lit(None).cast("string")).otherwise(F.concat_ws(sep, *cols))
