"""Enrichment joins (fact LEFT JOIN dimension on shared key names).

Strategy:
* ``auto`` (default) materialises the dimension once into the shared
  checkpoint folder, measures it, and broadcasts it only when its rows are
  within ``max_broadcast_rows`` and their bytes within ``MAX_BROADCAST_BYTES``; otherwise it stays a shuffle join, where
  AQE's skew-join split handles hot keys on the fact side.
* ``broadcast`` / ``shuffle`` force one side of that choice; ``skew`` splits the keys
  that are heavy on either side (``tessera.operators.skew``).

The dimension is deduplicated on its key by construction in the recipes
(grouped aggregates); ``check_unique`` verifies it with one distributed
count and raises instead of silently fanning out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.dedup import duplicate_keys
from tessera.session import scratch_path

DEFAULT_MAX_BROADCAST_ROWS = 2_000_000
MAX_BROADCAST_BYTES = 128 << 20


class DimensionNotUnique(ValueError):
    pass


def materialise(df: DataFrame, name: str = "materialised") -> DataFrame:
    """Write ``df`` once as a Parquet table in the shared checkpoint folder
    and read it back: lineage is cut (survives executor loss; never a
    machine-local copy), and Catalyst sees its real on-disk size."""
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def measured(df: DataFrame) -> tuple:
    """(rows, bytes) of a frame: 16 bytes a number, strings and binaries by length, nested
    values by that of their JSON form."""
    def width(field):
        kind = field.dataType.simpleString()
        if kind in ("string", "binary"):
            return F.coalesce(F.octet_length(f"`{field.name}`").cast("long"), F.lit(0)) + 16
        if kind.split("<")[0] in ("array", "map", "struct", "variant"):
            return F.coalesce(F.octet_length(F.to_json(F.struct(f"`{field.name}`"))).cast("long"), F.lit(0)) + 16
        return F.lit(16).cast("long")
    found = df.agg(F.count(F.lit(1)).alias("n"), F.sum(sum((width(f) for f in df.schema.fields), F.lit(0))).alias("b")).first()
    return found.n, int(found.b or 0)


def bounded_broadcast(df: DataFrame, max_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
                      materialise_first: bool = True, max_bytes: int | None = None):
    """Return ``(side, broadcast?)``: the side, hinted for broadcast only if it has at
    most ``max_rows`` rows and ``max_bytes`` bytes (default ``MAX_BROADCAST_BYTES``), both measured.

    ``materialise_first`` (for derived sides such as aggregates) writes it
    once, so the measuring and the join read the written copy instead of recomputing it.
    A side that is already a stored table is measured where it is
    (``materialise_first=False``), with no copy."""
    small = materialise(df, "dimension") if materialise_first else df
    rows, size = measured(small)
    if rows <= max_rows and size <= (MAX_BROADCAST_BYTES if max_bytes is None else max_bytes):
        return F.broadcast(small), True
    return small, False


def enrich(fact: DataFrame, dim: DataFrame, keys, how: str = "left",
           strategy: str = "auto", max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
           check_unique: bool = False, materialise_dim: bool = True) -> DataFrame:
    """``fact ⟕ dim USING (keys)``: keys first in the output, null keys never
    match.  ``materialise_dim=False`` for a dimension that is a stored table
    (see ``bounded_broadcast``).  With ``check_unique`` a non-unique dimension key raises
    ``DimensionNotUnique`` (the fan-out hazard); without it fan-out is kept."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    if strategy == "auto":
        side, _ = bounded_broadcast(dim, max_broadcast_rows, materialise_dim)
    elif strategy == "broadcast":
        side, fits = bounded_broadcast(dim, max_broadcast_rows, materialise_dim)
        if not fits:
            raise ValueError(f"the dimension has more than {max_broadcast_rows} rows or {MAX_BROADCAST_BYTES} bytes: too many to broadcast")
    elif strategy == "shuffle":
        side = dim
    elif strategy == "skew":
        side = materialise(dim, "dimension") if materialise_dim else dim
    else:
        raise ValueError(f"unknown join strategy {strategy!r}")
    if check_unique and duplicate_keys(side.filter(_not_null(keys)), keys).limit(1).count() > 0:
        raise DimensionNotUnique(f"dimension key {keys} is not unique")
    if strategy == "skew":
        from tessera.operators.skew import skew_join

        return skew_join(fact, side, keys, how)
    return fact.join(side, keys, how)


def _not_null(keys):
    cond = None
    for k in keys:
        c = F.col(k).isNotNull()
        cond = c if cond is None else (cond & c)
    return cond
