"""Keyed de-duplication.

``keep_one`` is deterministic: it ranks the rows of each key by an explicit
order and keeps the first.  Written as ``row_number() == 1`` so Catalyst's
window-group-limit rewrite keeps only the top row per key *inside each map
task before the shuffle*; a key holding a third of all rows therefore
reaches its reducer as at most one row per input partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RN = "__tessera_rn"
_N = "__tessera_n"


def _order_cols(df: DataFrame, keys: list[str], order) -> list[Column]:
    cols: list[Column] = []
    named = set()
    for o in order or []:
        if isinstance(o, str):
            desc = o.startswith("-")
            name = o[1:] if desc else o
            named.add(name)
            cols.append(F.col(name).desc_nulls_last() if desc else F.col(name).asc_nulls_last())
        else:
            cols.append(o)
    # every remaining column breaks ties, so full ties are identical rows
    for name, dtype in df.dtypes:
        if name in keys or name in named:
            continue
        if "map<" in dtype or "variant" in dtype:   # not orderable: compare their JSON form
            cols.append(F.to_json(F.struct(name)).asc_nulls_last())
            continue
        cols.append(F.col(name).asc_nulls_last())
    return cols


def keep_one(df: DataFrame, keys, order=None) -> DataFrame:
    """One row per key: the first by ``order`` (then by every other column).

    ``order`` holds column names (ascending, nulls last; ``"-name"`` for
    descending, nulls last) or Column sort expressions.  Null keys form one group, as in
    ``dropDuplicates``.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    w = Window.partitionBy(*keys).orderBy(*_order_cols(df, keys, order))
    return df.withColumn(_RN, F.row_number().over(w)).filter(F.col(_RN) == 1).drop(_RN)


def drop_duplicates(df: DataFrame, keys) -> DataFrame:
    """Native ``dropDuplicates``: an arbitrary survivor per key, computed as a
    hash aggregate with map-side partial aggregation."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.dropDuplicates(keys)


def duplicate_keys(df: DataFrame, keys) -> DataFrame:
    """Keys that occur more than once (or are null) — a distributed check."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    null_key = None
    for k in keys:
        c = F.col(k).isNull()
        null_key = c if null_key is None else (null_key | c)
    counted = df.select(*keys).groupBy(*keys).agg(F.count(F.lit(1)).alias(_N))
    return counted.filter((F.col(_N) > 1) | null_key)
