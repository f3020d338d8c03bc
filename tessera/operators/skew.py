"""Equi-joins of two large sides with heavy keys.

A sketch on each side (a mergeable frequent-items sketch of the keys' hashes, one small
aggregate) names the keys that may hold more rows than a task should; their exact numbers on
both sides follow from one filtered count.  Then
* all other rows are joined plainly,
* a heavy key's rows are dealt to an A x B grid of cells: a fact row goes to one of A rows
  of cells and is copied along it, a dimension row to one of B columns, so a pair meets in
  exactly one cell and a cell holds about ``target_rows`` of either side,
* heavy fact keys that the dimension does not have are not joined at all.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

#: rows of one key that a task should join at most
TARGET_ROWS = 1_000_000
#: heavy keys looked for on each side, and items that a sketch keeps (it finds every key
#: with over N / ITEMS of N rows or so; lighter ones stay with the plain join)
HEAVY_KEYS = 1000
ITEMS = 100_000

_A, _B, _I, _J = "__tessera_rows", "__tessera_columns", "__tessera_i", "__tessera_j"


def _hash(keys):
    return F.xxhash64(*[F.col(f"`{k}`") for k in keys])


def _there(keys):
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(f"`{k}`").isNotNull()
    return cond


def heavy_hashes(df: DataFrame, keys, target_rows: int = TARGET_ROWS) -> list:
    """Hashes of the keys that may have more than ``target_rows`` rows (``HEAVY_KEYS`` at most)."""
    top = df.where(_there(keys)).agg(F.call_function("approx_top_k", _hash(keys), F.lit(HEAVY_KEYS), F.lit(ITEMS)).alias("top")).first()[0]
    return [item.item for item in top or [] if item["count"] > target_rows]


def heavy_keys(fact: DataFrame, dim: DataFrame, keys, target_rows: int = TARGET_ROWS) -> DataFrame:
    """(keys, cells' rows, cells' columns) of the keys heavy on either side, at most twice
    ``HEAVY_KEYS``; no columns where the dimension lacks the key."""
    found = sorted({*heavy_hashes(fact, keys, target_rows), *heavy_hashes(dim, keys, target_rows)})
    spark, schema = fact.sparkSession, StructType([fact.schema[k] for k in keys])
    counts = []
    for side in (fact, dim):
        rows = side.where(_there(keys) & _hash(keys).isin(found)).groupBy(*keys).agg(F.count(F.lit(1)).alias(_A)).collect() \
            if found else []                                            # a row a heavy key
        counts.append({tuple(r)[:-1]: r[-1] for r in rows})
    out = [(*key, -(-n // target_rows), -(-counts[1].get(key, 0) // target_rows)) for key, n in counts[0].items()
           if max(n, counts[1].get(key, 0)) > target_rows]
    return spark.createDataFrame(out, StructType([*schema.fields, StructField(_A, LongType()), StructField(_B, LongType())]))


def _cell(df: DataFrame, cells: str):
    """A cell row or column for every row: by its values and its input partition, so neither a
    repeated value nor a lost task's second run changes how many rows a cell gets."""
    return F.pmod(F.xxhash64(F.spark_partition_id(), F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]))), F.col(cells))


def skew_join(fact: DataFrame, dim: DataFrame, keys, how: str = "left", target_rows: int = TARGET_ROWS) -> DataFrame:
    """``fact JOIN dim USING (keys)``, ``how`` being left or inner: keys first, then the other
    columns of both.  Null keys never match; rows that occur several times on a side match as
    often.  Both sides are read a few times (sketch, count, join): give stored tables."""
    if how not in ("left", "inner"):
        raise ValueError(f"a skew join is left or inner, not {how!r}")
    keys = [keys] if isinstance(keys, str) else list(keys)
    differ = [k for k in keys if fact.schema[k].dataType != dim.schema[k].dataType]
    if differ:
        raise ValueError(f"the keys {differ} have another type on the other side: cast them first")
    heavy = heavy_keys(fact, dim, keys, target_rows)
    if heavy.isEmpty():
        return fact.join(dim, keys, how)
    cells = F.broadcast(heavy)                                          # at most 2 * HEAVY_KEYS rows
    fact_cols, dim_cols = [c for c in fact.columns if c not in keys], [c for c in dim.columns if c not in keys]
    names = [*keys, *fact_cols, *dim_cols]
    plain = fact.join(cells, keys, "left_anti").join(dim.join(cells, keys, "left_anti"), keys, how).select(*names)

    known = F.broadcast(heavy.where(F.col(_B) > 0))
    rows = fact.join(known, keys).withColumn(_I, _cell(fact, _A)) \
        .withColumn(_J, F.explode(F.sequence(F.lit(0).cast("long"), F.col(_B) - 1))).select(*keys, *fact_cols, _I, _J)
    columns = dim.join(known, keys).withColumn(_J, _cell(dim, _B)) \
        .withColumn(_I, F.explode(F.sequence(F.lit(0).cast("long"), F.col(_A) - 1))).select(*keys, *dim_cols, _I, _J)
    met = rows.hint("shuffle_hash").join(columns, [*keys, _I, _J]).select(*names)
    out = plain.unionByName(met)
    if how == "left":
        lonely = fact.join(F.broadcast(heavy.where(F.col(_B) == 0)), keys, "left_semi")
        empty = [F.lit(None).cast(dim.schema[c].dataType).alias(c) for c in dim_cols]
        out = out.unionByName(lonely.select(*keys, *fact_cols, *empty))
    return out
