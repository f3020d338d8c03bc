"""Mixing sources to target weights (DataFrame functions only)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.session import read_table

from .base import small, stored, text_of, word_count

WEIGHTS = (1, 2, 3)
MAX_RATE = 3
SEED = "mix-1"


def ranked_sources(docs: DataFrame, weights=WEIGHTS) -> DataFrame:
    """``(source, source_size, weight)``, stored: sizes summed with map-side combine; the
    weights repeat along the sources in code point order, null last.

    The order is a range partitioning: ranks count within each partition, and the
    partitions' own counts (one row each) give the offsets, so no task sees all sources."""
    sizes = docs.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    order = F.col("source").asc_nulls_last()
    parts = stored(sizes.repartitionByRange(order).withColumn("part", F.spark_partition_id()), "sources")
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.groupBy("part").agg(F.count("*").alias("n")) \
        .select("part", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("offset"))
    rank = F.row_number().over(Window.partitionBy("part").orderBy(order)) - 1 + F.col("offset")
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (rank % len(weights) + 1).cast("int"))
    return stored(parts.join(offsets, "part").select("source", "source_size", weight.alias("weight")),
                  "weights")


def source_targets(sources: DataFrame, max_rate: int = MAX_RATE) -> DataFrame:
    """Adds ``target``: the total shared by weight; a source above ``max_rate`` times its
    size stops there and the excess is shared again until none is above.

    Every round is one aggregate row (sum of the capped limits, sum of the other
    weights); the level only rises, so the capped set only grows."""
    big = "decimal(38,0)"
    cap = F.col("source_size").cast(big) * max_rate
    total = int(sources.agg(F.sum("source_size")).first()[0] or 0)
    level, weights, capped = 0, 1, F.lit(False)
    seen = -1
    while True:
        row = sources.agg(F.sum(F.when(capped, cap)).alias("c"), F.sum(F.when(~capped, F.col("weight"))).alias("w"),
                          F.count(F.when(capped, 1)).alias("n")).first()
        if row.n == seen:
            break
        seen = row.n
        level, weights = total - int(row.c or 0), int(row.w or 0)
        if not weights:
            capped = F.lit(True)
            break
        capped = F.col("weight").cast(big) * F.lit(level).cast(big) > cap * F.lit(weights).cast(big)
    share = (F.col("weight") * F.lit(level).cast("long")).cast("double") / F.lit(float(max(weights, 1)))
    return sources.withColumn("target", F.when(capped, cap.cast("double")).otherwise(share))


def draw(doc_id: Column, seed: str) -> Column:
    """A number in [0, 1) fixed by document and seed: 52 bits of an MD5."""
    digest = F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("null")), F.lit("|" + seed)).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def mix(docs: DataFrame, weights=WEIGHTS, max_rate: int = MAX_RATE, seed: str = SEED) -> DataFrame:
    """``docs`` with ``size``, ``source_size``, ``target``, ``copies`` and ``taken``.

    Rate = target / source size; a document is taken floor(rate) times, and once more
    if its draw is below the fraction.  Null or empty text: size 0, taken 0.  A null
    source is a source of its own, ordered last.  Rows with equal doc_id (null
    included) share one draw, so repeated rows get equal decisions.  An empty table
    gives an empty result.  Input columns named like an added one are replaced."""
    sized = docs.withColumn("size", word_count(text_of()))
    targets = stored(source_targets(ranked_sources(sized, weights), max_rate), "targets")
    targets = targets.select(F.col("source").alias("__source"), F.col("source_size").alias("__total"),
                             F.col("target").alias("__target"))
    rate = F.when(F.col("__total") > 0, F.col("__target") / F.col("__total")).otherwise(F.lit(0.0))
    copies = F.floor(rate) + (draw(F.col("doc_id"), seed) < rate - F.floor(rate)).cast("long")
    return (sized.join(small(targets), F.col("source").eqNullSafe(F.col("__source")))
            .withColumn("source_size", F.col("__total")).withColumn("target", F.col("__target"))
            .withColumn("copies", copies).withColumn("taken", F.col("copies") * F.col("size"))
            .drop("__source", "__total", "__target"))


def emit(docs: DataFrame, **options) -> DataFrame:
    """The mixture itself: every row of ``docs`` as often as it is taken, same columns."""
    mixed = mix(docs.withColumn("__in", F.struct(*docs.columns)), **options)
    times = F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int")))
    return mixed.select("__in", times.alias("__copy")).select("__in.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken")


SQL = r"""
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
           FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
             (row_number() OVER (ORDER BY source COLLATE "binary" NULLS LAST) - 1) % 3 + 1 AS w
      FROM d GROUP BY source),
t AS (SELECT *, sum(source_size) OVER () AS total,
             coalesce(sum(3 * source_size) OVER o, 0) AS c, sum(w) OVER () - coalesce(sum(w) OVER o, 0) AS rest
      FROM s WINDOW o AS (ORDER BY source_size * 6 // w, coalesce(source, ''), source IS NULL
                          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
-- the first source, by limit over weight, that the level does not lift above its limit
lvl AS (SELECT total - c AS num, rest AS den FROM t WHERE w * (total - c) <= 3 * source_size * rest
        ORDER BY source_size * 6 // w, coalesce(source, ''), source IS NULL LIMIT 1),
g AS (SELECT source, source_size,
             CASE WHEN den IS NULL OR w * num > 3 * source_size * den THEN CAST(3 * source_size AS DOUBLE)
                  ELSE CAST(w * num AS DOUBLE) / CAST(den AS DOUBLE) END AS target
      FROM s LEFT JOIN lvl ON true),
r AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate FROM g)
SELECT doc_id, size, source_size, target,
       CAST(size * (CAST(floor(rate) AS BIGINT)
         + CASE WHEN CAST(CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'null') || '|mix-1'), 1, 13) AS BIGINT)
                          AS DOUBLE) / 4503599627370496.0 < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source
"""
