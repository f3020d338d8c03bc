"""Partition-count helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame


def balance(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Spread a frame evenly (round robin) before CPU-heavy work on it: iterative fits, text
    serialisation.  By default over as many partitions as a shuffle has, and at least one a
    core.  It always shuffles and never looks at its input, so it runs no job of its own."""
    spark = df.sparkSession
    own = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return df.repartition(partitions or own)
