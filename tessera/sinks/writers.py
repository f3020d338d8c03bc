"""Distributed writers.

``write_partitioned`` defaults to plain Parquet and uses Delta only when its
package is importable *and* requested; the same format is used to read the
table back, so no stale files from an earlier overwrite leak into a read.
"""

from __future__ import annotations

import importlib.util

from pyspark.sql import DataFrame

from tessera.operators.dedup import duplicate_keys


class DuplicateKey(ValueError):
    pass


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """JSON lines; null fields are omitted (Spark's default)."""
    df.write.mode(mode).json(path)
    return path


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    df.write.mode(mode).parquet(path)
    return path


def write_csv(df: DataFrame, path: str, header: bool = True, mode: str = "overwrite") -> str:
    """CSV that ``read_csv`` reads back unchanged: spaces, line ends, quotes and empty strings kept.

    A value may hold line ends, so a file is read by one task: files are cut
    at a million rows."""
    df.write.mode(mode).options(header=str(header).lower(), ignoreLeadingWhiteSpace="false",
                                ignoreTrailingWhiteSpace="false", escape='"', nullValue="\\N",
                                maxRecordsPerFile="1000000").csv(path)
    return path


def delta_available() -> bool:
    return importlib.util.find_spec("delta") is not None


def write_partitioned(df: DataFrame, path: str, partition_by, fmt: str = "parquet",
                      mode: str = "overwrite", rebalance: bool = True) -> str:
    """Hive-style partitioned overwrite.

    With ``rebalance`` (default) rows are shuffled by the partition columns
    under a ``rebalance`` hint: each partition value is written by few tasks
    (not one file per value per input task — millions of small files at
    scale), and AQE splits a hot value into advisory-sized chunks, so a value
    holding a third of all rows is still written by many tasks.
    ``rebalance=False`` writes straight from the input partitions."""
    partition_by = [partition_by] if isinstance(partition_by, str) else list(partition_by)
    if fmt == "delta" and not delta_available():
        raise RuntimeError("delta format requested but its package is not installed")
    if rebalance:
        df = df.hint("rebalance", *partition_by)
    df.write.format(fmt).mode(mode).partitionBy(*partition_by).save(path)
    return path


def write_collection(df: DataFrame, path: str, key: str = "_id", fmt: str = "json") -> str:
    """Replace-all write of a keyed document collection.

    The key must be non-null and unique; that is checked first with one
    distributed aggregate over the key column only (the reference's
    document store rejects duplicates on insert).  Nothing goes through the
    driver.  The check and the write each evaluate ``df``: pass a stored
    (or persisted) frame when it is expensive to compute, as ``build_zones``
    does with the formatted tables it has just written."""
    bad = duplicate_keys(df, [key]).limit(1).collect()
    if bad:
        raise DuplicateKey(f"key {key!r} is null or not unique, e.g. {bad[0][key]!r}")
    df.write.format(fmt).mode("overwrite").save(path)
    return path
