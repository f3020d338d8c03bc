"""Incremental snapshot ingest with Structured Streaming.

New snapshot files in a landing folder are picked up by a file stream
(``trigger(availableNow=True)``: process what is new, then stop — a
scheduled job that remembers, via its checkpoint, what it has seen).  Each
micro-batch is merged into a keyed target table: the target's latest
version plus the batch, one row per key, latest by the given order wins.

The target is split into buckets by key hash.  A batch reads and rewrites
only the buckets that its keys fall in, into a folder of its own that never
changes again.  One commit record, written after the data, names the folder
of every bucket:
* readers follow the newest commit record, so half-written data is never seen,
* a frame from ``latest`` stays readable while later batches are merged,
* versions count the target's commits, whichever checkpoint a batch came from,
* a replayed batch is known by its stream's id and batch number, and skipped.
One stream writes a target at a time.
"""

from __future__ import annotations

import json
import os
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tessera.operators.dedup import keep_one

BUCKET = "_bucket"
#: buckets of a new target; a batch rewrites only those it touches
BUCKETS = 64

COMMIT_SCHEMA = ("version long, stream string, batch_id long, buckets int, table_schema string, "
                 "folders map<int, string>")


def _commits(spark: SparkSession, target: str) -> DataFrame | None:
    """The commit records; none if the target was never written."""
    try:
        return spark.read.schema(COMMIT_SCHEMA).parquet(os.path.join(target, "commits", "*"))
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def _last_commit(spark: SparkSession, target: str) -> Row | None:
    commits = _commits(spark, target)
    return None if commits is None else commits.orderBy(F.desc("version")).first()


def _read(spark: SparkSession, target: str, commit: Row, only: set[int] | None = None) -> DataFrame | None:
    """The buckets of a committed version (all, or ``only`` some)."""
    paths = [os.path.join(target, "data", folder, f"{BUCKET}={bucket}")
             for bucket, folder in sorted(commit["folders"].items()) if only is None or bucket in only]
    if not paths:
        return None
    return spark.read.schema(StructType.fromJson(json.loads(commit["table_schema"]))).parquet(*paths)


def latest(spark: SparkSession, target: str) -> DataFrame | None:
    """The newest committed version of the target; none if there is no commit."""
    commit = _last_commit(spark, target)
    return None if commit is None else _read(spark, target, commit)


def unreferenced(spark: SparkSession, target: str, keep: int = 2) -> list[str]:
    """Committed data folders that none of the last ``keep`` versions reads.

    The target's owner removes them once no reader holds an older version.  A folder
    that no commit names is a batch that failed, or one being written."""
    commits = _commits(spark, target)
    if commits is None:
        return []
    named = commits.select("version", F.explode(F.map_values("folders")).alias("folder"))
    last = commits.agg(F.max("version")).first()[0]
    rows = named.groupBy("folder").agg(F.max("version").alias("v")).filter(F.col("v") <= last - keep).collect()
    return sorted(os.path.join(target, "data", r["folder"]) for r in rows)


def _bucket_of(keys, buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark gave the stream when its checkpoint was made."""
    return spark.read.schema("id string").json(os.path.join(checkpoint, "metadata")).first()["id"]


def keyed_merge(target: str, checkpoint: str, keys, order, transform=None, buckets: int = BUCKETS):
    """``foreachBatch`` function: merge a batch into the keyed target.

    ``transform`` (DataFrame -> DataFrame) cleans each batch first."""
    keys = list(keys)

    def merge(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        stream = _stream_id(spark, checkpoint)
        commits = _commits(spark, target)
        if commits is not None and not commits.filter(
                (F.col("stream") == stream) & (F.col("batch_id") == batch_id)).isEmpty():
            return
        commit = _last_commit(spark, target)
        count = buckets if commit is None else commit["buckets"]
        rows = (batch if transform is None else transform(batch)).persist()
        touched = {r[0] for r in rows.select(_bucket_of(keys, count)).distinct().collect()}
        if touched:
            current = None if commit is None else _read(spark, target, commit, touched)
            if current is not None:
                current = current.unionByName(rows, allowMissingColumns=True)
            merged = keep_one(rows if current is None else current, keys, order)
            version = 1 if commit is None else commit["version"] + 1
            folder = f"v{version:08d}-{uuid.uuid4().hex[:12]}"
            (merged.withColumn(BUCKET, _bucket_of(keys, count)).hint("rebalance", F.col(BUCKET))
                   .write.partitionBy(BUCKET).parquet(os.path.join(target, "data", folder)))
            folders = ({} if commit is None else commit["folders"]) | dict.fromkeys(touched, folder)
            record = [(version, stream, batch_id, count, merged.schema.json(), folders)]
            (spark.createDataFrame(record, COMMIT_SCHEMA).coalesce(1)
                  .write.mode("append").parquet(os.path.join(target, "commits", f"v{version:08d}")))
        rows.unpersist()

    return merge


def ingest_available(spark: SparkSession, source: str, target: str, checkpoint: str,
                     schema: StructType, keys, order, fmt: str = "json",
                     max_files_per_trigger: int | None = None, transform=None,
                     options: dict | None = None, with_file_path: bool = False,
                     buckets: int = BUCKETS) -> DataFrame | None:
    """Process every snapshot file not yet seen, merge, and return the target.

    ``with_file_path`` adds the source file's path as ``_file_path`` (for
    tags such as the snapshot date) before ``transform`` runs."""
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    stream = reader.load(source)
    if with_file_path:
        stream = stream.withColumn("_file_path", F.col("_metadata.file_path"))
    q = (stream.writeStream.foreachBatch(keyed_merge(target, checkpoint, keys, order, transform, buckets))
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return latest(spark, target)
