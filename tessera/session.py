"""Session construction and shared scratch locations.

Intermediate tables (round trips, materialised small sides, streaming
checkpoints, model artefacts) go under the cluster's shared
``spark.checkpoint.dir``.  Only when a session has none (local tests) do we
pick a fresh local folder and register it as the checkpoint dir.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def cluster_conf(input_bytes: int, executors: int, cores_per_executor: int,
                 partition_bytes: int | None = None, shuffle_fraction: float = 0.25) -> dict:
    """Spill-aware sizing for a run over ``input_bytes`` of input.

    Scan splits and post-shuffle partitions target ``partition_bytes``:
    by default enough splits for 3 waves of all cores, capped at 128 MiB
    (well inside one core's share of executor memory) and at least 4 MiB.
    The initial shuffle partition count covers the expected shuffled bytes
    (``shuffle_fraction`` of the input, after pruning and partial
    aggregation) at that size, clamped to 3-10 waves of all cores so map
    output metadata stays bounded.  AQE then coalesces small partitions and
    splits skewed ones (5x the median and over 4x the target size)."""
    cores = max(1, executors * cores_per_executor)
    if partition_bytes is None:
        partition_bytes = min(128 << 20, max(4 << 20, input_bytes // (3 * cores)))
    wanted = -(-int(input_bytes * shuffle_fraction) // partition_bytes)
    parts = min(max(3 * cores, wanted), 10 * cores)
    return {
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": str(partition_bytes // 8),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * partition_bytes),
        "spark.default.parallelism": str(3 * cores),
    }


def get_session(master: str | None = None, app_name: str = "tessera",
                shuffle_partitions: int | None = None,
                extra_conf: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with AQE, ANSI and UTC on.

    ``master`` is only set when given, so a cluster submit keeps its own.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


class NoSharedFolder(RuntimeError):
    pass


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of this session.

    Taken from the session (``setCheckpointDir`` or ``spark.checkpoint.dir``).
    Only a local-mode session without one (tests, a single machine) gets a
    fresh local folder; on a cluster a machine-local folder would be
    invisible to the executors, so that is an error instead."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if sc.master.startswith("local-cluster") or not sc.master.startswith("local"):
            raise NoSharedFolder("set spark.checkpoint.dir to a folder shared by all executors")
        conf_dir = tempfile.mkdtemp(prefix="tessera-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared checkpoint dir."""
    base = checkpoint_dir(spark)
    return os.path.join(base, "tables", f"{name}-{uuid.uuid4().hex[:12]}")


def read_table(spark: SparkSession, sf_dir: str, name: str):
    """Driver tables are one Parquet file-set each."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
