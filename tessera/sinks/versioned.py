"""A partitioned table with versions: readers see one version, writers commit or leave no trace.

Data files go to a folder of their own that never changes again.  A version is one small
commit file (JSON) that names, for every partition value, the folder that holds it; it is
written after the data and only if no other writer took its number (an exclusive create).
* A failed overwrite leaves files that no version names.
* A reader keeps the version it was opened at while later ones are committed.
* Single partitions are replaced by naming another folder for them; the others keep theirs.
* Of two writers that began at one version, the second to commit is refused, or, if both
  replaced different partitions, put on top.

Exclusive creates and renames are atomic on HDFS and local disks; on an object store without
them one writer at a time must write a table.  A commit file has one entry a partition value."""

from __future__ import annotations

import json
import os
import uuid
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

COMMIT_ATTEMPTS = 20


class ConcurrentCommit(RuntimeError):
    """Another writer committed what this one would overwrite."""


class NoTable(FileNotFoundError):
    pass


class VersionedTable:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    # ------------------------------------------------------------ versions

    def _fs(self, path: str):
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return hadoop.getFileSystem(self.spark._jsc.hadoopConfiguration()), hadoop

    def versions(self) -> list[int]:
        """Numbers of all committed versions, oldest first (a listing)."""
        fs, folder = self._fs(os.path.join(self.root, "commits"))
        if not fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(folder)]
        return sorted(int(n[1:-5]) for n in names if n.startswith("v") and n.endswith(".json"))

    def latest(self) -> int:
        """The newest version, 0 if there is none."""
        return max(self.versions(), default=0)

    def _path(self, version: int) -> str:
        return os.path.join(self.root, "commits", f"v{version:012d}.json")

    def commit(self, version: int | None = None) -> dict:
        """The record of a version (default: the newest)."""
        version = self.latest() if version is None else version
        if not version:
            raise NoTable(f"no version at {self.root}")
        row = self.spark.read.option("wholetext", "true").format("text").load(self._path(version)).first()
        return json.loads(row[0])

    def _publish(self, record: dict) -> bool:
        """Make a commit file; false if its number is taken.

        The whole record is written aside first; the number is claimed by an exclusive
        create, and the record renamed to it, so no reader meets half a record."""
        fs, name = self._fs(self._path(record["version"]))
        _, claim = self._fs(self._path(record["version"]) + ".claim")
        _, own = self._fs(os.path.join(self.root, "commits", f"_{uuid.uuid4().hex}"))
        out = fs.create(own, True)
        out.write(bytearray(json.dumps(record).encode()))
        out.close()
        try:
            fs.create(claim, False).close()
        except Py4JJavaError:
            fs.delete(own, False)
            if fs.exists(claim) or fs.exists(name):
                return False
            raise
        done = not fs.exists(name) and fs.rename(own, name)
        fs.delete(own, False)
        fs.delete(claim, False)
        return bool(done)

    def release(self, version: int) -> None:
        """Free a number whose writer died while it claimed it (and is known to be gone)."""
        fs, claim = self._fs(self._path(version) + ".claim")
        fs.delete(claim, False)

    # ------------------------------------------------------------ reading

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of one version (default: the newest at the time of the call).

        One scan for every data folder the version still uses, over the partitions it uses
        of it; filters on partition columns prune them as in any partitioned table."""
        record = self.commit(version)
        schema = StructType.fromJson(record["schema"])
        folders: dict[str, list] = {}
        for partition, folder in sorted(record["partitions"].items()):
            folders.setdefault(folder, []).append(partition)
        out = self.spark.createDataFrame([], schema)
        for i, (folder, partitions) in enumerate(sorted(folders.items())):
            base = os.path.join(self.root, "data", folder)
            scan = self.spark.read.schema(schema).option("basePath", base) \
                .parquet(*[os.path.join(base, p) for p in partitions]).select(*schema.names)
            out = scan if i == 0 else out.unionByName(scan)
        return out

    # ------------------------------------------------------------ writing

    def _stage(self, df: DataFrame, partition_by: list) -> tuple[str, list]:
        """Write the rows to a new folder: (folder, its partitions as relative paths)."""
        folder = uuid.uuid4().hex
        base = os.path.join(self.root, "data", folder)
        df.hint("rebalance", *partition_by).write.partitionBy(*partition_by).parquet(base)
        depth = len(partition_by)
        try:
            files = self.spark.read.schema("none string").option("recursiveFileLookup", "true").parquet(base)
        except AnalysisException:
            return folder, []
        part = F.slice(F.split("_metadata.file_path", "/"), -depth - 1, depth)
        rows = files.select(F.concat_ws("/", part).alias("p")).distinct().collect()        # one row a partition value
        return folder, [unquote(r.p) for r in rows]

    def overwrite(self, df: DataFrame, partition_by, base: int | None = None) -> int:
        """Replace the whole table; returns the new version.  ``base`` is the version the rows
        were made from (default: the newest now): if another writer commits after it,
        ``ConcurrentCommit`` is raised and the table stays as that writer left it."""
        partition_by = [partition_by] if isinstance(partition_by, str) else list(partition_by)
        base = self.latest() if base is None else base
        folder, partitions = self._stage(df, partition_by)
        record = {"version": base + 1, "partition_by": partition_by, "schema": df.schema.jsonValue(),
                  "partitions": {p: folder for p in partitions}}
        if self.latest() != base or not self._publish(record):
            raise ConcurrentCommit(f"version {base + 1} of {self.root} was committed by another writer")
        return base + 1

    def replace_partitions(self, df: DataFrame, base: int | None = None) -> int:
        """Replace the partitions that ``df`` has rows of, keep all others; returns the new
        version.  Commits of other writers to other partitions meanwhile are kept."""
        base = self.latest() if base is None else base
        start = self.commit(base)
        schema = StructType.fromJson(start["schema"])
        names = {f.name: f.dataType for f in schema.fields}
        if {f.name: f.dataType for f in df.schema.fields} != names:
            raise ValueError(f"the columns differ from the table's: {schema.simpleString()}")
        folder, partitions = self._stage(df.select(*schema.names), start["partition_by"])
        for _ in range(COMMIT_ATTEMPTS):
            at = self.latest()
            now = start if at == base else self.commit(at)
            moved = {p for p in partitions if now["partitions"].get(p) != start["partitions"].get(p)}
            if moved or now["schema"] != start["schema"] or now["partition_by"] != start["partition_by"]:
                raise ConcurrentCommit(f"another writer replaced {sorted(moved) or 'the table'} of {self.root}")
            record = {**now, "version": at + 1, "partitions": {**now["partitions"], **{p: folder for p in partitions}}}
            if self._publish(record):
                return at + 1
        raise ConcurrentCommit(f"{COMMIT_ATTEMPTS} commits to {self.root} were all taken by other writers")

    def unreferenced(self, keep: int = 1) -> list[str]:
        """Data folders that none of the newest ``keep`` versions names: their owner may
        remove them once no reader of an older version and no writer is at work."""
        fs, data = self._fs(os.path.join(self.root, "data"))
        used = {f for v in self.versions()[-keep:] for f in self.commit(v)["partitions"].values()}
        return sorted({s.getPath().getName() for s in fs.listStatus(data)} - used) if fs.exists(data) else []
