"""Writers: JSON / Parquet / CSV overwrite, partitioned tables, keyed
document collections.  All are distributed writes — nothing is collected."""

from tessera.sinks.versioned import ConcurrentCommit, NoTable, VersionedTable
from tessera.sinks.writers import (
    DuplicateKey,
    write_collection,
    write_csv,
    write_json,
    write_parquet,
    write_partitioned,
)

__all__ = ["ConcurrentCommit", "DuplicateKey", "NoTable", "VersionedTable", "write_collection", "write_csv", "write_json",
           "write_parquet", "write_partitioned"]
