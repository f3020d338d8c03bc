"""Readers: snapshots, keyed objects, record pages, CSV/JSON/Parquet, registry."""

from tessera.sources.files import (
    CORRUPT_COLUMN,
    read_csv,
    read_json,
    read_parquet,
    read_partitioned,
    with_file_year,
)
from tessera.sources.keyed_json import read_keyed_objects, write_keyed_objects
from tessera.sources.offset_pages import BrokenPages, read_offset_pages, write_offset_pages
from tessera.sources.pages import read_record_pages, write_record_pages
from tessera.sources.registry import SourceRegistry, SourceSpec, read_source, source_counts
from tessera.sources.snapshots import NoSnapshots, first_schema, infer_schema, read_snapshots, unify_schemas

__all__ = [
    "BrokenPages", "CORRUPT_COLUMN", "first_schema", "read_offset_pages", "write_offset_pages", "NoSnapshots", "SourceRegistry", "SourceSpec", "infer_schema", "read_csv",
    "read_json", "read_keyed_objects", "read_parquet", "read_partitioned",
    "read_record_pages", "read_snapshots", "read_source", "source_counts",
    "unify_schemas", "with_file_year", "write_keyed_objects", "write_record_pages",
]
