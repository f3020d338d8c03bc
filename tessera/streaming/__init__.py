"""Structured Streaming: incremental snapshot ingest with keyed merge."""

from tessera.streaming.ingest import ingest_available, keyed_merge, latest, unreferenced

__all__ = ["ingest_available", "keyed_merge", "latest", "unreferenced"]
