"""tessera: Spark-first toolkit for zoned property-market style data.

Sources (snapshots, keyed JSON objects, CSV, record pages), cleaning and
canonicalisation, keyed dedup, enrichment joins, partitioned storage,
indicator encoding, imputation, correlation-based selection and hold-out
model search — all expressed with the public DataFrame / SQL / ML /
Structured Streaming APIs.
"""

from tessera.session import get_session, scratch_path

__all__ = ["get_session", "scratch_path"]
