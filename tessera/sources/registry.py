"""Source registry: name -> how to read it.

A small config mapping (the analogue of a sources metadata file).  Each
entry names a format, a location (path or glob) and optional schema /
options; ``read_source`` turns it into a lazy DataFrame.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


@dataclass(frozen=True)
class SourceSpec:
    name: str
    fmt: str
    path: str
    schema: StructType | str | None = None
    options: dict = field(default_factory=dict)
    year_from_file: bool = False


class SourceRegistry:
    def __init__(self, specs=()):
        self._specs: dict[str, SourceSpec] = {}
        for s in specs:
            self.register(s)

    def register(self, spec: SourceSpec) -> None:
        self._specs[spec.name] = spec

    def names(self) -> list[str]:
        return list(self._specs)

    def spec(self, name: str) -> SourceSpec:
        return self._specs[name]

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        return read_source(spark, self._specs[name])

    @classmethod
    def from_dict(cls, config: dict) -> "SourceRegistry":
        """``{name: {"fmt": ..., "path": ..., "options": {...}}}``"""
        return cls(SourceSpec(name=k, **v) for k, v in config.items())

    @classmethod
    def from_file(cls, path: str) -> "SourceRegistry":
        """Load the same mapping from a small JSON config file (driver-side
        configuration, not data)."""
        import json

        with open(path, encoding="utf-8") as f:
            return cls.from_dict(json.load(f))


def read_source(spark: SparkSession, spec: SourceSpec) -> DataFrame:
    r = spark.read.format(spec.fmt)
    if spec.schema is not None:
        r = r.schema(spec.schema)
    for k, v in spec.options.items():
        r = r.option(k, v)
    df = r.load(spec.path)
    if spec.year_from_file:
        from tessera.functions.scalars import year_from_name
        df = df.withColumn("year", year_from_name(F.col("_metadata.file_name")))
    return df


def source_counts(spark: SparkSession, registry: SourceRegistry, names=None) -> DataFrame:
    """``(source, n_rows)`` for the registered sources, as one job."""
    names = names or registry.names()
    frames = [registry.read(spark, n).agg(F.count(F.lit(1)).alias("n_rows"))
              .select(F.lit(n).alias("source"), "n_rows") for n in names]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out
