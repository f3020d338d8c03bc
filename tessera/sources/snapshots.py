"""Dated snapshot ingestion: schema inference, unification, one scan.

Snapshots are JSON files whose *path* carries a date ``YYYY_MM_DD``.  All of
them are read by ONE multi-file scan with one unified schema, tagged with
the year and the snapshot date parsed from the file path (so "latest
snapshot wins" needs no per-file loop).
"""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    DataType,
    DecimalType,
    DoubleType,
    LongType,
    NullType,
    StringType,
    StructField,
    StructType,
)

from tessera.sources.files import CORRUPT_COLUMN, file_path, read_json

# greedy prefix: the date closest to the file name wins
DATE_PATTERN = r".*(\d{4})_(\d{2})_(\d{2})"


class NoSnapshots(FileNotFoundError):
    """No snapshot file matched: nothing to ingest (no output is written)."""


def _merge_field(a: StructField, b: StructField) -> StructField:
    if isinstance(a.dataType, StructType) and isinstance(b.dataType, StructType):
        return StructField(a.name, unify_schemas([a.dataType, b.dataType], "merge"),
                           a.nullable or b.nullable)
    return a


def unify_schemas(schemas, policy: str = "merge") -> StructType:
    """Union of fields by name, in first-seen order.

    * ``first``: the first definition of a name wins as a whole (nested
      fields seen only later are lost — parity with the reference).
    * ``merge``: struct fields are merged recursively so optional nested
      fields survive; for other type clashes the first type wins.
    Empty schemas (an empty ``[]`` snapshot infers ``struct<>``) add nothing.
    """
    if policy not in ("first", "merge"):
        raise ValueError(f"unknown policy {policy!r}")
    fields: dict[str, StructField] = {}
    for s in schemas:
        for f in s.fields:
            if f.name not in fields:
                fields[f.name] = f
            elif policy == "merge":
                fields[f.name] = _merge_field(fields[f.name], f)
    return StructType(list(fields.values()))


def snapshot_files(spark: SparkSession, paths, glob: str | None = None,
                   recursive: bool = False) -> list[str]:
    """The snapshot files under ``paths``, oldest ``YYYY_MM_DD`` first (a
    file listing only; no data is read)."""
    r = spark.read.format("text")
    if glob:
        r = r.option("pathGlobFilter", glob)
    if recursive:
        r = r.option("recursiveFileLookup", "true")
    files = r.load(paths).inputFiles()
    date = re.compile(DATE_PATTERN)

    def key(f):
        m = date.match(f)
        return (m.groups() if m else ("9999", "99", "99"), f)

    return sorted(files, key=key)


def _joined(a: DataType, b: DataType) -> DataType:
    """The type of a field that has both types in one file, by the rules of JSON inference."""
    if a == b or isinstance(b, NullType):
        return a
    if isinstance(a, NullType):
        return b
    if isinstance(a, StructType) and isinstance(b, StructType):
        fields = {f.name: f.dataType for f in a.fields}
        for f in b.fields:
            fields[f.name] = _joined(fields[f.name], f.dataType) if f.name in fields else f.dataType
        return StructType([StructField(n, fields[n]) for n in sorted(fields)])
    if isinstance(a, ArrayType) and isinstance(b, ArrayType):
        return ArrayType(_joined(a.elementType, b.elementType))
    numbers = (LongType, DoubleType, DecimalType)
    if isinstance(a, numbers) and isinstance(b, numbers):
        if DoubleType() in (a, b):
            return DoubleType()
        return DecimalType(max(t.precision if isinstance(t, DecimalType) else 20 for t in (a, b)), 0)
    return StringType()


def _settled(t: DataType) -> DataType | None:
    """What JSON inference makes of a type in the end: no value is a string, an object that
    never has a field is no field."""
    if isinstance(t, StructType):
        fields = [StructField(f.name, s) for f in t.fields if (s := _settled(f.dataType)) is not None]
        return StructType(fields) if fields else None
    if isinstance(t, ArrayType):
        inner = _settled(t.elementType)
        return None if inner is None else ArrayType(inner)
    return StringType() if t.typeName() in ("void", "variant") else t


def _variant_type(text: str) -> DataType:
    """The type that ``schema_of_variant`` names (names in backticks are left alone)."""
    parts = text.split("`")
    return DataType.fromDDL("`".join(p if i % 2 else p.replace("OBJECT<", "STRUCT<") for i, p in enumerate(parts)))


#: a variant keeps a number with a point as a decimal; JSON inference calls it a double
_POINT_NUMBERS = [r"DECIMAL\((1[0-8]|[1-9]),\d+\)", r"DECIMAL\(\d+,[1-9]\d*\)"]


def first_schema(spark: SparkSession, paths, glob: str | None = None, recursive: bool = False,
                 multi_line: bool = False) -> StructType:
    """First-wins schema of snapshot files, oldest date first, from one job for any number of them.

    Every record is parsed as a variant; (field, its type) is aggregated with the oldest file
    that has it, and only these pairs reach the driver, as many as fields have different
    types.  A field's definition is that of the first file with it, as if each file's schema
    had been inferred by itself: fields of one file by name, types that meet in one file
    joined by the rules of JSON inference (an array of both whole and pointed numbers is taken
    for large integers if all its pointed ones end in .0).  Lines that are not JSON, and
    values that are not objects, have no fields."""
    r = spark.read.format("text")
    for option, value in (("pathGlobFilter", glob), ("recursiveFileLookup", "true" if recursive else None),
                          ("wholetext", "true" if multi_line else None)):
        if value:
            r = r.option(option, value)
    lines = r.load(paths).select(F.try_parse_json("value").alias("v"), file_path().alias("path"))
    one = F.expr("explode(coalesce(try_variant_get(v, '$', 'array<variant>'), array(v)))")
    records = lines.select("path", one.alias("r"))
    fields = records.select("path", F.expr("explode(try_cast(r as map<string, variant>))").alias("name", "value"))
    kind = F.schema_of_variant("value")
    for pattern in _POINT_NUMBERS:
        kind = F.regexp_replace(kind, pattern, "DOUBLE")
    date = F.concat(*[F.regexp_extract("path", DATE_PATTERN, i) for i in (1, 2, 3)])
    age = F.struct(F.when(date == "", "99999999").otherwise(date).alias("date"), "path")
    found = fields.select("name", kind.alias("kind"), age.alias("age")).groupBy("name", "kind").agg(F.min("age").alias("age")).collect()
    first = {}
    for name, kind, age in found:
        first[name] = min(first.get(name, age), age)
    types = {}
    for name, kind, age in sorted(found):
        if age == first[name]:
            t = _variant_type(kind)
            types[name] = _joined(types[name], t) if name in types else t
    settled = [(first[n], n, s) for n, t in types.items() if (s := _settled(t)) is not None]
    return StructType([StructField(n, t) for _, n, t in sorted(settled, key=lambda x: x[:2])])


def infer_schema(spark: SparkSession, paths, policy: str = "merge", glob: str | None = None,
                 recursive: bool = False, sampling_ratio: float | None = None,
                 per_file: bool = False, multi_line: bool = False) -> StructType:
    """``merge``: one inference job over all paths (Spark merges nested
    structs).  ``first``: one job per path, unified first-wins, each path a group of files;
    with ``per_file`` every file is its own group, in date order: one job for all of them, see
    ``first_schema``."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    if policy == "merge":
        return read_json(spark, paths, glob=glob, recursive=recursive, multi_line=multi_line,
                         sampling_ratio=sampling_ratio).schema
    if per_file:
        return first_schema(spark, paths, glob, recursive, multi_line)
    schemas = [read_json(spark, p, glob=glob, recursive=recursive, multi_line=multi_line,
                         sampling_ratio=sampling_ratio).schema for p in paths]
    return unify_schemas(schemas, "first")


def read_snapshots(spark: SparkSession, paths, schema: StructType | None = None,
                   policy: str = "merge", glob: str = "*.json", recursive: bool = True,
                   years=None, corrupt: bool = True, sampling_ratio: float | None = None,
                   year_col: str = "year", date_col: str | None = "snapshot_date",
                   multi_line: bool = False) -> DataFrame:
    """All snapshot files below ``paths`` in one scan.

    Adds ``year`` (INT) and ``snapshot_date`` (DATE) parsed from each file's
    path; files without a ``YYYY_MM_DD`` in their path get nulls.
    ``multi_line`` reads each file as one JSON value (pretty-printed arrays);
    by default a file holds JSON lines or one-line arrays.  ``years``
    keeps only snapshots of those years (pruned per file via the metadata
    column).  ``corrupt`` keeps malformed lines in ``_corrupt_record``."""
    if schema is None:
        try:
            schema = infer_schema(spark, paths, policy, glob, recursive, sampling_ratio,
                                  multi_line=multi_line)
        except AnalysisException as e:  # no file matched, or the folder is missing
            raise NoSnapshots(f"no snapshot files under {paths} matching {glob}") from e
        schema = StructType([f for f in schema.fields if f.name != CORRUPT_COLUMN])
    df = read_json(spark, paths, schema=schema, glob=glob, recursive=recursive,
                   multi_line=multi_line, corrupt_column=CORRUPT_COLUMN if corrupt else None)
    y = F.regexp_extract(file_path(), DATE_PATTERN, 1)
    df = df.withColumn(year_col, F.when(y == "", None).otherwise(y).cast("int"))
    if date_col:
        d = F.concat_ws("-", *[F.regexp_extract(file_path(), DATE_PATTERN, i) for i in (1, 2, 3)])
        df = df.withColumn(date_col, F.when(y == "", None).otherwise(F.to_date(d)))
    if years is not None:
        df = df.filter(F.col(year_col).isin(list(years)))
    return df
