"""Plain file scans (JSON, CSV, Parquet, partitioned tables) and file tags.

Every reader takes a path or glob and returns a lazy DataFrame; with an
explicit schema nothing is read until an action, and Parquet scans get
filter pushdown and column pruning from Catalyst.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from tessera.functions.scalars import year_from_name

CORRUPT_COLUMN = "_corrupt_record"


def _reader(spark: SparkSession, schema=None, glob: str | None = None,
            recursive: bool = False, **options):
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if recursive:
        r = r.option("recursiveFileLookup", "true")
    for k, v in options.items():
        if v is not None:
            r = r.option(k, v)
    return r


def with_corrupt_column(schema: StructType, column: str = CORRUPT_COLUMN) -> StructType:
    if column in schema.fieldNames():
        return schema
    return StructType(list(schema.fields)).add(column, StringType(), True)


def read_json(spark: SparkSession, path, schema: StructType | None = None,
              glob: str | None = None, recursive: bool = False, multi_line: bool = False,
              corrupt_column: str | None = None, sampling_ratio: float | None = None) -> DataFrame:
    """JSON (lines, or whole-file values with ``multi_line``).  A line holding
    a JSON array yields one row per element; ``[]`` yields none.  With
    ``corrupt_column`` the read is PERMISSIVE and malformed lines land there."""
    if corrupt_column and schema is not None:
        schema = with_corrupt_column(schema, corrupt_column)
    r = _reader(spark, schema, glob, recursive, multiLine=str(multi_line).lower(),
                mode="PERMISSIVE" if corrupt_column else None,
                columnNameOfCorruptRecord=corrupt_column, samplingRatio=sampling_ratio)
    return r.json(path)


#: read and written values agree: nothing is trimmed, a quote doubles, null is bare and empty is quoted
CSV_VALUES = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false", "escape": '"',
              "nullValue": "\\N", "emptyValue": ""}


def read_csv(spark: SparkSession, path, schema: StructType | None = None,
             header: bool = True, infer: bool = False, glob: str | None = None,
             recursive: bool = False, check_header: bool = False) -> DataFrame:
    """CSV with header.  Prefer one explicit schema for a set of files: per
    file inference can disagree between files.

    An explicit schema is applied by position; ``check_header`` makes every
    file's header be checked against the schema's names, so a file with
    its columns in another order fails instead of loading into the wrong
    columns.  Values come back as ``write_csv`` wrote them: spaces, line
    ends and quotes kept, the empty string told from null."""
    r = _reader(spark, schema, glob, recursive, header=str(header).lower(), **CSV_VALUES, multiLine="true",
                inferSchema=str(infer and schema is None).lower(),
                enforceSchema="false" if (check_header and schema is not None) else None)
    return r.csv(path)


def read_parquet(spark: SparkSession, path, columns=None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def read_partitioned(spark: SparkSession, path, fmt: str = "parquet") -> DataFrame:
    """Hive-style partitioned table; partition columns are inferred from the
    folder names and pruned by filters on them."""
    return spark.read.format(fmt).load(path)


def file_name() -> Column:
    return F.col("_metadata.file_name")


def file_path() -> Column:
    return F.col("_metadata.file_path")


def with_file_year(df: DataFrame, name: str = "year", pattern: str = r"\d{4}",
                   from_path: bool = False) -> DataFrame:
    """Tag rows with the first 4-digit run of their source file's name."""
    src = file_path() if from_path else file_name()
    return df.withColumn(name, year_from_name(src, pattern))
