"""Keyed-object JSON: a file holding ``{key: {metric: value, ...}, ...}``.

Each file is one JSON value (it cannot be split), so it is read whole as
text by one task, parsed with ``from_json`` into a map and exploded into one
row per key — on the executors, never through the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, StringType, StructType

from tessera.functions.scalars import year_from_name


def read_keyed_objects(spark: SparkSession, path, value_schema: StructType,
                       key_col: str = "key", glob: str | None = "*.json",
                       recursive: bool = False, year_col: str | None = None) -> DataFrame:
    """One row per (file, key): ``key_col`` then the value struct's fields.

    ``year_col`` adds the first 4-digit run of the file name as INT.  A
    malformed file fails the read instead of vanishing."""
    r = spark.read.option("wholetext", "true")
    if glob:
        r = r.option("pathGlobFilter", glob)
    if recursive:
        r = r.option("recursiveFileLookup", "true")
    # format("text").load: DataFrameReader.text() would reset wholetext to False
    text = r.format("text").load(path)
    cols = [F.from_json("value", MapType(StringType(), value_schema), {"mode": "FAILFAST"}).alias("m")]
    if year_col:
        cols.append(year_from_name(F.col("_metadata.file_name")).alias(year_col))
    parsed = text.select(*cols)
    rest = [year_col] if year_col else []
    exploded = parsed.select(F.explode("m").alias(key_col, "v"), *rest)
    return exploded.select(key_col, "v.*", *rest)


def write_keyed_objects(df: DataFrame, path: str, key_col: str, value_cols,
                        file_cols) -> None:
    """Write one keyed JSON object per group of ``file_cols`` (one file per
    group).  Each object holds one group's keys, so groups must be of a
    file's size."""
    file_cols = [file_cols] if isinstance(file_cols, str) else list(file_cols)
    entry = F.struct(F.col(key_col), F.struct(*[F.col(c) for c in value_cols]))
    objs = (df.groupBy(*file_cols)
              .agg(F.to_json(F.map_from_entries(F.collect_list(entry))).alias("value")))
    objs.repartition(*file_cols).write.mode("overwrite").partitionBy(*file_cols).text(path)
