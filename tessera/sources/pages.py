"""Stored pages of an API response: ``{"result": {"records": [...]}}``.

Pages are JSON lines (one page per line, any number of files); one scan
reads them all, ``explode`` turns records into rows, and empty pages (the
end-of-stream marker of offset paging) simply yield no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType


def page_schema(record_schema: StructType) -> StructType:
    return StructType().add("result", StructType().add("records", ArrayType(record_schema)))


def read_record_pages(spark: SparkSession, path, record_schema: StructType,
                      glob: str | None = None, multi_line: bool = False) -> DataFrame:
    """Records of every stored page.  Pages are JSON lines by default;
    ``multi_line`` reads each file as one (possibly pretty-printed) page, as
    an API response saved verbatim.  A malformed page or a value of another
    type fails the read instead of dropping records."""
    r = spark.read.schema(page_schema(record_schema)).option("mode", "FAILFAST")
    if multi_line:
        r = r.option("multiLine", "true")
    if glob:
        r = r.option("pathGlobFilter", glob)
    pages = r.json(path)
    return pages.select(F.explode("result.records").alias("r")).select("r.*")


def write_record_pages(df: DataFrame, path: str, page_key, empty_pages: int = 1) -> None:
    """Group rows into pages by ``page_key`` (names or Columns; each page must
    be a bounded group) and write one page per JSON line, records sorted,
    plus ``empty_pages`` empty pages."""
    page_key = [page_key] if isinstance(page_key, str) else list(page_key)
    records = F.array_sort(F.collect_list(F.struct(*[F.col(c) for c in df.columns])))
    pages = df.groupBy(*page_key).agg(
        F.to_json(F.struct(F.struct(records.alias("records")).alias("result"))).alias("value"))
    pages.select("value").write.mode("overwrite").text(path)
    if empty_pages:
        spark = df.sparkSession
        empty = '{"result": {"records": []}}'
        spark.range(empty_pages).select(F.lit(empty).alias("value")) \
            .write.mode("append").text(path)
