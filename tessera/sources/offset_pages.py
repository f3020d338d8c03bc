"""Pages of an offset-paged API, one stored response a file: ``{"result": {"records": [...]}}``.

A client asks for offset 0, then for the number of records it has, until a page has none.
The stored pages are read the same way: the chain of offsets ends at the first page without
records, whatever lies behind it, and a missing or repeated page on the way is an error."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.joins import materialise

OFFSET_PATTERN = r"offset=(\d+)"
EXTRA = "_extra"


class BrokenPages(ValueError):
    """A page is missing, repeated, or not a page."""


def page_chain(pages: DataFrame) -> DataFrame:
    """``pages`` (offset, n: its records, null if it is not a page) up to the end of the
    chain; raises ``BrokenPages`` where the chain is broken.

    No row is compared with its neighbour in a sorted list: every offset but 0 has to be
    where another page ends, and every page's end another offset, which are two joins."""
    end = pages.where("n = 0").agg(F.min("offset")).first()[0]
    if end is None:
        raise BrokenPages("no page without records: the end is missing")
    chain = pages.where(F.col("offset") <= end)
    bad = chain.where("n is null").first()
    if bad:
        raise BrokenPages(f"the page at offset {bad['offset']} is malformed")
    twice = chain.groupBy("offset").agg(F.count(F.lit(1)).alias("times")).where("times > 1").first()
    if twice:
        raise BrokenPages(f"offset {twice['offset']} is stored {twice['times']} times")
    starts = chain.select("offset").where("offset > 0")
    ends = chain.where("n > 0").select((F.col("offset") + F.col("n")).alias("offset"))
    for one, other, what in ((ends, starts, "no page at"), (starts, ends, "no page ends at")):
        gap = one.join(other, "offset", "left_anti").first()
        if gap:
            raise BrokenPages(f"{what} offset {gap['offset']}")
    if end > 0 and chain.where("offset = 0").isEmpty():
        raise BrokenPages("no page at offset 0")
    return chain.where("n > 0")


def read_offset_pages(spark: SparkSession, path, pattern: str = OFFSET_PATTERN, glob: str | None = None,
                      recursive: bool = True) -> DataFrame:
    """Records of all pages up to the first one without records, as strings.

    ``pattern`` finds a page's offset in its path.  Columns are the fields of the first
    record, in its order; what other records have besides is kept in ``_extra`` (a JSON
    object, null if nothing), and a field that a record lacks is null.  The pages' sizes
    are found first, in one job; the files behind the end are then not opened again."""
    r = spark.read.format("text").option("wholetext", "true")
    if glob:
        r = r.option("pathGlobFilter", glob)
    if recursive:
        r = r.option("recursiveFileLookup", "true")
    offset = F.regexp_extract(F.col("_metadata.file_path"), pattern, 1)
    files = r.load(path).where(offset != "").select(offset.cast("long").alias("offset"), "value")
    found = F.expr("try_variant_get(try_parse_json(value), '$.result.records', 'array<variant>')")
    sizes = materialise(files.select("offset", F.when(found.isNotNull(), F.size(found)).cast("long").alias("n")), "page-sizes")
    chain = page_chain(sizes)
    last = chain.agg(F.max("offset")).first()[0]
    if last is None:
        return spark.createDataFrame([], f"{EXTRA} string")
    first = files.where(F.col("offset") == 0).select(F.get_json_object("value", "$.result.records[0]").alias("r"))
    header = first.select(F.json_object_keys("r")).first()[0]      # one record's field names
    records = files.where(F.col("offset") <= last).select(F.explode(found).alias("r"))
    fields = records.select("r", F.expr("try_cast(r as map<string, variant>)").alias("m"))
    text = F.expr("transform_values(m, (k, v) -> cast(v as string))")
    more = F.map_filter("m", lambda k, v: ~k.isin(*header))
    columns = [F.try_element_at(text, F.lit(c)).alias(c) for c in header]
    return fields.select(*columns, F.when(F.size(more) > 0, F.to_json(more)).alias(EXTRA))


def write_offset_pages(df: DataFrame, path: str, offset: str = "offset") -> str:
    """One page a value of ``offset`` (a folder ``offset=...``), its records the other columns;
    null fields are left out.  Each page must be a bounded group."""
    fields = [F.col(c) for c in df.columns if c != offset]
    records = F.array_sort(F.collect_list(F.struct(*fields)))
    pages = df.groupBy(offset).agg(F.to_json(F.struct(F.struct(records.alias("records")).alias("result"))).alias("value"))
    pages.repartition(offset).write.mode("append").partitionBy(offset).text(path)
    return path
