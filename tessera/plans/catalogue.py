"""Query catalogue: one query per operator, on the driver tables.

The driver tables stand in for the reference's sources: ``orders`` /
``lineitem`` play the listings, ``customer`` / ``supplier`` / ``part`` /
``nation`` the dimensions, ``events`` the daily snapshots, and
``conversations`` the stored API pages.  Every query reads whole tables
(or data Spark derives from them) through the package's operators; round
trips write into a fresh folder below the shared checkpoint dir.

Each function takes ``(spark, sf_dir)`` and returns a DataFrame whose
column names and types match the DuckDB statement of the same name in
``tessera.plans.oracle``.
"""

from __future__ import annotations

import os

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructType,
    TimestampNTZType,
)

from tessera.functions import (
    canonicalise,
    concat_key,
    surrogate_key,
    to_decimal_via_float,
    to_double,
    year_from_name,
)
from tessera.operators import (
    balance,
    copy_as_id,
    correlation_matrix,
    correlation_ranking,
    distinct_values,
    drop_columns,
    drop_corrupt,
    drop_duplicates,
    enrich,
    filter_equal,
    filter_not_equal,
    global_means,
    group_mean,
    has_columns,
    keep_one,
    key_split,
    mean_impute,
    one_hot,
    rename,
    rmse,
    select_features,
    skew_join,
    table_profile,
    union_all,
    union_by_name,
    with_constant,
)
from tessera.models.search import DEFAULT_GRIDS
from tessera.session import read_table, scratch_path
from tessera.sinks import write_collection, write_csv, write_json, write_parquet, write_partitioned
from tessera.sources import (
    SourceRegistry,
    SourceSpec,
    first_schema,
    infer_schema,
    read_csv,
    read_json,
    read_keyed_objects,
    read_offset_pages,
    read_parquet,
    read_partitioned,
    read_record_pages,
    read_snapshots,
    source_counts,
    write_offset_pages,
)
from tessera.sources.keyed_json import write_keyed_objects
from tessera.sources.pages import write_record_pages


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return read_table(spark, sf, name)


def net_price():
    return F.col("l_extendedprice") * (1 - F.col("l_discount"))


# ---------------------------------------------------------------- flagship

def feature_table(spark: SparkSession, sf: str) -> DataFrame:
    """Listings-style feature table: filtered facts with a canonical category
    and indicator columns, enriched by two aggregated dimensions."""
    orders = _t(spark, sf, "orders")
    customer = _t(spark, sf, "customer")
    supplier = _t(spark, sf, "supplier")

    facts = filter_not_equal(orders, "o_orderstatus", "P")
    base = facts.join(customer.select("c_custkey", "c_nationkey"),
                      facts.o_custkey == customer.c_custkey)
    base = base.select(
        "o_orderkey", "o_totalprice", "o_orderstatus",
        F.year("o_orderdate").cast("int").alias("year"),
        F.col("c_nationkey").alias("nation"),
        canonicalise("o_orderpriority", post={"4-not specified": "unspecified"}).alias("priority"))
    base = one_hot(base, "o_orderstatus", values=["F", "O"], names={"F": "st_f", "O": "st_o"})

    income = group_mean(customer.withColumnRenamed("c_nationkey", "nation"),
                        "nation", "c_acctbal", "average_income", round_digits=6)
    housing = group_mean(supplier.withColumnRenamed("s_nationkey", "nation"),
                         "nation", "s_acctbal", "average_price", as_decimal=None, round_digits=4)
    out = enrich(base, income, ["nation"])
    out = enrich(out, housing, ["nation"])
    return out.select("year", "nation", "o_orderkey", "o_totalprice", "priority",
                      "st_f", "st_o", "average_income", "average_price")


# ---------------------------------------------------------------- sources / sinks

def snapshot_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Orders land as monthly JSON snapshots named ``YYYY_MM_DD``; one scan
    with an inferred schema reads them back, year taken from the path."""
    orders = _t(spark, sf, "orders")
    root = scratch_path(spark, "snapshots")
    snap = orders.select("o_orderkey", "o_totalprice", "o_orderstatus",
                         F.date_format(F.trunc("o_orderdate", "month"), "yyyy_MM_dd").alias("snapshot"))
    write_partitioned(snap, root, ["snapshot"], fmt="json")
    df = read_snapshots(spark, root, glob="*.json")
    return df.select("o_orderkey", "o_totalprice", "o_orderstatus", "year")


def picked_files(spark: SparkSession, sf: str) -> DataFrame:
    """JSON files picked by prefix and suffix from a folder that also holds CSV files of other rows."""
    cust = _t(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    root = scratch_path(spark, "mixed")
    write_json(cust.filter("c_custkey % 3 <> 0"), root, mode="append")
    write_csv(cust.filter("c_custkey % 3 = 0"), root, mode="append")
    return read_json(spark, root, schema=cust.schema, glob="part-*.json")


def schema_unify(spark: SparkSession, sf: str) -> DataFrame:
    """Older snapshots lack ``o_orderpriority``; per-group schemas are
    inferred, unified (first definition wins) and all files read in one scan."""
    orders = _t(spark, sf, "orders")
    root = scratch_path(spark, "evolving")
    old_dir, new_dir = os.path.join(root, "old"), os.path.join(root, "new")
    snap = F.date_format(F.trunc("o_orderdate", "month"), "yyyy_MM_dd").alias("snapshot")
    year = F.year("o_orderdate")
    write_partitioned(orders.filter(year <= 1997).select("o_orderkey", "o_orderstatus", snap),
                      old_dir, ["snapshot"], fmt="json")
    write_partitioned(orders.filter(year >= 1998)
                      .select("o_orderkey", "o_orderstatus", "o_orderpriority", snap),
                      new_dir, ["snapshot"], fmt="json")
    schema = infer_schema(spark, [old_dir, new_dir], policy="first", glob="*.json", recursive=True)
    df = read_snapshots(spark, [old_dir, new_dir], schema=schema, glob="*.json")
    return df.select("o_orderkey", "o_orderstatus", "o_orderpriority")


def first_wins_schema(spark: SparkSession, sf: str) -> DataFrame:
    """Monthly snapshots whose orders have a whole-number price at first, then one with a
    point, and a priority from 1998 on: all files' schemas are inferred and unified, first
    definition wins, by one job, and the files read with it."""
    orders = _t(spark, sf, "orders")
    root = scratch_path(spark, "first-wins")
    month = F.date_format(F.trunc("o_orderdate", "month"), "yyyy_MM_dd").alias("snapshot")
    late = F.year("o_orderdate") >= 1998
    price = F.when(late, F.col("o_totalprice")).otherwise(F.floor("o_totalprice")).alias("price")
    write_partitioned(orders.where(~late).select("o_orderkey", price.cast("long").alias("price"), month), os.path.join(root, "old"),
                      ["snapshot"], fmt="json")
    write_partitioned(orders.where(late).select("o_orderkey", price, "o_orderpriority", month), os.path.join(root, "new"),
                      ["snapshot"], fmt="json")
    folders = [os.path.join(root, "old"), os.path.join(root, "new")]
    schema = first_schema(spark, folders, glob="*.json", recursive=True)
    df = read_snapshots(spark, folders, schema=schema, glob="*.json")
    kinds = {f.name: f.dataType.simpleString() for f in schema.fields}
    return df.select("o_orderkey", "o_orderpriority", "year", F.lit(",".join(f"{n} {t}" for n, t in kinds.items())).alias("schema"))


def csv_inferred(spark: SparkSession, sf: str) -> DataFrame:
    """Line items as CSV files with a header, read back with the types found in them."""
    li = _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", "l_returnflag", "l_shipdate")
    path = write_csv(li, scratch_path(spark, "csv-inferred"), header=True)
    df = read_csv(spark, path, infer=True, header=True)
    kinds = ",".join(t for _, t in df.dtypes)
    return df.select(F.col("l_orderkey").cast("long"), F.col("l_linenumber").cast("long"), "l_extendedprice", "l_returnflag",
                     F.col("l_shipdate").cast("date"), F.lit(kinds).alias("types"))


def versioned_table(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as a versioned table by year and status: overwritten twice, the partitions of
    1997 replaced, a failing overwrite and one from an old version refused; read back."""
    from pyspark.errors import PySparkException

    from tessera.sinks import ConcurrentCommit, VersionedTable

    orders = _t(spark, sf, "orders").select("o_orderkey", "o_totalprice", F.year("o_orderdate").cast("int").alias("year"), "o_orderstatus")
    table, by = VersionedTable(spark, scratch_path(spark, "versioned")), ["year", "o_orderstatus"]
    table.overwrite(orders.withColumn("o_totalprice", F.lit(0.0)), by)
    table.overwrite(orders, by)
    before = table.latest()
    table.replace_partitions(orders.where("year = 1997").withColumn("o_totalprice", F.col("o_totalprice") + 1000))
    refused = []
    for attempt in (lambda: table.overwrite(orders.withColumn("o_totalprice", F.raise_error(F.lit("broken")).cast("double")), by),
                    lambda: table.overwrite(orders.limit(10), by, base=before)):
        try:
            attempt()
        except (PySparkException, ConcurrentCommit) as e:
            refused.append(isinstance(e, ConcurrentCommit))
    return table.read().select("o_orderkey", "o_totalprice", "year", "o_orderstatus",
                               F.lit(table.latest()).cast("long").alias("version"), F.lit(refused == [False, True]).alias("refused"))


def offset_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Conversations stored as pages of an offset-paged API (some 200 turns a page, some with a
    field that the first record lacks, an empty page, and one behind it), read to the end."""
    conv = _t(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    note = F.when((F.col("role") == "system") & (F.col("conv_id") > 50), F.length("text")).alias("note")
    page = F.floor(F.col("conv_id") / 40)
    sizes = conv.groupBy(page.alias("page")).agg(F.count(F.lit(1)).alias("n"))     # the stand-in's offsets: a running sum
    starts = sizes.withColumn("offset", F.sum("n").over(Window.orderBy("page")) - F.col("n"))
    total = starts.agg(F.max(F.col("offset") + F.col("n"))).first()[0]
    root = scratch_path(spark, "offset-pages")
    rows = conv.select("*", note, page.alias("page")).join(starts.select("page", "offset"), "page").drop("page")
    write_offset_pages(rows, root)
    ends = [(total, '{"result": {"records": []}}'), (total + 1000, '{"result": {"records": [{"conv_id": -1}]}}')]
    spark.createDataFrame(ends, "offset long, value string").write.mode("append").partitionBy("offset").text(root)
    return read_offset_pages(spark, root)


CUSTOMER_VALUE = (StructType().add("c_custkey", LongType()).add("c_nationkey", IntegerType())
                  .add("c_acctbal", DoubleType()))


def keyed_object_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Customers stored as JSON objects keyed by customer name — one object
    (file) per block of 100k consecutive keys: each whole-file value stays a
    few MB, and the file count grows only with the table — read back with
    ``from_json`` + ``explode``."""
    cust = _t(spark, sf, "customer")
    root = scratch_path(spark, "keyed")
    files = cust.select("*", F.floor(F.col("c_custkey") / 100_000).alias("file_block"))
    write_keyed_objects(files, root, key_col="c_name",
                        value_cols=["c_custkey", "c_nationkey", "c_acctbal"],
                        file_cols=["file_block"])
    df = read_keyed_objects(spark, root, CUSTOMER_VALUE, key_col="c_name", glob=None, recursive=True)
    return df.select("c_name", "c_custkey", "c_nationkey", "c_acctbal")


def csv_scan(spark: SparkSession, sf: str) -> DataFrame:
    part = _t(spark, sf, "part").select("p_partkey", "p_brand", "p_size")
    path = write_csv(part, scratch_path(spark, "csv"), header=True)
    return read_csv(spark, path, schema=part.schema, header=True)


def parquet_scan(spark: SparkSession, sf: str) -> DataFrame:
    cust = _t(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    path = write_parquet(cust, scratch_path(spark, "parquet"))
    return read_parquet(spark, path)


def partitioned_scan(spark: SparkSession, sf: str) -> DataFrame:
    orders = _t(spark, sf, "orders").select(
        "o_orderkey", "o_totalprice", F.year("o_orderdate").cast("int").alias("year"), "o_orderstatus")
    path = write_partitioned(orders, scratch_path(spark, "partitioned"), ["year", "o_orderstatus"])
    return read_partitioned(spark, path).select("o_orderkey", "o_totalprice", "year", "o_orderstatus")


CONVERSATION_RECORD = (StructType().add("conv_id", LongType()).add("turn", LongType())
                       .add("role", StringType()).add("text", StringType()))


def paged_records(spark: SparkSession, sf: str) -> DataFrame:
    """Conversations stored as API pages (≤ 50 turns of one conversation per
    page, plus the empty end page) and flattened back into records."""
    conv = _t(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    root = scratch_path(spark, "pages")
    write_record_pages(conv, root, page_key=[F.col("conv_id"), F.floor(F.col("turn") / 50)])
    return read_record_pages(spark, root, CONVERSATION_RECORD)


def source_registry(spark: SparkSession, sf: str) -> DataFrame:
    registry = SourceRegistry([
        SourceSpec("orders", "parquet", os.path.join(sf, "orders.parquet")),
        SourceSpec("lineitem", "parquet", os.path.join(sf, "lineitem.parquet")),
    ])
    return source_counts(spark, registry)


def document_collection(spark: SparkSession, sf: str) -> DataFrame:
    cust = _t(spark, sf, "customer")
    docs = copy_as_id(cust, "c_custkey", dtype="string").select("_id", "c_name", "c_mktsegment")
    path = write_collection(docs, scratch_path(spark, "collection"), key="_id")
    return read_json(spark, path, schema=docs.schema)


def table_profile_q(spark: SparkSession, sf: str) -> DataFrame:
    return table_profile(_t(spark, sf, "orders"))


# ---------------------------------------------------------------- projections, filters

def rename_drop(spark: SparkSession, sf: str) -> DataFrame:
    part = _t(spark, sf, "part")
    df = copy_as_id(part, "p_partkey")
    df = rename(df, {"p_partkey": "id", "p_brand": "brand", "p_absent": "ignored"})
    if has_columns(df, "p_name"):
        df = drop_columns(df, "p_name", "p_type", "p_size", "p_retailprice", "p_absent")
    return df


def constant_column(spark: SparkSession, sf: str) -> DataFrame:
    orders = _t(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return with_constant(orders, "year", 2020, "int")


def filter_equal_q(spark: SparkSession, sf: str) -> DataFrame:
    orders = _t(spark, sf, "orders")
    return filter_equal(orders, o_orderstatus="F", o_orderpriority="1-URGENT") \
        .select("o_orderkey", "o_orderstatus")


def filter_not_equal_null(spark: SparkSession, sf: str) -> DataFrame:
    part = _t(spark, sf, "part").select("p_partkey", F.nullif("p_type", F.lit("PROMO")).alias("k"))
    return filter_not_equal(part, "k", "SMALL")


EVENT_LINE = StructType().add("event_id", LongType()).add("props", StructType().add("k", LongType()))


def corrupt_filter(spark: SparkSession, sf: str) -> DataFrame:
    """Events land as JSON lines; every 'error' event's line is truncated.
    A PERMISSIVE read marks those rows, which are filtered before use."""
    events = _t(spark, sf, "events")
    line = F.concat(F.lit('{"event_id": '), F.col("event_id").cast("string"),
                    F.lit(', "props": '), F.col("props"))
    text = events.select(F.when(F.col("event_type") == "error", line)
                         .otherwise(F.concat(line, F.lit("}"))).alias("value"))
    root = scratch_path(spark, "corrupt")
    text.write.mode("overwrite").text(root)
    df = read_json(spark, root, schema=EVENT_LINE, corrupt_column="_corrupt_record")
    return drop_corrupt(df).select("event_id", F.col("props.k").alias("k"))


# ---------------------------------------------------------------- scalar functions

def surrogate_key_q(spark: SparkSession, sf: str) -> DataFrame:
    part = _t(spark, sf, "part")
    return part.select("p_partkey", surrogate_key("p_name", "p_size").alias("_id"))


def mixed_concat_key(spark: SparkSession, sf: str) -> DataFrame:
    sup = _t(spark, sf, "supplier")
    return sup.select("s_suppkey", concat_key("s_suppkey", "s_nationkey", F.lit("2020")).alias("_id"))


def separated_key(spark: SparkSession, sf: str) -> DataFrame:
    """The collision-free form of the concatenated key (with a separator)."""
    sup = _t(spark, sf, "supplier")
    return sup.select("s_suppkey", concat_key("s_suppkey", "s_nationkey", F.lit("2020"),
                                              sep="|").alias("_id"))


def canonicalise_q(spark: SparkSession, sf: str) -> DataFrame:
    cust = _t(spark, sf, "customer")
    seg = canonicalise("c_mktsegment", pre={"BUILDING": "The Building"},
                       post={"machinery": "machines", "household": "home"})
    return cust.select("c_custkey", seg.alias("segment"))


def canonicalise_rules(spark: SparkSession, sf: str) -> DataFrame:
    """The same names by a versioned rule table that also has a rule for every part name;
    an older version of it had others."""
    from tessera.functions.mapping import RuleTable, canonicalise_by_rules, rule_rows

    more = _t(spark, sf, "part").select(F.lit("post").alias("stage"), F.concat(F.col("p_name"), F.lit("#"), "p_partkey").alias("value"),
                                        F.lit("part").alias("output"))
    rules = rule_rows(spark, {"BUILDING": "The Building"}, {"machinery": "machines", "household": "home"})
    table = RuleTable(spark, scratch_path(spark, "rules"))
    table.replace(rule_rows(spark, post={"machinery": "old"}))
    version = table.replace(rules.unionByName(more))
    cust = _t(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    return canonicalise_by_rules(cust, "c_mktsegment", table.rules(version)).withColumnRenamed("c_mktsegment", "segment")


def casts(spark: SparkSession, sf: str) -> DataFrame:
    li = _t(spark, sf, "lineitem")
    return li.select("l_orderkey", to_decimal_via_float("l_extendedprice").alias("price"),
                     to_double(F.col("l_quantity") > 25).alias("big"))


def year_from_name_q(spark: SparkSession, sf: str) -> DataFrame:
    cust = _t(spark, sf, "customer")
    return cust.select("c_custkey", year_from_name("c_name").alias("digits"))


# ---------------------------------------------------------------- joins

def left_join(spark: SparkSession, sf: str) -> DataFrame:
    # customers of nation 7 get a null key and odd customers of nation 8 one that no nation has
    key = F.when((F.col("c_nationkey") == 8) & (F.col("c_custkey") % 2 == 1), F.lit(-1)) \
        .otherwise(F.nullif("c_nationkey", F.lit(7)))
    cust = _t(spark, sf, "customer").select("c_custkey", key.alias("c_nationkey"))
    nation = _t(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return enrich(cust, nation, ["c_nationkey"], materialise_dim=False).select("c_custkey", "n_name")


def left_join_two_keys_null(spark: SparkSession, sf: str) -> DataFrame:
    orders = _t(spark, sf, "orders").select(
        "o_orderkey", F.nullif("o_orderstatus", F.lit("P")).alias("st"),
        F.col("o_orderpriority").alias("pr"))
    dim = orders.groupBy("st", "pr").agg(F.count(F.lit(1)).alias("n"))
    return enrich(orders, dim, ["st", "pr"]).select("o_orderkey", "n")


def star_join_two_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Orders with two dimensions on the same two keys; every fifth order's year is one that neither has."""
    orders = _t(spark, sf, "orders").select(
        "o_orderkey", F.year("o_orderdate").alias("yr"), F.col("o_orderpriority").alias("pr"),
        "o_orderstatus", "o_totalprice")
    keys = ["yr", "pr"]
    top = orders.filter("o_orderstatus = 'P'").groupBy(*keys).agg(F.max("o_totalprice").alias("top_price"))
    done = orders.filter("o_orderstatus = 'F'").groupBy(*keys).agg(F.count(F.lit(1)).alias("n_done"))
    year = F.when(F.col("o_orderkey") % 5 == 0, F.col("yr") + 100).otherwise(F.col("yr"))
    fact = orders.select("o_orderkey", year.alias("yr"), "pr")
    out = enrich(enrich(fact, top, keys), done, keys)
    return out.select("o_orderkey", "top_price", "n_done")


def left_join_fanout(spark: SparkSession, sf: str) -> DataFrame:
    nation = _t(spark, sf, "nation").select("n_nationkey")
    sup = _t(spark, sf, "supplier").select(F.col("s_nationkey").alias("n_nationkey"), "s_suppkey")
    return enrich(nation, sup, ["n_nationkey"], materialise_dim=False)


def skewed_join(spark: SparkSession, sf: str) -> DataFrame:
    """Line items and suppliers by a key that a third of both sides share (the rest by supplier
    key, some of it unknown): number of pairs and their balances, by key."""
    li, sup = _t(spark, sf, "lineitem"), _t(spark, sf, "supplier")
    fact = li.select(F.when(F.col("l_orderkey") % 3 == 0, -1).when(F.col("l_orderkey") % 50 == 1, -2)
                     .otherwise(F.col("l_suppkey")).alias("k"), "l_quantity")
    dim = sup.select(F.when(F.col("s_suppkey") % 3 == 0, -1).otherwise(F.col("s_suppkey")).alias("k"),
                     F.round(F.col("s_acctbal") * 100).cast("long").alias("cents"))
    # a row a key: the heavy key's pairs, the product of both sides' rows, are summed but never made
    totals = dim.groupBy("k").agg(F.count(F.lit(1)).alias("pairs"), F.sum("cents").alias("cents"))
    joined = skew_join(fact, totals, "k", "left", target_rows=5_000)
    return joined.groupBy("k").agg(F.sum(F.coalesce("pairs", F.lit(1))).alias("n"), F.sum("cents").cast("long").alias("cents"))


# ---------------------------------------------------------------- set operations

def union_positional(spark: SparkSession, sf: str) -> DataFrame:
    cust = _t(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("bal"))
    sup = _t(spark, sf, "supplier").select("s_suppkey", "s_acctbal")
    return union_all([cust, sup])


def union_by_name_q(spark: SparkSession, sf: str) -> DataFrame:
    """Customers and suppliers stacked by column name; suppliers have no
    segment, so theirs is null."""
    cust = _t(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
                                            F.col("c_mktsegment").alias("segment"))
    sup = _t(spark, sf, "supplier").select(F.col("s_name").alias("name"), F.col("s_suppkey").alias("id"))
    return union_by_name([cust, sup])


def distinct_values_q(spark: SparkSession, sf: str) -> DataFrame:
    return distinct_values(_t(spark, sf, "part"), "p_type")


def keyed_dedup(spark: SparkSession, sf: str) -> DataFrame:
    li = _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate",
                                          "l_partkey", "l_suppkey", "l_extendedprice")
    one = keep_one(li, ["l_orderkey", "l_linenumber"],
                   order=["-l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"])
    return one.select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")


def first_order_per_customer(spark: SparkSession, sf: str) -> DataFrame:
    """Each customer's earliest order (ties: lowest order key) — keyed dedup
    on a key whose groups are as uneven as customers' order counts."""
    orders = _t(spark, sf, "orders").select("o_custkey", "o_orderdate", "o_orderkey", "o_totalprice")
    first = keep_one(orders, ["o_custkey"], order=["o_orderdate", "o_orderkey"])
    return first.select("o_custkey", "o_orderkey", "o_totalprice")


def drop_duplicates_count(spark: SparkSession, sf: str) -> DataFrame:
    li = _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber")
    return drop_duplicates(li, ["l_orderkey", "l_linenumber"])


# ---------------------------------------------------------------- aggregations

def group_mean_decimal(spark: SparkSession, sf: str) -> DataFrame:
    li = _t(spark, sf, "lineitem").withColumn("year", F.year("l_shipdate").cast("int"))
    return group_mean(li, ["year", "l_returnflag", "l_linestatus"], "l_extendedprice",
                      "average_price", round_digits=6)


def global_means_q(spark: SparkSession, sf: str) -> DataFrame:
    li = _t(spark, sf, "lineitem")
    return global_means(li, ["l_quantity", "l_extendedprice", "l_tax"],
                        digits={"l_quantity": 4, "l_extendedprice": 4, "l_tax": 6})


def mean_impute_q(spark: SparkSession, sf: str) -> DataFrame:
    part = _t(spark, sf, "part").select("p_partkey", F.nullif("p_size", F.lit(11)).alias("p_size"))
    filled = mean_impute(part, ["p_size"])
    return filled.select("p_partkey", F.round("p_size", 6).alias("p_size"))


def one_hot_q(spark: SparkSession, sf: str) -> DataFrame:
    part = _t(spark, sf, "part").select("p_partkey", "p_type")
    return one_hot(part, "p_type", values=["PROMO", "SMALL"],
                   names={"PROMO": "promo", "SMALL": "small"})


def one_hot_discovered(spark: SparkSession, sf: str) -> DataFrame:
    """One indicator column per distinct ``p_type`` found in the data (one
    bounded distinct job), named by the value."""
    part = _t(spark, sf, "part").select("p_partkey", "p_type")
    return one_hot(part, "p_type")


def correlation_ranking_q(spark: SparkSession, sf: str) -> DataFrame:
    li = _t(spark, sf, "lineitem")
    return correlation_ranking(li, ["l_quantity", "l_extendedprice", "l_discount"],
                               net_price(), digits=6)


def correlation_matrix_q(spark: SparkSession, sf: str) -> DataFrame:
    """Every pair of five features, one of them null on every third line, the label and a constant."""
    li = _t(spark, sf, "lineitem")
    columns = {c: F.col(c) for c in MODEL_FEATURES}
    columns["l_linenumber"] = F.nullif("l_linenumber", F.lit(3))
    return correlation_matrix(li, {**columns, "net_price": net_price(), "one": F.lit(1.5)}, digits=6)


def feature_selection(spark: SparkSession, sf: str) -> DataFrame:
    part = _t(spark, sf, "part")
    ranking = correlation_ranking(part, ["p_partkey", "p_size"], "p_retailprice")
    return select_features(ranking, 0.1, exclude=["p_retailprice"]).select("feature")


def key_split_q(spark: SparkSession, sf: str) -> DataFrame:
    part = _t(spark, sf, "part").select("p_partkey")
    return key_split(part, "p_partkey", train_buckets=8, n_buckets=10, hashed=False)


def rmse_q(spark: SparkSession, sf: str) -> DataFrame:
    li = _t(spark, sf, "lineitem")
    return rmse(li, net_price(), F.col("l_extendedprice") * 0.95, digits=4)



# ---------------------------------------------------------------- models

MODEL_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"]


def _model_input(spark: SparkSession, sf: str) -> DataFrame:
    li = _t(spark, sf, "lineitem")
    return li.select("l_orderkey", *MODEL_FEATURES, net_price().alias("net_price"))


def linear_regression(spark: SparkSession, sf: str) -> DataFrame:
    """Least-squares line of net price on price (regParam 0, closed form)."""
    from tessera.models.linear import fit_line

    line = fit_line(_model_input(spark, sf), "net_price", "l_extendedprice",
                    digits={"slope": 4, "intercept": 2})
    return line.select("slope", "intercept")


def vector_features(spark: SparkSession, sf: str) -> DataFrame:
    from pyspark.ml.functions import vector_to_array

    from tessera.models import assemble

    data = mean_impute(_model_input(spark, sf), MODEL_FEATURES)
    vec = assemble(data, MODEL_FEATURES)
    # the vector's values as array<double>: same content, Arrow/pandas friendly
    return vec.select("l_orderkey", vector_to_array("features").alias("features"))


GRID_FEATURES = ["l_quantity", "l_extendedprice", "l_discount"]


def elastic_net_grid_q(spark: SparkSession, sf: str) -> DataFrame:
    """The nine linear models of the reference's grid for net prices in units of 100,000,
    from one pass over the lines: three coefficients and the intercept of each."""
    from tessera.models import coefficient_rows, elastic_net_grid, sufficient

    rows = _t(spark, sf, "lineitem").select(*GRID_FEATURES, (net_price() / 100_000).alias("net_price"))
    grid = DEFAULT_GRIDS["LR"]
    points = elastic_net_grid(sufficient(rows, GRID_FEATURES, "net_price"), grid["regParam"], grid["elasticNetParam"])
    return coefficient_rows(spark, points, digits=7)


def model_registry(spark: SparkSession, sf: str) -> DataFrame:
    """A search's models are saved and logged, the log is appended twice under one run id, the
    best of each family is read back and scored anew: how many fits the log holds, what the
    repeated append added, and whether the score is the logged one."""
    from tessera.models import best_runs, read_runs, register_runs, rescore, run_log, search_grids
    from tessera.plans.training import prepare, split

    vec, _, _ = prepare(_model_input(spark, sf), MODEL_FEATURES, "net_price", keep=["l_orderkey"])
    train, val = (part.persist(StorageLevel.MEMORY_AND_DISK) for part in split(balance(vec), "key", "l_orderkey"))
    root, spec = scratch_path(spark, "registry"), {"LR": DEFAULT_GRIDS["LR"], "RF": {"numTrees": [5], "maxDepth": [5, 8]}}
    try:
        runs = search_grids(spec, train, val, "net_price", "selected_features", parallelism=SEARCH_PARALLELISM,
                            save_dir=os.path.join(root, "models"))
        log = run_log(spark, "registry", runs)
        table = os.path.join(root, "log")
        register_runs(log, table, "first")
        once = read_runs(spark, table).groupBy("family").agg(F.count(F.lit(1)).alias("once"))
        once = {r.family: r.once for r in once.collect()}            # one row a family
        logged = register_runs(log, table, "first")
        again = rescore(spark, best_runs(logged), val, "net_price")
    finally:
        train.unpersist()
        val.unpersist()
    counts = logged.groupBy("family").agg(F.count_if(~F.col("is_best")).alias("fits"), F.count(F.lit(1)).alias("n"))
    before = F.create_map(*[F.lit(x) for item in once.items() for x in item])
    same = F.abs(F.col("scored") - F.col("logged")) <= F.col("logged") * 1e-9
    return counts.join(again, "family").select("family", "fits", (F.col("n") - before[F.col("family")]).alias("added"), same.alias("same"))


def random_split_q(spark: SparkSession, sf: str) -> DataFrame:
    from tessera.operators import random_split_labelled

    return random_split_labelled(_model_input(spark, sf).drop("net_price"), (0.8, 0.2), seed=42)


def _fit_and_score(spark: SparkSession, sf: str, family: str, params: dict) -> DataFrame:
    from tessera.models import make_estimator
    from tessera.plans.training import prepare, scored, split

    vec, _, _ = prepare(_model_input(spark, sf), MODEL_FEATURES, "net_price",
                        keep=["l_orderkey"])
    train, _ = split(balance(vec), "key", "l_orderkey")
    _, val = split(vec, "key", "l_orderkey")
    # a fit reads it a few times, then works on its own copy, which needs the memory
    train = train.persist(StorageLevel.DISK_ONLY)
    try:
        model = make_estimator(family, "net_price", "selected_features").setParams(**params).fit(train)
    finally:
        train.unpersist()
    return scored(model, balance(val), keep=["l_orderkey", "net_price"])


def random_forest(spark: SparkSession, sf: str) -> DataFrame:
    return _fit_and_score(spark, sf, "RF", {k: v[0] for k, v in DEFAULT_GRIDS["RF"].items()})


def gbt(spark: SparkSession, sf: str) -> DataFrame:
    return _fit_and_score(spark, sf, "GBT", {k: v[0] for k, v in DEFAULT_GRIDS["GBT"].items()})


# independent grid fits submitted concurrently (each one a distributed job)
SEARCH_PARALLELISM = 4


def model_search(spark: SparkSession, sf: str) -> DataFrame:
    from tessera.plans.training import train_and_validate

    res = train_and_validate(_model_input(spark, sf), MODEL_FEATURES, "net_price",
                             grids=DEFAULT_GRIDS, split_how="key", key="l_orderkey",
                             parallelism=SEARCH_PARALLELISM)
    return res.log


def run_log_q(spark: SparkSession, sf: str) -> DataFrame:
    from tessera.models import append_run_log
    from tessera.plans.training import train_and_validate

    res = train_and_validate(_model_input(spark, sf), MODEL_FEATURES, "net_price",
                             grids=DEFAULT_GRIDS, split_how="key", key="l_orderkey",
                             parallelism=SEARCH_PARALLELISM, save_dir=scratch_path(spark, "models"))
    return append_run_log(res.log, scratch_path(spark, "run_log"))


# ---------------------------------------------------------------- streaming

EVENT_SNAPSHOT = (StructType().add("event_id", LongType()).add("ts", TimestampNTZType())
                  .add("user_id", LongType()).add("event_type", StringType()))


def incremental_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """Events arrive as three snapshots (days 1-10, 11-20, 21-31 of the
    month); after each arrival an availableNow stream merges what is new
    into the per-user table, latest event wins."""
    from tessera.streaming import ingest_available

    events = _t(spark, sf, "events").select("event_id", "ts", "user_id", "event_type")
    root = scratch_path(spark, "ingest")
    source, target, ckpt = (os.path.join(root, p) for p in ("landing", "target", "checkpoint"))
    day = F.dayofmonth("ts")
    order = ["-ts", "-event_id"]
    out = None
    for lo, hi in ((1, 10), (11, 20), (21, 31)):
        events.filter(day.between(lo, hi)).write.mode("append").json(source)
        out = ingest_available(spark, source, target, ckpt, EVENT_SNAPSHOT, ["user_id"], order)
    return out.select("user_id", "event_id", "event_type")
