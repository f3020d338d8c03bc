"""Recipes for the three real sources, zone by zone.

landing (raw files) -> formatted (one cleaned, keyed table per source)
-> clean (one analysis-ready Parquet table per source) -> features (one
joined table partitioned by year and neighbourhood) -> models.

Every step is a lazy DataFrame plan; ``build_zones`` writes each zone once
and later zones read the written tables, so no plan is recomputed per action.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructType,
)

from tessera.functions import (
    HOUSING_RULES,
    LISTING_POST_RULES,
    LISTING_PRE_RULES,
    canonicalise,
    concat_key,
    surrogate_key,
)
from tessera.operators import (
    copy_as_id,
    drop_corrupt,
    enrich,
    filter_equal,
    filter_not_equal,
    group_mean,
    keep_one,
    one_hot,
    rename,
)
from tessera.sinks import write_collection, write_json, write_parquet, write_partitioned
from tessera.sources import (
    CORRUPT_COLUMN,
    infer_schema,
    read_csv,
    read_json,
    read_keyed_objects,
    read_snapshots,
)
from tessera.sources.snapshots import DATE_PATTERN

# --- fixed values: names and vocabularies the reference's tables use ---
LISTING_GLOB = "*_idealista.json"
HOUSING_GLOB = "BCN*.json"
INCOME_GLOB = "income*.csv"
CLEAN_LISTING_COLUMNS = [
    "_id", "municipality", "price", "year", "bathrooms", "rooms", "size", "status",
    "propertyType", "district", "neighborhood", "exterior", "hasLift", "latitude", "longitude",
]
PROPERTY_TYPES = ["flat", "penthouse", "duplex", "studio", "chalet"]
STATUSES = ["renew", "newdevelopment", "good"]
MODEL_FEATURES = [
    "year", "bathrooms", "rooms", "size", "latitude", "longitude", "average_income",
    "exterior", "hasLift", "penthouse", "duplex", "studio", "chalet", "flat", "renew",
    "newdevelopment", "good", "average_price_per_m2",
]
INCOME_RENAMES = {
    "Codi_Districte": "district_code", "Nom_Districte": "district",
    "Codi_Barri": "neighborhood_code", "Nom_Barri": "neighborhood",
    "Any": "year", "Import_Euros": "average_income",
}
# --- end of fixed values ---

# --- fixed values: field names of the sources ---
HOUSING_VALUE = (StructType().add("Habitatges_totals", LongType())
                 .add("Superficie_mitjana", DoubleType()).add("Preu_m2_mitja", DoubleType()))

INCOME_SCHEMA = (StructType().add("_id", IntegerType()).add("Any", IntegerType())
                 .add("Codi_Districte", IntegerType()).add("Nom_Districte", StringType())
                 .add("Codi_Barri", IntegerType()).add("Nom_Barri", StringType())
                 .add("Seccio_Censal", IntegerType()).add("Import_Euros", IntegerType()))
# --- end of fixed values ---


# ---------------------------------------------------------------- landing zone

def land_income_pages(spark: SparkSession, pages_dir: str, landing_dir: str,
                      record_schema: StructType = INCOME_SCHEMA) -> str:
    """Stored API response pages (``result.records``, empty end page) ->
    one CSV landing table with a header row, as the income source lands."""
    from tessera.sinks import write_csv
    from tessera.sources import read_record_pages

    records = read_record_pages(spark, pages_dir, record_schema)
    return write_csv(records, landing_dir, header=True)


def land_offset_pages(spark: SparkSession, pages_dir: str, landing_dir: str) -> str:
    """Stored responses of an offset-paged API, one file a page -> one CSV landing table whose
    header is the first record's, up to the first page without records.  Fields that only
    later records have go to a last column as JSON."""
    from tessera.sinks import write_csv
    from tessera.sources import read_offset_pages

    return write_csv(read_offset_pages(spark, pages_dir), landing_dir, header=True)


# ---------------------------------------------------------------- formatted zone

def clean_snapshot_batch(df: DataFrame, path_col: str | None = None) -> DataFrame:
    """Per-snapshot cleaning shared by batch and streaming ingest: corrupt
    rows out, canonical neighbourhood, year and snapshot date from the path."""
    df = drop_corrupt(df)
    if "neighborhood" in df.columns:
        df = df.withColumn("neighborhood", canonicalise("neighborhood", LISTING_PRE_RULES,
                                                        LISTING_POST_RULES))
    if path_col:
        y = F.regexp_extract(path_col, DATE_PATTERN, 1)
        d = F.concat_ws("-", *[F.regexp_extract(path_col, DATE_PATTERN, i) for i in (1, 2, 3)])
        df = (df.withColumn("year", F.when(y == "", None).otherwise(y).cast("int"))
                .withColumn("snapshot_date", F.when(y == "", None).otherwise(F.to_date(d)))
                .drop(path_col))
    return df


def ingest_listings(spark: SparkSession, landing: str, target: str, checkpoint: str,
                    schema: StructType, glob: str = LISTING_GLOB) -> DataFrame:
    """Incremental form of ``format_listings``: snapshots that arrived since
    the last run are cleaned and merged into the keyed listings table
    (latest snapshot wins per ``propertyCode``); returns the table."""
    from tessera.sources.files import with_corrupt_column
    from tessera.streaming import ingest_available

    def per_batch(batch: DataFrame) -> DataFrame:
        return copy_as_id(clean_snapshot_batch(batch, "_file_path"), "propertyCode")

    return ingest_available(spark, landing, target, checkpoint, with_corrupt_column(schema),
                            ["propertyCode"], ["-snapshot_date"], transform=per_batch,
                            options={"pathGlobFilter": glob, "mode": "PERMISSIVE",
                                     "columnNameOfCorruptRecord": CORRUPT_COLUMN},
                            with_file_path=True)


def format_listings(spark: SparkSession, landing, schema: StructType | None = None,
                    policy: str = "merge", glob: str = LISTING_GLOB) -> DataFrame:
    """Snapshots -> corrupt rows out -> canonical neighbourhood -> one row per
    ``propertyCode`` (latest snapshot wins, then all columns) -> ``_id``.

    ``policy="first"`` unifies per-file schemas in date order, first
    definition of a field wins (the reference's rule); ``"merge"`` keeps
    nested fields that appear only in later files."""
    if schema is None and policy == "first":
        schema = infer_schema(spark, landing, "first", glob, per_file=True)
    df = read_snapshots(spark, landing, schema=schema, policy=policy, glob=glob, recursive=False)
    df = clean_snapshot_batch(df)
    if "propertyCode" in df.columns:
        df = keep_one(df, ["propertyCode"], order=["-snapshot_date"])
        df = copy_as_id(df, "propertyCode")
    return df.drop("snapshot_date")


def format_housing(spark: SparkSession, landing, glob: str = HOUSING_GLOB) -> DataFrame:
    """Keyed yearly objects -> rows -> canonical lower-case names -> ``_id`` =
    slug(name) || year -> one row per ``_id``.  Two names that collide after
    lower-casing (a district and a neighbourhood) keep the smaller area."""
    df = read_keyed_objects(spark, landing, HOUSING_VALUE, key_col="neighborhood",
                            glob=glob, year_col="year")
    df = df.withColumn("neighborhood", canonicalise("neighborhood", post=HOUSING_RULES))
    df = df.withColumn("_id", surrogate_key("neighborhood", "year"))
    df = keep_one(df, ["_id"], order=["Habitatges_totals"])
    return df.select("Habitatges_totals", "Preu_m2_mitja", "Superficie_mitjana",
                     "neighborhood", "year", "_id")


def format_income(spark: SparkSession, landing, schema: StructType = INCOME_SCHEMA,
                  glob: str = INCOME_GLOB) -> DataFrame:
    """CSV pages of income records -> lower-case neighbourhood -> ``_id`` =
    record id || district code || year (no separator, as the source key)."""
    df = read_csv(spark, landing, schema=schema, glob=glob, check_header=True)
    df = df.withColumn("Nom_Barri", F.lower("Nom_Barri"))
    return df.withColumn("_id", concat_key("_id", "Codi_Districte", "Any"))


# ---------------------------------------------------------------- clean zone

def clean_listings(df: DataFrame, types=PROPERTY_TYPES, statuses=STATUSES) -> DataFrame:
    """Barcelona sales only, 15 columns, no country houses (null types go
    too), one INT indicator per type and status: the fixed vocabularies, so
    the model's columns always exist, and every other value found."""
    df = filter_equal(df, municipality="Barcelona", operation="sale")
    df = df.select(*CLEAN_LISTING_COLUMNS)
    df = filter_not_equal(df, "propertyType", "countryHouse")
    df = one_hot(df, "propertyType", values=types, drop=False, extend=True)
    df = one_hot(df, "status", values=statuses, drop=False, extend=True)
    return df.drop("status", "propertyType", "municipality")


def clean_income(df: DataFrame) -> DataFrame:
    """Mean income per (year, district, neighbourhood) as decimal(10,2),
    narrowed through float like the source tables."""
    df = rename(df, INCOME_RENAMES)
    return group_mean(df, ["year", "district", "neighborhood"], "average_income",
                      "average_income")


def clean_housing(df: DataFrame) -> DataFrame:
    df = df.select("_id", "neighborhood", "Preu_m2_mitja", "year")
    return rename(df, {"Preu_m2_mitja": "average_price_per_m2"})


# ---------------------------------------------------------------- exploitation zone

def build_features(listings: DataFrame, income: DataFrame, housing: DataFrame,
                   unique_dimensions: bool = False, stored: bool = False) -> DataFrame:
    """Listings ⟕ income ⟕ housing on (year, neighborhood); keys come first.

    Income is unique per (year, district, neighbourhood) but joined on
    (year, neighbourhood): a name present in two districts fans out.
    ``unique_dimensions=True`` raises instead.  ``stored=True`` says that both
    dimensions are written tables, so the joins do not copy them."""
    keys = ["year", "neighborhood"]
    out = enrich(listings, income.select(*keys, "average_income"), keys,
                 check_unique=unique_dimensions, materialise_dim=not stored)
    return enrich(out, housing.select(*keys, "average_price_per_m2"), keys,
                  check_unique=unique_dimensions, materialise_dim=not stored)


def build_zones(spark: SparkSession, listings_landing, housing_landing, income_landing,
                out_dir: str, partition_by=("year", "neighborhood"),
                collections: bool = True) -> dict:
    """Run every zone, writing each table once; returns the table paths."""
    paths = {}
    formatted = {
        "listings": format_listings(spark, listings_landing),
        "housing": format_housing(spark, housing_landing),
        "income": format_income(spark, income_landing),
    }
    for name, df in formatted.items():
        p = write_json(df, os.path.join(out_dir, "formatted", name))
        paths[f"formatted/{name}"] = p
        if collections:
            paths[f"collection/{name}"] = write_collection(
                spark.read.schema(df.schema).json(p),
                os.path.join(out_dir, "collections", name), key="_id")
    read = {n: read_json(spark, paths[f"formatted/{n}"], schema=df.schema)
            for n, df in formatted.items()}
    clean = {
        "listings": clean_listings(read["listings"]),
        "income": clean_income(read["income"]),
        "housing": clean_housing(read["housing"]),
    }
    for name, df in clean.items():
        paths[f"clean/{name}"] = write_parquet(df, os.path.join(out_dir, "clean", name))
    tables = {n: spark.read.parquet(paths[f"clean/{n}"]) for n in clean}
    features = build_features(tables["listings"], tables["income"], tables["housing"], stored=True)
    paths["features"] = write_partitioned(features, os.path.join(out_dir, "features"),
                                          list(partition_by))
    return paths
