import json
import os

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructType

from fixtures import listing, write_housing, write_snapshot
from tessera.sinks import DuplicateKey, write_collection, write_csv, write_partitioned
from tessera.sources import (
    SourceRegistry,
    SourceSpec,
    infer_schema,
    read_csv,
    read_keyed_objects,
    read_partitioned,
    read_record_pages,
    read_snapshots,
    source_counts,
    unify_schemas,
)
from tessera.plans.zones import HOUSING_GLOB, HOUSING_VALUE, LISTING_GLOB


def _snapshots(tmp):
    land = os.path.join(tmp, "landing")
    write_snapshot(land, "2020_01_02", [listing("1", 100, "El Gòtic"), listing("2", 200, "la marina del port")])
    write_snapshot(land, "2020_11_11", [])
    write_snapshot(land, "2021_02_24", [listing("1", 150, "El Gòtic",
                                                parkingSpace={"hasParkingSpace": True,
                                                              "parkingSpacePrice": 9000.0})])
    return land


def test_snapshots_one_scan_year_from_name_empty_file(spark, tmp):
    land = _snapshots(tmp)
    df = read_snapshots(spark, land, glob=LISTING_GLOB, recursive=False)
    rows = sorted((r.propertyCode, r.year, str(r.snapshot_date)) for r in df.collect())
    assert rows == [("1", 2020, "2020-01-02"), ("1", 2021, "2021-02-24"), ("2", 2020, "2020-01-02")]
    assert "parkingSpace" in df.columns and "_corrupt_record" in df.columns


def test_unify_first_vs_merge_keeps_nested_fields(spark, tmp):
    a = StructType().add("k", StringType()).add("s", StructType().add("x", LongType()))
    b = StructType().add("s", StructType().add("x", LongType()).add("y", StringType())).add("z", LongType())
    first = unify_schemas([a, StructType(), b], "first")
    merged = unify_schemas([a, StructType(), b], "merge")
    assert first.fieldNames() == ["k", "s", "z"] and first["s"].dataType.fieldNames() == ["x"]
    assert merged["s"].dataType.fieldNames() == ["x", "y"]
    land = _snapshots(tmp)
    paths = sorted(os.path.join(land, f) for f in os.listdir(land))
    s = infer_schema(spark, paths, policy="first")
    assert "parkingSpace" in s.fieldNames()


def test_corrupt_rows_are_marked(spark, tmp):
    land = os.path.join(tmp, "landing")
    write_snapshot(land, "2020_06_01", [listing("1", 100, "x")],
                   raw_tail='{"propertyCode": "2", "price": "not-a-number"}\n{"propertyCode": "3", broken')
    # the known schema (price is a double); inference would widen it to string
    schema = StructType().add("propertyCode", StringType()).add("price", DoubleType())
    df = read_snapshots(spark, land, schema=schema, recursive=False)
    rows = {r.propertyCode: r._corrupt_record for r in df.collect()}
    assert rows["1"] is None
    assert rows["2"] is not None  # valid key, wrong-typed field: still marked
    assert None in rows and rows[None] is not None


def test_keyed_objects_case_colliding_keys(spark, tmp):
    land = os.path.join(tmp, "housing")
    write_housing(land, 2020, {
        "Les Corts": {"Habitatges_totals": 900, "Superficie_mitjana": 80.5, "Preu_m2_mitja": 4000.0},
        "les Corts": {"Habitatges_totals": 300, "Superficie_mitjana": 70.0, "Preu_m2_mitja": 4100.0},
        "Sants": {"Habitatges_totals": 10, "Superficie_mitjana": 60.0, "Preu_m2_mitja": 0.0},
    })
    df = read_keyed_objects(spark, land, HOUSING_VALUE, key_col="neighborhood", glob=HOUSING_GLOB,
                            year_col="year")
    assert df.columns == ["neighborhood", "Habitatges_totals", "Superficie_mitjana", "Preu_m2_mitja", "year"]
    rows = {r.neighborhood: (r.Habitatges_totals, r.year) for r in df.collect()}
    assert rows == {"Les Corts": (900, 2020), "les Corts": (300, 2020), "Sants": (10, 2020)}


def test_record_pages_empty_page_vanishes(spark, tmp):
    folder = os.path.join(tmp, "pages")
    os.makedirs(folder)
    pages = [{"result": {"records": [{"_id": 1, "Nom_Barri": "a"}, {"_id": 2, "Nom_Barri": "b"}]}},
             {"result": {"records": [{"_id": 3, "Nom_Barri": "c"}]}},
             {"result": {"records": []}}]
    with open(os.path.join(folder, "p.json"), "w") as f:
        f.write("\n".join(json.dumps(p) for p in pages))
    rec = StructType().add("_id", LongType()).add("Nom_Barri", StringType())
    df = read_record_pages(spark, folder, rec)
    assert sorted(r._id for r in df.collect()) == [1, 2, 3]


def test_registry_and_csv_and_partitioned_round_trip(spark, tmp):
    df = spark.createDataFrame([(1, "la Vila de Gràcia", 2020), (2, "l'Antiga Esquerra / x", 2021)],
                               "id long, neighborhood string, year int")
    p = write_partitioned(df, os.path.join(tmp, "t"), ["year", "neighborhood"])
    back = read_partitioned(spark, p).filter(F.col("year") == 2020)
    assert [(r.id, r.neighborhood) for r in back.collect()] == [(1, "la Vila de Gràcia")]
    c = write_csv(df, os.path.join(tmp, "c"))
    assert sorted(read_csv(spark, c, schema=df.schema).collect()) == sorted(df.collect())
    reg = SourceRegistry.from_dict({"csv": {"fmt": "csv", "path": c, "options": {"header": "true"}}})
    assert source_counts(spark, reg).first().asDict() == {"source": "csv", "n_rows": 2}
    reg.register(SourceSpec("part", "parquet", p))
    assert reg.read(spark, "part").count() == 2


def test_collection_rejects_duplicate_and_null_keys(spark, tmp):
    ok = spark.createDataFrame([("a", 1), ("b", 2)], "_id string, v int")
    write_collection(ok, os.path.join(tmp, "ok"))
    dup = spark.createDataFrame([("a", 1), ("a", 2)], "_id string, v int")
    with pytest.raises(DuplicateKey):
        write_collection(dup, os.path.join(tmp, "dup"))
    null = spark.createDataFrame([(None, 1)], "_id string, v int")
    with pytest.raises(DuplicateKey):
        write_collection(null, os.path.join(tmp, "null"))


def test_registry_from_file(spark, tmp):
    cfg = os.path.join(tmp, "sources.json")
    data = os.path.join(tmp, "d")
    spark.range(3).write.parquet(data)
    with open(cfg, "w") as f:
        json.dump({"ids": {"fmt": "parquet", "path": data}}, f)
    reg = SourceRegistry.from_file(cfg)
    assert reg.names() == ["ids"] and reg.read(spark, "ids").count() == 3


def test_no_snapshot_files_is_a_clear_outcome(spark, tmp):
    from tessera.sources import NoSnapshots
    os.makedirs(os.path.join(tmp, "empty"))
    with pytest.raises(NoSnapshots):
        read_snapshots(spark, os.path.join(tmp, "empty"), glob=LISTING_GLOB, recursive=False)


def test_first_wins_per_file_in_date_order(spark, tmp):
    from tessera.plans.zones import format_listings
    from tessera.sources.snapshots import snapshot_files

    land = _snapshots(tmp)
    files = snapshot_files(spark, land, glob=LISTING_GLOB)
    # the empty "[]" snapshot is listed too; it infers struct<> and adds nothing
    assert [os.path.basename(f)[:10] for f in files] == ["2020_01_02", "2020_11_11", "2021_02_24"]
    first = format_listings(spark, land, policy="first")
    merged = format_listings(spark, land, policy="merge")
    assert "parkingSpace" in first.columns and "parkingSpace" in merged.columns
    assert first.count() == merged.count() == 2


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(-10**12, 10**12), st.one_of(st.none(), st.text(max_size=12)),
                          st.one_of(st.none(), st.floats(allow_nan=False, allow_infinity=False))),
                min_size=1, max_size=25))
def test_write_read_round_trip_property(spark, tmp_path_factory, rows):
    from tessera.sinks import write_json, write_parquet
    from tessera.sources import read_json, read_parquet

    df = spark.createDataFrame(rows, "k long, s string, x double")
    base = str(tmp_path_factory.mktemp("rt"))
    expect = sorted(rows, key=repr)
    back_p = read_parquet(spark, write_parquet(df, os.path.join(base, "p")))
    back_j = read_json(spark, write_json(df, os.path.join(base, "j")), schema=df.schema)
    for back in (back_p, back_j):
        assert sorted((tuple(r) for r in back.collect()), key=repr) == expect


def test_file_year_tags_and_small_helpers(spark, tmp):
    from tessera.operators import preview, row_count
    from tessera.sources import with_file_year

    folder = os.path.join(tmp, "yearly")
    os.makedirs(folder)
    for y in (2020, 2021):
        with open(os.path.join(folder, HOUSING_GLOB.replace("*", f"_usat_acumulat_{y}")), "w") as f:
            f.write(json.dumps({"v": y}) + "\n")
    df = with_file_year(spark.read.json(folder))
    assert sorted((r.v, r.year) for r in df.collect()) == [(2020, 2020), (2021, 2021)]
    reg = SourceRegistry([SourceSpec("h", "json", folder, year_from_file=True)])
    assert sorted(r.year for r in reg.read(spark, "h").collect()) == [2020, 2021]
    assert preview(df, 1).count() == 1
    assert row_count(df).first().n_rows == 2


def test_record_pages_saved_verbatim_one_per_file(spark, tmp):
    folder = os.path.join(tmp, "verbatim")
    os.makedirs(folder)
    for i, recs in enumerate([[{"_id": 1}, {"_id": 2}], [{"_id": 3}], []]):
        with open(os.path.join(folder, f"page_{i}.json"), "w") as f:
            json.dump({"help": "...", "success": True, "result": {"records": recs, "total": 3}}, f,
                      indent=2)
    rec = StructType().add("_id", LongType())
    df = read_record_pages(spark, folder, rec, multi_line=True)
    assert sorted(r._id for r in df.collect()) == [1, 2, 3]


def test_pretty_printed_snapshot_arrays(spark, tmp):
    land = os.path.join(tmp, "pretty")
    os.makedirs(land)
    with open(os.path.join(land, LISTING_GLOB.replace("*", "2020_03_04")), "w") as f:
        json.dump([listing("7", 10, "x"), listing("8", 20, "y")], f, indent=2)
    df = read_snapshots(spark, land, glob=LISTING_GLOB, recursive=False, multi_line=True)
    assert sorted((r.propertyCode, r.year) for r in df.collect()) == [("7", 2020), ("8", 2020)]


def test_csv_round_trip_keeps_values(spark, tmp):
    values = ["  pad ", "two\nlines", 'a "quoted", one', "", None, "plain"]
    df = spark.createDataFrame(list(enumerate(values)), "id int, v string")
    path = write_csv(df, os.path.join(tmp, "odd"))
    assert sorted(map(tuple, read_csv(spark, path, schema=df.schema).collect())) == list(enumerate(values))


def test_truncated_pages_and_objects_fail(spark, tmp):
    from pyspark.sql.types import IntegerType, StructType

    from tessera.sources.keyed_json import read_keyed_objects
    from tessera.sources.pages import read_record_pages

    for name, text in (("page", '{"result": {"records": [{"a": 1}, {"a"'), ("object", '{"k": {"a": 1}, "l": {"a"')):
        os.makedirs(os.path.join(tmp, name))
        with open(os.path.join(tmp, name, "x.json"), "w") as f:
            f.write(text)
    schema = StructType().add("a", IntegerType())
    for frame in (read_record_pages(spark, os.path.join(tmp, "page"), schema),
                  read_keyed_objects(spark, os.path.join(tmp, "object"), schema)):
        with pytest.raises(Exception, match="(?i)malformed"):
            frame.collect()
