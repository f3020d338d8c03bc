import os

from fixtures import listing, write_housing, write_income, write_snapshot
from tessera.plans.zones import (
    build_features,
    build_zones,
    clean_housing,
    clean_income,
    clean_listings,
    format_housing,
    format_income,
    format_listings,
)


def _landing(tmp):
    land = os.path.join(tmp, "landing")
    write_snapshot(land, "2020_01_02", [
        listing("1", 100000, "el Poble Sec - Parc de Montjuïc", district="Sants-Montjuïc"),
        listing("2", 200000, "Vila de Gràcia", ptype="penthouse", status="renew", district="Gràcia"),
        listing("3", 300000, "la Font de la Guatlla", ptype="countryHouse"),
        listing("4", 400000, "la Font de la Guatlla", municipality="Sitges"),
    ])
    write_snapshot(land, "2020_11_11", [])
    write_snapshot(land, "2021_02_24", [listing("1", 110000, "el Poble Sec - Parc de Montjuïc")])
    write_housing(land, 2020, {
        "el Poble Sec - Parc Montjuïc": {"Habitatges_totals": 500, "Superficie_mitjana": 60.0, "Preu_m2_mitja": 4226.94},
        "Les Corts": {"Habitatges_totals": 9000, "Superficie_mitjana": 90.0, "Preu_m2_mitja": 5000.0},
        "les Corts": {"Habitatges_totals": 3000, "Superficie_mitjana": 80.0, "Preu_m2_mitja": 5100.0},
        "la Vila de Gràcia": {"Habitatges_totals": 800, "Superficie_mitjana": 70.0, "Preu_m2_mitja": 0.0},
    })
    write_housing(land, 2021, {
        "el Poble Sec - Parc Montjuïc": {"Habitatges_totals": 510, "Superficie_mitjana": 61.0, "Preu_m2_mitja": 4654.13},
    })
    write_income(land, "income_url_1.csv", [
        "1,2020,3,Sants-Montjuïc,11,el Poble Sec - AEI Parc Montjuïc,1,20000",
        "2,2020,3,Sants-Montjuïc,11,el Poble Sec - AEI Parc Montjuïc,2,30001",
        "3,2020,6,Gràcia,31,la Vila de Gràcia,1,25000",
    ])
    write_income(land, "income_url_2.csv", [
        "1,2021,3,Sants-Montjuïc,11,el Poble Sec - AEI Parc Montjuïc,1,21000",
    ])
    return land


def test_format_listings_dedup_latest_snapshot_and_canonical_names(spark, tmp):
    land = _landing(tmp)
    df = format_listings(spark, land)
    rows = {r._id: (r.price, r.year, r.neighborhood) for r in df.collect()}
    assert rows["1"] == (110000.0, 2021, "el poble sec - aei parc montjuïc")
    assert rows["2"][2] == "la vila de gràcia"
    assert len(rows) == 4 and "_corrupt_record" not in df.columns


def test_format_housing_collisions_and_keys(spark, tmp):
    land = _landing(tmp)
    df = format_housing(spark, land)
    rows = {r._id: (r.Habitatges_totals, r.neighborhood) for r in df.collect()}
    assert rows["les_corts2020"] == (3000, "les corts")  # smaller area wins the collision
    assert rows["el_poble_sec_-_aei_parc_montjuïc2021"][1] == "el poble sec - aei parc montjuïc"
    assert df.count() == 4


def test_format_and_clean_income(spark, tmp):
    land = _landing(tmp)
    f = format_income(spark, land)
    assert sorted(r._id for r in f.collect()) == ["132020", "132021", "232020", "362020"]
    c = {(r.year, r.neighborhood): str(r.average_income) for r in clean_income(f).collect()}
    assert c[(2020, "el poble sec - aei parc montjuïc")] == "25000.50"


def test_clean_listings_filters_and_indicators(spark, tmp):
    land = _landing(tmp)
    df = clean_listings(format_listings(spark, land))
    rows = {r._id: r for r in df.collect()}
    assert set(rows) == {"1", "2"}  # country house and non-Barcelona dropped
    assert rows["2"].penthouse == 1 and rows["2"].renew == 1 and rows["2"].flat == 0
    assert rows["1"].studio == 0 and "status" not in df.columns


def test_build_features_joins_and_partitions(spark, tmp):
    land = _landing(tmp)
    paths = build_zones(spark, land, land, land, os.path.join(tmp, "zones"))
    feats = spark.read.parquet(paths["features"])
    rows = {r._id: r for r in feats.collect()}
    assert rows["1"].average_price_per_m2 == 4654.13
    assert str(rows["1"].average_income) == "21000.00"
    assert rows["2"].average_price_per_m2 == 0.0  # zero is a value, not a null
    assert feats.count() == 2


def test_fanout_when_name_in_two_districts(spark, tmp):
    listings = spark.createDataFrame([(2020, "x", "1")], "year int, neighborhood string, _id string")
    income = spark.createDataFrame([(2020, "d1", "x", 1), (2020, "d2", "x", 3)],
                                   "year int, district string, neighborhood string, average_income int")
    housing = spark.createDataFrame([("x2020", "x", 1.0, 2020)],
                                    "_id string, neighborhood string, Preu_m2_mitja double, year int")
    out = build_features(listings, income, clean_housing(housing))
    assert out.count() == 2 and out.columns[:2] == ["year", "neighborhood"]


def test_ingest_listings_incrementally(spark, tmp):
    from tessera.plans.zones import ingest_listings
    from tessera.sources import infer_schema

    land = os.path.join(tmp, "arrivals")
    write_snapshot(land, "2020_01_02", [listing("1", 100, "El Gòtic"), listing("2", 200, "x")])
    schema = infer_schema(spark, land)
    tgt, ck = os.path.join(tmp, "tgt"), os.path.join(tmp, "ck")
    out = ingest_listings(spark, land, tgt, ck, schema)
    assert {r._id: r.price for r in out.collect()} == {"1": 100.0, "2": 200.0}
    write_snapshot(land, "2021_02_24", [listing("1", 150, "El Gòtic")],
                   raw_tail='{"propertyCode": "9", broken')
    out = ingest_listings(spark, land, tgt, ck, schema)
    rows = {r._id: (r.price, r.year, r.neighborhood) for r in out.collect()}
    assert rows == {"1": (150.0, 2021, "el barri gòtic"), "2": (200.0, 2020, "x")}


def test_income_pages_land_as_csv_then_format(spark, tmp):
    import json

    from tessera.plans.zones import format_income, land_income_pages

    pages_dir = os.path.join(tmp, "pages")
    os.makedirs(pages_dir)
    rec = {"_id": 1, "Any": 2020, "Codi_Districte": 3, "Nom_Districte": "Sants-Montjuïc",
           "Codi_Barri": 11, "Nom_Barri": "el Poble Sec - AEI Parc Montjuïc",
           "Seccio_Censal": 1, "Import_Euros": 20000}
    pages = [{"result": {"records": [rec, {**rec, "_id": 2, "Import_Euros": 30000}]}},
             {"result": {"records": []}}]
    with open(os.path.join(pages_dir, "income_url_1.json"), "w", encoding="utf-8") as f:
        f.write("\n".join(json.dumps(p, ensure_ascii=False) for p in pages))
    landed = land_income_pages(spark, pages_dir, os.path.join(tmp, "landing", "income_url_1"))
    df = format_income(spark, landed, glob="*.csv")
    assert sorted(r._id for r in df.collect()) == ["132020", "232020"]
    assert df.first().Nom_Barri == "el poble sec - aei parc montjuïc"


def test_income_csv_with_columns_in_another_order_fails_loudly(spark, tmp):
    import pytest

    from tessera.plans.zones import format_income

    land = os.path.join(tmp, "odd")
    os.makedirs(land)
    with open(os.path.join(land, "income_url_9.csv"), "w") as f:
        f.write("Any,_id,Codi_Districte,Nom_Districte,Codi_Barri,Nom_Barri,Seccio_Censal,Import_Euros\n"
                "2020,1,3,Sants,11,x,1,20000\n")
    with pytest.raises(Exception, match="(?i)header|schema"):
        format_income(spark, land).collect()
