"""Parity on the original sample inputs, when available.

Set TESSERA_SAMPLE_DIR to a folder holding the two yearly housing objects,
with the listing snapshots in one of its subfolders; the expected numbers
are the profile of that sample (SURVEY §5)."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from tessera.plans.zones import (
    HOUSING_GLOB,
    HOUSING_VALUE,
    LISTING_GLOB,
    clean_housing,
    clean_listings,
    format_housing,
    format_listings,
)
from tessera.sources import read_keyed_objects, read_snapshots

SAMPLE = os.environ.get("TESSERA_SAMPLE_DIR")
pytestmark = pytest.mark.skipif(not SAMPLE, reason="TESSERA_SAMPLE_DIR not set")


def _dirs():
    """(listing snapshot folder, housing folder)."""
    matches = glob.glob(os.path.join(SAMPLE, "*", LISTING_GLOB))
    assert matches, "no listing snapshots under the sample folder"
    return os.path.dirname(matches[0]), SAMPLE


def test_listing_sample_profile(spark):
    listings, _ = _dirs()
    raw = read_snapshots(spark, listings, glob=LISTING_GLOB, recursive=False)
    assert raw.count() == 100
    assert raw.select("propertyCode").distinct().count() == 70
    assert dict(raw.groupBy("year").count().collect()) == {2020: 93, 2021: 7}
    f = format_listings(spark, listings)
    stats = f.agg(F.count("*"), F.round(F.avg("price"), 6), F.min("price"), F.max("price")).first()
    assert tuple(stats) == (70, 320647.142857, 85500.0, 1240000.0)
    by_type = {(r[0], r[1]): r[2] for r in f.groupBy("propertyType", "status").count().collect()}
    assert by_type == {("flat", "good"): 54, ("flat", "renew"): 8, ("penthouse", "good"): 5,
                       ("chalet", "good"): 2, ("duplex", "good"): 1}
    by_hood = dict(f.groupBy("neighborhood").count().collect())
    assert by_hood == {"el poble sec - aei parc montjuïc": 50, "la font de la guatlla": 20}
    assert clean_listings(f).count() == 70


def test_housing_sample_profile(spark):
    _, housing = _dirs()
    raw = read_keyed_objects(spark, housing, HOUSING_VALUE, key_col="neighborhood",
                             glob=HOUSING_GLOB, year_col="year")
    assert dict(raw.groupBy("year").count().collect()) == {2020: 82, 2021: 82}
    h = format_housing(spark, housing)
    assert dict(h.groupBy("year").count().collect()) == {2020: 81, 2021: 81}
    prices = {(r.year, r.neighborhood): r.average_price_per_m2 for r in clean_housing(h).collect()}
    assert prices[(2020, "el poble sec - aei parc montjuïc")] == 4226.94
    assert prices[(2021, "el poble sec - aei parc montjuïc")] == 4654.13
    assert prices[(2020, "la font de la guatlla")] == 3745.57
    assert prices[(2021, "la font de la guatlla")] == 3735.71
