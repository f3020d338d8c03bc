"""Tiny synthetic inputs in the shapes of the reference's sources."""

import json
import os

from tessera.plans.zones import HOUSING_GLOB, INCOME_GLOB, LISTING_GLOB  # noqa: F401


def listing(code, price, neighborhood, ptype="flat", status="good", **extra):
    row = {
        "propertyCode": code, "price": float(price), "size": 80.0, "rooms": 3, "bathrooms": 1,
        "latitude": 41.37, "longitude": 2.15, "priceByArea": 4000.0, "numPhotos": 20,
        "propertyType": ptype, "status": status, "operation": "sale",
        "municipality": "Barcelona", "province": "Barcelona", "country": "es",
        "district": "Sants-Montjuïc", "neighborhood": neighborhood, "distance": "1200",
        "exterior": True, "hasLift": True, "newDevelopment": False,
        "detailedType": {"typology": ptype},
        "suggestedTexts": {"subtitle": neighborhood, "title": "Piso"},
    }
    row.update(extra)
    return row


def write_snapshot(folder, date, rows, raw_tail=None):
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, LISTING_GLOB.replace("*", date))
    with open(path, "w", encoding="utf-8") as f:
        f.write(json.dumps(rows, ensure_ascii=False))
        if raw_tail:
            f.write("\n" + raw_tail)
    return path


def write_housing(folder, year, mapping):
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, HOUSING_GLOB.replace("*", f"_usat_acumulat_{year}"))
    with open(path, "w", encoding="utf-8") as f:
        json.dump(mapping, f, ensure_ascii=False, indent=2)
    return path


INCOME_HEADER = "_id,Any,Codi_Districte,Nom_Districte,Codi_Barri,Nom_Barri,Seccio_Censal,Import_Euros"


def write_income(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name)
    with open(path, "w", encoding="utf-8") as f:
        f.write(INCOME_HEADER + "\n" + "\n".join(lines) + "\n")
    return path
