import os

from fixtures import listing, write_housing, write_income, write_snapshot
from tessera.__main__ import main


def test_cli_zones_then_train(spark, tmp, capsys):
    land = os.path.join(tmp, "landing")
    rows = [listing(str(i), 100000 + 900 * i, "la Font de la Guatlla", size=50.0 + i,
                    rooms=1 + i % 4, bathrooms=1 + i % 2) for i in range(60)]
    write_snapshot(land, "2020_01_02", rows)
    write_housing(land, 2020, {"la Font de la Guatlla": {"Habitatges_totals": 10,
                                                         "Superficie_mitjana": 60.0,
                                                         "Preu_m2_mitja": 3745.57}})
    write_income(land, "income_url_1.csv", ["1,2020,3,Sants-Montjuïc,12,la Font de la Guatlla,1,21000"])
    out = os.path.join(tmp, "zones")
    main(["zones", "--listings", land, "--housing", land, "--income", land, "--out", out])
    assert os.path.isdir(os.path.join(out, "features"))
    main(["train", "--features", os.path.join(out, "features"), "--label", "price",
          "--run-log", os.path.join(tmp, "runs"), "--parallelism", "2",
          "--grids", '{"RF": {"numTrees": [5]}, "LR": {"regParam": [0.1, 0.0]}, "GBT": {"maxIter": [3]}}'])
    log = spark.read.parquet(os.path.join(tmp, "runs"))
    assert log.filter("is_best").count() == 3  # one best run per model family
    assert "Best_RF_Model" in capsys.readouterr().out
