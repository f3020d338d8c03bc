import math
import os

import numpy as np
import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.regression import GBTRegressionModel, RandomForestRegressionModel
from pyspark.sql import functions as F

from tessera.models import assemble, cells, load_model, make_estimator, search_grids

TREES = ("RF", "GBT")


def table(spark, rows, parts=3):
    """Zeros, negative values, few and many values, a cell with a fifth of the rows."""
    i = F.col("id")
    a = F.when(i % 5 == 0, 7.25).otherwise((i * 7919 % 1009) / 4 - 100)
    df = spark.range(0, rows, 1, parts).select(a.alias("a"), (i * 31 % 12).cast("double").alias("b"))
    y = F.pow("a", F.lit(2)) / 50 + F.col("b") * F.col("a") / 3 + F.pmod(F.xxhash64("a", "b", F.monotonically_increasing_id()), F.lit(100)) / 10
    return df.select("a", "b", y.alias("y"))


def vectors(df, columns):
    return assemble(df, columns, "v").select("y", "v").cache()


@pytest.fixture
def joint(monkeypatch):
    monkeypatch.setattr(cells, "FEW_ROWS", 1)
    monkeypatch.setattr(cells, "ROWS_A_CELL", 1)


def score(model, data):
    return RegressionEvaluator(labelCol="y").evaluate(model.transform(data))


def splits(model):
    """Every node's line without its last digits."""
    return [[w if i < 4 and "Predict" not in line else f"{float(w.strip(')')):.7g}" if w.strip(")").replace(".", "").lstrip("-").isdigit() else w
             for i, w in enumerate(line.split())] for line in model.toDebugString.split("\n")[1:]]


def test_jobs_of_a_search_do_not_grow_with_its_points(spark):
    data = vectors(table(spark, 120_000, 4), ["a"])
    sc, counts = spark.sparkContext, []
    for k, spec in enumerate(({"numTrees": [2], "maxDepth": [3]}, {"numTrees": [2, 3], "maxDepth": [3, 6, 9]})):
        sc.setJobGroup(f"points-{k}", "")
        try:
            runs = search_grids({"RF": spec, "GBT": {"maxIter": [2], "maxDepth": spec["maxDepth"]}}, data, data, "y", "v")
        finally:
            sc.setLocalProperty("spark.jobGroup.id", None)
        assert len(runs) == (2, 9)[k] and all(r.rmse > 0 for r in runs)
        counts.append(len(sc.statusTracker().getJobIdsForGroup(f"points-{k}")))
    assert 0 < counts[1] <= counts[0] + 2
    assert [type(r.model.load()) for r in runs[::6]] == [RandomForestRegressionModel, GBTRegressionModel]


@pytest.mark.parametrize("rows,columns", [(3000, ["a", "b"]), (24_000, ["b", "a"])])
def test_boosted_points_are_the_models_of_spark(spark, joint, rows, columns):
    data = vectors(table(spark, rows), columns)
    train, val = data.where("pmod(xxhash64(y), 5) > 0").cache(), data.where("pmod(xxhash64(y), 5) = 0").cache()
    for run in search_grids({"GBT": {"maxDepth": [2, 5], "maxBins": [16, 32], "maxIter": [4]}}, train, val, "y", "v"):
        plain = make_estimator("GBT", "y", "v").setParams(**run.params).fit(train)
        assert isinstance(run.model, cells.StoredModel) and run.model.treeWeights == plain.treeWeights
        assert splits(run.model) == splits(plain)
        assert math.isclose(run.rmse, score(plain, val), rel_tol=1e-9) and math.isclose(run.rmse, score(run.model, val), rel_tol=1e-9)


@pytest.mark.parametrize("rows,parts,draws,block,by_cell", [(60_000, 2, 64, 1 << 18, False), (1200, 12, 1 << 18, 1, True)])
def test_forests_without_draws_are_the_models_of_spark(spark, joint, monkeypatch, rows, parts, draws, block, by_cell):
    """Every tree gets each row once; rows are counted as they lie, in small chunks, or dealt by cell, with a tree to a task."""
    monkeypatch.setattr(cells, "bootstrap", lambda rng, rows, trees, bounds: np.ones((rows, trees)))
    monkeypatch.setattr(cells, "DRAWS", draws)
    monkeypatch.setattr(cells, "BLOCK", block)
    frame = type(spark.range(0))
    dealt, deal = [], frame.repartition
    monkeypatch.setattr(frame, "repartition", lambda self, *a: dealt.append(a) or deal(self, *a))
    data = vectors(table(spark, rows, parts), ["a"])
    run, = search_grids({"RF": {"numTrees": [3], "maxDepth": [6], "maxBins": [32]}}, data, data, "y", "v")
    plain = make_estimator("RF", "y", "v").setParams(numTrees=3, maxDepth=6, bootstrap=False).fit(data)
    assert any("piece" in a for a in dealt) == by_cell
    assert splits(run.model) == splits(plain) and math.isclose(run.rmse, score(plain, data), rel_tol=1e-9)


def test_forests_draw_for_every_row_and_tree(spark, joint):
    data = vectors(table(spark, 20_000), ["a", "b"])
    run, again = (search_grids({"RF": {"numTrees": [40], "maxDepth": [8]}}, data, data, "y", "v")[0] for _ in range(2))
    assert run.rmse == pytest.approx(again.rmse, rel=1e-12)
    plain = make_estimator("RF", "y", "v").setParams(numTrees=40, maxDepth=8).fit(data)
    assert 0.6 < run.rmse / score(plain, data) < 1.7
    counts = np.array([float(t._call_java("rootNode").impurityStats().count()) for t in run.model.trees])
    assert abs(counts.mean() - 20_000) < 6 * (20_000 / 40) ** 0.5 and 80 < counts.std() < 220
    first = {t.toDebugString.split("\n")[1].split("<=")[0].strip() for t in run.model.trees}
    assert first == {"If (feature 0", "If (feature 1"}       # one feature of two for a node


def test_rows_of_a_heavy_cell_are_dealt_in_pieces(spark):
    axes = cells.Axes([np.array([0.0, 10.0])])
    data = vectors(spark.range(1000).select(F.when(F.col("id") < 900, 5.0).otherwise(50.0).alias("a"), F.lit(1.0).alias("y")), ["a"])
    rows = cells.cell_rows(data, axes, "y", "v", (np.array([1]), np.array([4])))
    found = {(r.cell, r.piece): r["count"] for r in rows.groupBy("cell", "piece").count().collect()}
    assert set(found) == {(1, 0), (1, 1), (1, 2), (1, 3), (2, 0)} and found[2, 0] == 100
    assert sum(found.values()) == 1000 and max(found.values()) < 235


def test_draws_are_poisson():
    counts = cells.bootstrap(np.random.Generator(np.random.SFC64(1)), 200_000, 5, cells.poisson_bounds())
    for k in range(6):
        p = math.exp(-1) / math.factorial(k)
        assert abs((counts == k).mean() - p) < 5 * (p / 1e6) ** 0.5


def test_saved_models_are_read_back(spark, joint, tmp):
    data = vectors(table(spark, 3000), ["a", "b"])
    runs = search_grids({"RF": {"numTrees": [5], "maxDepth": [4, 7]}, "LR": {"regParam": [0.1]}, "GBT": {"maxIter": [3]}}, data, data, "y", "v",
                        parallelism=3, save_dir=os.path.join(tmp, "models"))
    assert [(r.family, os.path.basename(r.model_path)) for r in runs] == [("RF", "RF_000"), ("RF", "RF_001"), ("LR", "LR_000"), ("GBT", "GBT_000")]
    for run in runs:
        model = load_model(spark, run.family, run.model_path)
        assert math.isclose(score(model, data), run.rmse, rel_tol=1e-9)
        if run.family in TREES:
            assert all(model.getOrDefault(p) == v for p, v in run.params.items())


def test_a_constant_label_and_a_constant_feature(spark, joint):
    df = table(spark, 2000)
    same = vectors(df.withColumn("y", F.lit(3.0)), ["a"])
    flat = vectors(df.withColumn("a", F.lit(2.5)), ["a", "b"])
    for data in (same, flat):
        for run in search_grids({"RF": {"numTrees": [3]}, "GBT": {"maxIter": [2]}}, data, data, "y", "v"):
            plain = make_estimator(run.family, "y", "v").setParams(**run.params).fit(data)
            assert isinstance(run.model, cells.StoredModel)
            assert run.rmse == pytest.approx(score(plain, data), rel=1e-9 if run.family == "GBT" else 0.2, abs=1e-9)
            assert run.rmse == pytest.approx(score(run.model, data), rel=1e-9, abs=1e-9)


def test_spark_fits_few_rows_many_cells_and_what_is_not_finite(spark, monkeypatch):
    data, spec = vectors(table(spark, 3000), ["a", "b"]), {"RF": {"numTrees": [2], "maxDepth": [2]}}
    assert isinstance(search_grids(spec, data, data, "y", "v")[0].model, RandomForestRegressionModel)
    monkeypatch.setattr(cells, "FEW_ROWS", 1)
    assert isinstance(search_grids(spec, data, data, "y", "v")[0].model, RandomForestRegressionModel)
    monkeypatch.setattr(cells, "ROWS_A_CELL", 1)
    assert isinstance(search_grids(spec, data, data, "y", "v")[0].model, cells.StoredModel)
    other = {"RF": {"numTrees": [2], "minInstancesPerNode": [5]}}
    assert isinstance(search_grids(other, data, data, "y", "v")[0].model, RandomForestRegressionModel)
    broken = data.withColumn("y", F.when(F.col("y") > 60, float("nan")).otherwise(F.col("y")))
    with pytest.raises(Exception, match="(?i)label"):
        search_grids(spec, broken, data, "y", "v")


def test_run_log_saves_the_models_of_all_points(spark, joint, tmp, monkeypatch):
    from tessera.models import DEFAULT_GRIDS
    from tessera.plans import catalogue

    i = F.col("id")
    price = F.when(i % 50 == 0, F.lit(None)).otherwise(900.0 + 37 * (i % 113))
    lines = spark.range(1500).select(i.alias("l_orderkey"), (i % 50).cast("double").alias("l_quantity"), price.alias("l_extendedprice"),
                                     (i % 11 / 100).alias("l_discount"), F.lit(0.02).alias("l_tax"), (i % 7).cast("int").alias("l_linenumber"))
    lines.write.parquet(f"{tmp}/lineitem.parquet")
    monkeypatch.setattr(catalogue, "scratch_path", lambda spark, name: f"{tmp}/{name}")
    sc = spark.sparkContext
    sc.setJobGroup("run-log", "")
    try:
        log = catalogue.run_log_q(spark, tmp).collect()
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert 0 < len(sc.statusTracker().getJobIdsForGroup("run-log")) < 400
    fits = [r for r in log if not r.is_best]
    assert len(log) == 28 and len(fits) == 25 and len({r.model_path for r in fits}) == 25 and all(r.value > 0 for r in fits)
    for r in fits:
        model = load_model(spark, r.family, r.model_path)
        if r.family in TREES:
            assert model.getNumTrees == (int(r.params["numTrees"]) if r.family == "RF" else 20)
            assert {k: str(model.getOrDefault(k)) for k in r.params} == r.params
    assert set(DEFAULT_GRIDS) == {r.family for r in fits}


def test_boosted_points_of_few_rows_need_no_jobs_of_their_own(spark):
    data = vectors(table(spark, 6000), ["a"])
    forest, boosted = search_grids({"RF": {"numTrees": [2], "maxDepth": [2]}, "GBT": {"maxIter": [3], "maxDepth": [2]}}, data, data, "y", "v")
    assert isinstance(forest.model, RandomForestRegressionModel) and isinstance(boosted.model, cells.StoredModel)
    plain = make_estimator("GBT", "y", "v").setParams(maxIter=3, maxDepth=2).fit(data)
    assert splits(boosted.model) == splits(plain) and math.isclose(boosted.rmse, score(plain, data), rel_tol=1e-9)
