import pytest

from tessera.models import RUN_LOG_SCHEMA, Run, best_run, run_name
from tessera.plans.training import train_and_validate


def test_best_run_first_wins_ties():
    runs = [Run("LR", {"a": 1}, 2.0), Run("LR", {"a": 2}, 1.0), Run("LR", {"a": 3}, 1.0)]
    assert best_run(runs).params == {"a": 2}
    assert run_name("LR", {"regParam": 0.1, "elasticNetParam": 0.5}) == "LR_regParam_0.1_elasticNet_0.5"


def test_train_and_validate_selects_and_logs(spark):
    rows = [(float(i), float(i % 7), 3.0 * i + 1.0 + (i % 3)) for i in range(300)]
    df = spark.createDataFrame(rows, "x double, noise double, price double")
    res = train_and_validate(df, ["x", "noise"], "price",
                             grids={"LR": {"regParam": [0.0, 0.1]}}, split_how="random")
    assert res.selected == ["x"]
    log = res.log.collect()
    assert res.log.schema == RUN_LOG_SCHEMA
    assert len(log) == 3 and sum(r.is_best for r in log) == 1
    best = [r for r in log if r.is_best][0]
    assert best.value == min(r.value for r in log if not r.is_best)


def test_train_and_validate_fit_on_train_only(spark):
    rows = [(i, float(i), 3.0 * i + 1.0 + (i % 3)) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, x double, price double")
    res = train_and_validate(df, ["x"], "price", grids={"LR": {"regParam": [0.0]}},
                             split_how="key", key="id", fit_on="train")
    assert res.selected == ["x"] and res.log.count() == 2


def test_correlation_matrix_agrees_with_ranking(spark):
    import math

    from tessera.models import assemble, correlation_matrix
    from tessera.operators import correlation_ranking

    rows = [(float(i), float((i * 7) % 11), 2.0 * i + (i % 5)) for i in range(50)]
    df = spark.createDataFrame(rows, "a double, b double, y double")
    m = correlation_matrix(assemble(df, ["a", "b", "y"]), "features").toArray()
    r = {row.feature: row.r for row in correlation_ranking(df, ["a", "b"], "y").collect()}
    assert math.isclose(m[0, 2], r["a"], rel_tol=1e-9) and math.isclose(m[1, 2], r["b"], rel_tol=1e-9)


def test_registered_searches_fit_the_full_grids(monkeypatch):
    from tessera.models import DEFAULT_GRIDS
    from tessera.plans import catalogue, training

    class Stop(Exception):
        pass

    given = []

    def caught(*args, grids=DEFAULT_GRIDS, **kwargs):
        given.append(grids)
        raise Stop

    monkeypatch.setattr(training, "train_and_validate", caught)
    monkeypatch.setattr(catalogue, "_model_input", lambda spark, sf: None)
    monkeypatch.setattr(catalogue, "scratch_path", lambda spark, name: name)
    for query in (catalogue.model_search, catalogue.run_log_q):
        with pytest.raises(Stop):
            query(None, "")
    assert given == [DEFAULT_GRIDS, DEFAULT_GRIDS]


def test_concurrent_fits_share_no_local_properties(spark, monkeypatch):
    import threading

    from tessera.models import search

    together, sc, name = threading.Barrier(3, timeout=60), spark.sparkContext, "tessera.test.fit"
    seen = {}

    class Model:
        def transform(self, df):
            return df

    class Estimator:
        def setCacheNodeIds(self, value):
            return self

        def fit(self, df, params):
            sc.setLocalProperty(name, str(params[0][1]))
            together.wait()
            seen[params[0][1]] = (sc.getLocalProperty(name), sc.getLocalProperty("tessera.test.caller"))
            return Model()

    class Param:
        name = "numTrees"

    class Evaluator:
        def __init__(self, **kwargs):
            pass

        def evaluate(self, df):
            return 1.0

    class Point(dict):
        def __getitem__(self, key):
            return dict.__getitem__(self, Param) if key is Param else (key, dict.__getitem__(self, Param))

    monkeypatch.setattr(search, "make_estimator", lambda *a: Estimator())
    monkeypatch.setattr(search, "grid", lambda est, spec: [Point({Param: v}) for v in spec["numTrees"]])
    monkeypatch.setattr(search, "RegressionEvaluator", Evaluator)
    sc.setLocalProperty("tessera.test.caller", "kept")
    try:
        runs = search.search_grids({"RF": {"numTrees": [1, 2, 3]}}, spark.range(1), spark.range(1), "y", parallelism=3)
    finally:
        sc.setLocalProperty("tessera.test.caller", None)
    assert [r.params for r in runs] == [{"numTrees": n} for n in (1, 2, 3)]
    assert seen == {n: (str(n), "kept") for n in (1, 2, 3)}


def test_forests_of_a_search_keep_node_ids(spark):
    from tessera.models import assemble, make_estimator, search_grids

    rows = [(float(i % 97), float(i * 7 % 31), float(i % 97) ** 2 - 3.0 * (i * 7 % 31)) for i in range(2000)]
    data = assemble(spark.createDataFrame(rows, "a double, b double, y double"), ["a", "b"], "v").select("v", "y").coalesce(2).cache()
    run, = search_grids({"RF": {"numTrees": [4], "maxDepth": [7]}}, data, data, "y", "v")
    plain = make_estimator("RF", "y", "v").setParams(numTrees=4, maxDepth=7).fit(data)
    assert run.model.getCacheNodeIds() and not plain.getCacheNodeIds()
    assert run.model.toDebugString.split("\n")[1:] == plain.toDebugString.split("\n")[1:]


def test_only_rows_to_be_scored_are_spread_for_scoring(spark, tmp, monkeypatch):
    from tessera.plans import catalogue

    lines = [(i, float(i % 50), 1000.0 + 37 * (i % 113), (i % 11) / 100, 0.02, i % 7) for i in range(1500)]
    spark.createDataFrame(lines, "l_orderkey long, l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                                 "l_linenumber int").write.parquet(f"{tmp}/lineitem.parquet")
    spread, balance = [], catalogue.balance
    monkeypatch.setattr(catalogue, "balance", lambda df, *a: spread.append(df.count()) or balance(df, *a))
    keys = [r.l_orderkey for r in catalogue._fit_and_score(spark, tmp, "RF", {"numTrees": 2, "maxDepth": 3}).collect()]
    assert 200 < len(keys) == len(set(keys)) < 400 and spread == [1500, len(keys)]
