"""Co-moments, correlation matrix, elastic net from sufficient statistics, hash split, registry."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.models import (assemble, best_runs, elastic_net_grid, grid_rmse, optimality, read_runs, register_runs, rescore,
                            run_log, search_grids, sufficient)
from tessera.models.elastic import solve
from tessera.operators import balance, bounded_broadcast, co_moments, correlation_matrix, discover_values, one_hot, random_split
from tessera.operators.encode import TooManyCategories
from tessera.operators.moments import batch_state, merged
from tessera.operators.split import random_split_labelled


@pytest.fixture(scope="module")
def measures(spark):
    rng = random.Random(5)
    rows = []
    for _ in range(700):
        a = 1e6 + rng.gauss(0, 1)
        rows.append((a, None if rng.random() < 0.3 else 2 * a + rng.gauss(0, 3), rng.gauss(0, 1) if rng.random() < 0.5 else None,
                     0.1, None, rng.randrange(4)))
    return spark.createDataFrame(rows, "a double, b double, c double, same double, none double, n int").repartition(7), rows


def test_matrix_pair_by_pair(measures):
    df, rows = measures
    names = ["a", "b", "c", "same", "none", "n"]
    got = {(r.x, r.y): r.r for r in correlation_matrix(df, names).collect()}
    assert len(got) == 36
    for i, x in enumerate(names):
        for j, y in enumerate(names):
            both = [(r[i], r[j]) for r in rows if r[i] is not None and r[j] is not None]
            constant = not both or len({p[0] for p in both}) == 1 or len({p[1] for p in both}) == 1
            if constant:
                assert got[x, y] is None
            else:
                assert math.isclose(got[x, y], np.corrcoef(np.array(both).T)[0, 1], rel_tol=1e-9, abs_tol=1e-9)


def test_matrix_of_no_rows(measures):
    got = correlation_matrix(measures[0].where("a < 0"), {"x": F.col("a"), "y": F.col("n")}).collect()
    assert [r.r for r in got] == [None] * 4


def test_states_merge_exactly():
    rng = np.random.default_rng(0)
    x = rng.normal(1e9, 1, (5000, 3))
    there = rng.random(x.shape) < 0.8
    whole = batch_state(np.where(there, x, 0), there)
    cut = None
    for part, own in zip(np.array_split(x, 37), np.array_split(there, 37)):
        state = batch_state(np.where(own, part, 0), own)
        cut = state if cut is None else merged(cut, state)
    for a, b in zip(whole, cut):
        assert np.allclose(a, b, rtol=1e-7, atol=1e-3)


def test_one_state_a_table(measures):
    assert co_moments(measures[0], ["a", "b"]).count() == 1


@pytest.fixture(scope="module")
def prices(spark):
    rng = random.Random(2)
    rows = []
    for i in range(400):
        a, b = rng.gauss(10, 2), rng.gauss(0, 5)
        rows.append((a, b, a + 0.1 * b + rng.gauss(0, 0.3), 7.0, 3 * a - b + rng.gauss(0, 2), i))
    return spark.createDataFrame(rows, "a double, b double, c double, same double, price double, id long").repartition(4)


FEATURES = ["a", "b", "c", "same"]


def test_points_equal_the_library_fit(prices):
    from pyspark.ml.regression import LinearRegression

    points = elastic_net_grid(sufficient(prices, FEATURES, "price"), [0.0, 0.1, 1.0], [0.0, 0.5, 1.0])
    vectors = assemble(prices, FEATURES, "v").cache()
    for p in points:
        fit = LinearRegression(labelCol="price", featuresCol="v", regParam=p.reg_param, elasticNetParam=p.elastic_net,
                               maxIter=2000, tol=1e-13).fit(vectors)
        assert np.allclose(p.coefficients, fit.coefficients.toArray(), atol=2e-4) and math.isclose(p.intercept, fit.intercept, abs_tol=2e-3)
    assert sum(c == 0 for c in points[-1].coefficients) >= 2                   # the lasso drops some


def test_points_are_optimal(prices):
    points = elastic_net_grid(sufficient(prices, FEATURES, "price"), [0.01, 0.1, 1.0], [0.0, 0.5, 1.0])
    gaps = optimality(prices, points, "price").collect()
    assert len(gaps) == 9 * len(FEATURES) and max(g.gap for g in gaps) < 1e-8
    points[0].coefficients[0] += 0.01
    assert max(g.gap for g in optimality(prices, points[:1], "price").collect()) > 1e-4


def test_rows_with_nulls_and_a_constant_label(spark, prices):
    more = prices.unionByName(spark.createDataFrame([(None, 1.0, 1.0, 7.0, 5e9, 1)], prices.schema))
    a, b = (solve(sufficient(d, FEATURES, "price"), 0.1, 0.5) for d in (prices, more))
    assert np.allclose(a.coefficients, b.coefficients)
    flat = solve(sufficient(prices.withColumn("price", F.lit(4.0)), FEATURES, "price"), 0.1, 0.5)
    assert flat.coefficients == [0.0] * 4 and flat.intercept == 4.0
    assert solve(sufficient(prices.limit(0), FEATURES, "price"), 0.1, 0.5).intercept == 0.0


def test_grid_scores(prices):
    points = elastic_net_grid(sufficient(prices, FEATURES, "price"), [0.1], [0.0, 1.0])
    for p, score in zip(points, grid_rmse(prices, points, "price")):
        assert math.isclose(score, p.transform(prices).agg(F.sqrt(F.avg(F.pow(F.col("price") - F.col("prediction"), 2)))).first()[0])


def test_registry_reads_models_back(spark, prices, tmp):
    data = assemble(prices, FEATURES, "v").select("v", "price").cache()
    runs = search_grids({"LR": {"regParam": [0.1, 5.0], "elasticNetParam": [0.0, 1.0]}, "RF": {"numTrees": [3]}, "GBT": {"maxIter": [2]}},
                        data, data, "price", "v", save_dir=f"{tmp}/models")
    assert [r.params for r in runs[:4]] == [{"regParam": a, "elasticNetParam": b} for a in (0.1, 5.0) for b in (0.0, 1.0)]
    log = run_log(spark, "e", runs)
    for _ in range(3):
        register_runs(log, f"{tmp}/log", "one")
    register_runs(log.where("family = 'LR'"), f"{tmp}/log", "two")
    table = read_runs(spark, f"{tmp}/log")
    assert table.count() == log.count() + log.where("family = 'LR'").count()
    best = best_runs(table)
    assert {r.family: r.run_id for r in best.collect()} == {"LR": "one", "RF": "one", "GBT": "one"}
    for r in rescore(spark, best, data, "price").collect():
        assert math.isclose(r.logged, r.scored, rel_tol=1e-9)
        assert r.logged == min(x.rmse for x in runs if x.family == r.family)


def labels_of(df, **how):
    out = {}
    for r in random_split_labelled(df, (0.5, 0.3, 0.2), 3, ["x", "y", "z"], **how).collect():
        out.setdefault(repr(tuple(r)[:-1]), []).append(r.part_name)
    return {k: sorted(v) for k, v in out.items()}


def test_split_ignores_layout_and_numbers_equal_rows(spark):
    rows = [(i, f"t{i}", [i], {"k": i}) for i in range(500)] + [(7, None, None, None)] * 25_000 + [(None, "\\N", [None], {})] * 3
    df = spark.createDataFrame(rows, "a long, b string, c array<long>, m map<string, long>")
    one = labels_of(df.repartition(1))
    assert one == labels_of(df.repartition(9)) == labels_of(df.orderBy(F.desc("a")))
    copies = one[repr((7, None, None, None))]
    assert len(copies) == 25_000
    for name, share in (("x", 0.5), ("y", 0.3), ("z", 0.2)):
        assert abs(copies.count(name) / 25_000 - share) < 0.02
    assert sum(map(len, one.values())) == len(rows)
    assert {len(set(v)) for v in labels_of(df, distinct=True).values()} == {1}


def test_split_parts_and_seeds(spark):
    df = spark.range(2000)
    train, rest = random_split(df, (0.8, 0.2), 1)
    assert train.union(rest).distinct().count() == 2000 and abs(train.count() - 1600) < 80
    assert {r.id for r in train.collect()} != {r.id for r in random_split(df, (0.8, 0.2), 2)[0].collect()}
    by = random_split_labelled(df.withColumn("g", F.col("id") % 50), by=["g"]).groupBy("g").agg(F.count_distinct("part_name").alias("n"))
    assert by.where("n > 1").isEmpty() and random_split(df.limit(0))[0].isEmpty()


def test_a_split_of_distinct_rows_does_not_shuffle(spark):
    plan = random_split_labelled(spark.range(10), distinct=True)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_broadcasts_look_at_bytes(spark):
    wide = spark.range(100).select("id", F.repeat(F.lit("x"), 1000).alias("s"))
    assert bounded_broadcast(wide, max_rows=100)[1]
    assert not bounded_broadcast(wide, max_rows=99)[1]
    assert not bounded_broadcast(wide, max_rows=100, max_bytes=50_000)[1]


def test_categories_are_bounded(spark):
    df = spark.range(1001).select(F.col("id").cast("string").alias("c"))
    with pytest.raises(TooManyCategories):
        one_hot(df, "c")
    assert len(discover_values(df, "c", 1001)) == 1001


def test_balance_runs_no_job(spark):
    df = spark.range(1000).groupBy((F.col("id") % 7).alias("g")).count()
    tracker, group = spark.sparkContext.statusTracker(), "balance-test"
    spark.sparkContext.setJobGroup(group, "")
    try:
        out = balance(df)
        assert list(tracker.getJobIdsForGroup(group)) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert out.count() == 7
