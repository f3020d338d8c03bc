"""Scale properties of the physical plans (not just the results)."""

from pyspark.sql import functions as F

from tessera.operators import correlation_ranking, enrich, global_means, keep_one


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_keep_one_limits_before_the_shuffle(spark):
    # one hot key holding a third of the rows
    df = spark.range(3000).select((F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id"))).alias("k"),
                                  F.col("id").alias("v"))
    out = keep_one(df, ["k"], order=["-v"])
    plan = _plan(out)
    assert "WindowGroupLimit" in plan and "Partial" in plan
    assert plan.index("Partial") > plan.index("Exchange")  # partial limit sits below the exchange
    rows = {r.k: r.v for r in out.collect()}
    assert rows[0] == 2997 and len(rows) == 2001


def test_enrich_broadcasts_small_and_not_large_dimensions(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        fact = spark.range(1000).select((F.col("id") % 50).alias("k"), "id")
        dim = spark.range(50).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
        assert "BroadcastHashJoin" in _plan(enrich(fact, dim, ["k"]))
        assert "BroadcastHashJoin" not in _plan(enrich(fact, dim, ["k"], max_broadcast_rows=10))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_means_and_correlations_are_one_aggregate(spark):
    df = spark.range(100).select(F.col("id").cast("double").alias("a"),
                                 (F.col("id") * 2.0).alias("b"), (F.col("id") % 7).alias("c"))
    for out in (global_means(df, ["a", "b", "c"]), correlation_ranking(df, ["a", "c"], "b")):
        plan = _plan(out)
        assert plan.count("HashAggregate") == 2  # partial + final, one job
    assert "PythonUDF" not in _plan(correlation_ranking(df, ["a"], "b"))
