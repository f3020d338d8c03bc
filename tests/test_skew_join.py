"""Joins with heavy keys on both sides, and rule tables."""

import collections
import random

import pytest
from pyspark.sql import functions as F

from tessera.functions.mapping import BadRules, RuleTable, canonicalise_by_rules, check_rules, rule_rows
from tessera.operators.skew import heavy_hashes, heavy_keys, skew_join


@pytest.fixture(scope="module")
def sides(spark):
    rng = random.Random(7)
    fact = [(rng.choice(["hot", "hot", "a", "b", "gone", None]), rng.randrange(3), f"f{i}") for i in range(600)]
    fact += [("gone", 9, "same")] * 300 + [("hot", 1, "same")] * 100
    dim = [(rng.choice(["hot", "hot", "a", "c", None]), rng.randrange(3), f"d{i}") for i in range(200)] + [("big", 0, "x")] * 80
    return (spark.createDataFrame(fact, "k string, n int, f string").repartition(5),
            spark.createDataFrame(dim, "k string, n int, d string").repartition(3), fact, dim)


def expected(fact, dim, how):
    index = collections.defaultdict(list)
    for k, n, d in dim:
        if k is not None:
            index[k, n].append(d)
    out = collections.Counter()
    for k, n, f in fact:
        for d in index.get((k, n), [None] if how == "left" else []):
            out[k, n, f, d] += 1
    return out


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("target", [10, 60, 10**6])
def test_skew_join_equals_plain_join(sides, how, target):
    fact, dim, f_rows, d_rows = sides
    got = skew_join(fact, dim, ["k", "n"], how, target)
    assert got.columns == ["k", "n", "f", "d"]
    assert collections.Counter(map(tuple, got.collect())) == expected(f_rows, d_rows, how)


def test_heavy_keys_get_cells(sides):
    fact, dim, f_rows, d_rows = sides
    rows = {tuple(r)[:2]: tuple(r)[2:] for r in heavy_keys(fact, dim, ["k", "n"], 60).collect()}
    f_count, d_count = (collections.Counter(r[:2] for r in rs) for rs in (f_rows, d_rows))
    assert rows[("gone", 9)] == (5, 0)
    for key, (a, b) in rows.items():
        assert a == -(-f_count[key] // 60) and b == -(-d_count[key] // 60)
    assert heavy_hashes(fact.limit(0), ["k"], 1) == []


def test_no_task_has_a_whole_heavy_key(spark):
    fact = spark.range(9000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"), F.col("id").alias("f")).repartition(6)
    dim = spark.range(300).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"), F.col("id").alias("d")).repartition(2)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        tasks = skew_join(fact, dim, "k", "left", 25).where("k = -1").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    sizes = sorted(r["count"] for r in tasks)
    assert sum(sizes) == 3000 * 100 and len(sizes) >= 14 and sizes[-1] <= 3 * sizes[len(sizes) // 2]


def test_other_kinds_are_refused(sides):
    with pytest.raises(ValueError):
        skew_join(*sides[:2], "k", "full")
    with pytest.raises(ValueError):
        skew_join(sides[0], sides[1].withColumn("n", F.col("n").cast("long")), ["k", "n"])


RULES = {"pre": {"Gràcia": "la Vila de Gràcia", "same": "same"}, "post": {"la vila de gràcia": "vila", "el gòtic": "barri gòtic", "x": "x"}}


def test_rules_by_table(spark, tmp):
    table = RuleTable(spark, f"{tmp}/rules")
    assert table.replace(rule_rows(spark, **RULES)) == 1
    assert table.replace(rule_rows(spark, post={"el gòtic": "other"})) == 2
    names = [("Gràcia",), ("gràcia",), ("El Gòtic",), ("X",), (None,), ("",), ("Gràcia",)]
    df = spark.createDataFrame([(n, i) for i, (n,) in enumerate(names)], "name string, value int")
    got = canonicalise_by_rules(df, "name", table.rules(1))
    assert got.columns == df.columns
    assert [r.name for r in got.orderBy("value").collect()] == ["vila", "gràcia", "barri gòtic", "x", None, "", "vila"]
    newest = canonicalise_by_rules(df, "name", table.rules(), out="short")
    assert newest.columns == ["name", "value", "short"] and newest.where("value = 2").first().short == "other"


@pytest.mark.parametrize("rules", [
    [("post", "a", "b"), ("post", "b", "c")], [("post", "a", "b"), ("post", "a", "c")], [("late", "a", "b")],
    [(None, "a", "b")], [("pre", None, "b")], [("pre", "a", None)]])
def test_bad_rules(spark, rules):
    with pytest.raises(BadRules):
        check_rules(spark.createDataFrame(rules, "stage string, value string, output string"))


def test_many_rules_equal_the_case_chain(spark):
    from tessera.functions import canonicalise
    from tessera.plans.zones import LISTING_POST_RULES, LISTING_PRE_RULES

    own = rule_rows(spark, LISTING_PRE_RULES, LISTING_POST_RULES)
    many = spark.range(100_000).select(F.lit("post").alias("stage"), F.concat(F.lit("no such "), "id").alias("value"), F.lit("none").alias("output"))
    names = [*LISTING_PRE_RULES, *LISTING_POST_RULES, *map(str.upper, LISTING_POST_RULES), "Elsewhere", None]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    want = [r[0] for r in df.select(canonicalise("name", LISTING_PRE_RULES, LISTING_POST_RULES)).collect()]
    for rules in (own, own.unionByName(many)):
        check_rules(rules)
        got = canonicalise_by_rules(df, "name", rules, out="done").collect()
        key = lambda p: (p[0] is None, p[0] or "", p[1] or "")
        assert sorted(((r.name, r.done) for r in got), key=key) == sorted(zip(names, want), key=key)


def test_skewed_join_query_makes_no_pairs(spark, tmp, monkeypatch):
    from tessera.plans import catalogue

    rng = random.Random(5)
    lines = [(rng.choice([None, *range(60)]), rng.choice([None, *range(12)]), 1.0) for _ in range(9000)] + [(3, 1, 2.0)] * 6000
    supp = [(rng.choice([None, *range(9)]), rng.choice([None, -7.25, 0.1, 900.0])) for _ in range(80)] + [(10, None)] * 2
    spark.createDataFrame(lines, "l_orderkey long, l_suppkey long, l_quantity double").write.parquet(f"{tmp}/lineitem.parquet")
    spark.createDataFrame(supp, "s_suppkey long, s_acctbal double").write.parquet(f"{tmp}/supplier.parquet")
    made, join = [], catalogue.skew_join
    monkeypatch.setattr(catalogue, "skew_join", lambda *a, **kw: made.append(join(*a, **kw)) or made[-1])
    got = {r.k: (r.n, r.cents) for r in catalogue.skewed_join(spark, tmp).collect()}
    dim, want = collections.defaultdict(list), {}
    for s, bal in supp:
        dim[-1 if s is not None and s % 3 == 0 else s].append(None if bal is None else round(bal * 100))
    for o, s, _ in lines:
        k = s if o is None else -1 if o % 3 == 0 else -2 if o % 50 == 1 else s
        found = dim.get(k, [None]) if k is not None else [None]
        n, cents = want.get(k, (0, None))
        known = [c for c in found if c is not None]
        want[k] = (n + len(found), (cents or 0) + sum(known) if known else cents)
    assert got == want and got[-1][0] > 100_000 and got[10][1] is None and got[10][0] > 2
    assert made[0].count() == len(lines)
