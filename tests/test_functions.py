from decimal import Decimal

from pyspark.sql import functions as F

from tessera.functions import (
    HOUSING_RULES,
    LISTING_POST_RULES,
    LISTING_PRE_RULES,
    canonicalise,
    concat_key,
    indicator,
    replace_values,
    surrogate_key,
    to_decimal_via_float,
    to_double,
    year_from_name,
)


def test_listing_rules_all_applied(spark):
    raw = list(LISTING_PRE_RULES) + [v.upper() if False else v for v in LISTING_POST_RULES] + [None, "Unknown Place"]
    df = spark.createDataFrame([(r,) for r in raw], "n string")
    out = [r[0] for r in df.select(canonicalise("n", LISTING_PRE_RULES, LISTING_POST_RULES)).collect()]
    expected = ([v.lower() for v in LISTING_PRE_RULES.values()]
                + list(LISTING_POST_RULES.values()) + [None, "unknown place"])
    assert out == expected


def test_pre_rules_are_case_sensitive(spark):
    df = spark.createDataFrame([("vila de gràcia",), ("Vila de Gràcia",)], "n string")
    out = [r[0] for r in df.select(canonicalise("n", LISTING_PRE_RULES, LISTING_POST_RULES)).collect()]
    assert out == ["vila de gràcia", "la vila de gràcia"]


def test_housing_rules_and_large_rule_sets_use_map(spark):
    df = spark.createDataFrame([(k,) for k in HOUSING_RULES] + [("x",)], "n string")
    out = [r[0] for r in df.select(canonicalise("n", post=HOUSING_RULES)).collect()]
    assert out == list(HOUSING_RULES.values()) + ["x"]
    big = {f"k{i}": f"v{i}" for i in range(500)}
    df2 = spark.createDataFrame([("k7",), ("zz",), (None,)], "n string")
    assert [r[0] for r in df2.select(replace_values("n", big)).collect()] == ["v7", "zz", None]


def test_surrogate_key(spark):
    df = spark.createDataFrame([("Les  Corts", 2020), ("les Corts", 2020), (None, 2020), ("a", None)],
                               "n string, y int")
    out = [r[0] for r in df.select(surrogate_key("n", "y")).collect()]
    assert out == ["les__corts2020", "les_corts2020", None, None]


def test_concat_key_collision_and_separator(spark):
    df = spark.createDataFrame([(1, 12), (11, 2), (None, 1)], "a int, b int")
    plain = [r[0] for r in df.select(concat_key("a", "b")).collect()]
    sep = [r[0] for r in df.select(concat_key("a", "b", sep="|")).collect()]
    assert plain == ["112", "112", None]
    assert sep == ["1|12", "11|2", None]


def test_two_step_decimal_changes_cents(spark):
    df = spark.createDataFrame([(12345.675,)], "v double")
    r = df.select(to_decimal_via_float("v").alias("f"),
                  F.col("v").cast("decimal(10,2)").alias("d")).first()
    assert r.f == Decimal("12345.67") and r.d == Decimal("12345.68")


def test_indicator_null_is_zero_and_bool_to_double(spark):
    df = spark.createDataFrame([("a", True), (None, False), ("b", None)], "c string, b boolean")
    rows = df.select(indicator("c", "a").alias("i"), to_double("b").alias("d")).collect()
    assert [r.i for r in rows] == [1, 0, 0]
    assert [r.d for r in rows] == [1.0, 0.0, None]


def test_year_from_name(spark):
    df = spark.createDataFrame([("prices_2021.json",), ("no_year.json",), ("x12345",)], "n string")
    assert [r[0] for r in df.select(year_from_name("n")).collect()] == [2021, None, 1234]


def test_cluster_conf_bounds():
    from tessera.session import cluster_conf
    big = cluster_conf(100 * 10**12, 1000, 8)
    assert int(big["spark.sql.shuffle.partitions"]) == 80000  # clamped at 10 waves
    assert big["spark.sql.files.maxPartitionBytes"] == str(128 << 20)
    small = cluster_conf(37 * 10**6, 1, 8)
    assert int(small["spark.sql.shuffle.partitions"]) == 24  # at least 3 waves
    assert small["spark.sql.files.maxPartitionBytes"] == str(4 << 20)


def test_decimal_overflow_raises_or_nulls(spark):
    import pytest
    from pyspark.errors import ArithmeticException

    df = spark.createDataFrame([(123456789012.0,), (5.5,)], "v double")
    assert [r[0] for r in df.select(to_decimal_via_float("v", safe=True)).collect()] == [None, Decimal("5.50")]
    with pytest.raises(ArithmeticException):
        df.select(to_decimal_via_float("v")).collect()


from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

_RULE_INPUTS = list(LISTING_PRE_RULES) + list(LISTING_POST_RULES)


@settings(max_examples=6, deadline=None)
@given(st.lists(st.one_of(st.sampled_from(_RULE_INPUTS), st.text(max_size=20)), min_size=1, max_size=30))
def test_canonicalise_is_idempotent(spark, names):
    df = spark.createDataFrame([(n,) for n in names], "n string")
    once = df.select(canonicalise("n", LISTING_PRE_RULES, LISTING_POST_RULES).alias("n"))
    twice = once.select(canonicalise("n", LISTING_PRE_RULES, LISTING_POST_RULES).alias("n"))
    assert [r.n for r in once.collect()] == [r.n for r in twice.collect()]


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 120), st.integers(0, 120)), min_size=1, max_size=40, unique=True))
def test_separated_key_is_injective(spark, pairs):
    df = spark.createDataFrame(pairs, "a int, b int")
    keys = [r[0] for r in df.select(concat_key("a", "b", sep="|")).collect()]
    assert len(set(keys)) == len(pairs)
