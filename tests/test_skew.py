"""A hot key holding about half of all rows: results stay whole and exact.

The skewed table is derived from the driver's lineitem (every line with
return flag 'N' is re-keyed to order 0) and checked against DuckDB brute
force on the same derivation."""

import os

import pytest
from pyspark.sql import functions as F

from tessera.operators import enrich, group_mean, keep_one
from tessera.testing import duck_connection, table_digest

SF = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")

SKEWED_SQL = """(SELECT CASE WHEN l_returnflag = 'N' THEN 0 ELSE l_orderkey END AS k, *
                 FROM lineitem)"""


def _skewed(spark):
    li = spark.read.parquet(os.path.join(SF, "lineitem.parquet"))
    return li.select(F.when(F.col("l_returnflag") == "N", F.lit(0)).otherwise(F.col("l_orderkey"))
                     .cast("bigint").alias("k"), "*")


def _same(sdf, sql):
    con = duck_connection(SF)
    rel = con.sql(sql)
    s = table_digest(sdf.columns, [tuple(r) for r in sdf.collect()])
    d = table_digest(rel.columns, rel.fetchall())
    assert s == d


def test_hot_key_dedup_is_exact(spark):
    df = _skewed(spark)
    hot_share = df.filter("k = 0").count() / df.count()
    assert hot_share > 0.33
    out = keep_one(df.select("k", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey",
                             "l_extendedprice"),
                   ["k", "l_linenumber"], order=["-l_shipdate", "l_partkey", "l_suppkey",
                                                 "l_extendedprice"])
    _same(out.select("k", "l_linenumber", "l_partkey", "l_extendedprice"), f"""
        SELECT k, l_linenumber, l_partkey, l_extendedprice FROM (
          SELECT *, row_number() OVER (PARTITION BY k, l_linenumber ORDER BY l_shipdate DESC,
                                       l_partkey, l_suppkey, l_extendedprice) AS rn
          FROM {SKEWED_SQL}) t WHERE rn = 1""")


def test_hot_key_shuffle_join_and_mean_are_exact(spark):
    df = _skewed(spark)
    dim = group_mean(df, "k", "l_quantity", "mean_qty", as_decimal=None, round_digits=6)
    out = enrich(df.select("k", "l_linenumber"), dim, ["k"], strategy="shuffle")
    _same(out, f"""
        SELECT f.k, f.l_linenumber, d.mean_qty FROM {SKEWED_SQL} f
        LEFT JOIN (SELECT k, round(avg(l_quantity), 6) AS mean_qty FROM {SKEWED_SQL} GROUP BY k) d
          ON f.k = d.k""")
