"""Every catalogue query against its DuckDB statement on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from tessera.testing import compare, duck_connection

SF = "/root/testdata/sf0.001"
ORACLE = entry.oracle_sql()
QUERIES = entry.queries()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


@pytest.fixture(scope="module")
def con():
    return duck_connection(SF)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    res = compare(spark, name, QUERIES[name], ORACLE[name], SF, con)
    assert res["ok"], res


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_rows_only_queries_run(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and df.columns[:3] == ["year", "nation", "o_orderkey"]


def test_every_inventory_op_is_covered_by_a_query():
    from tessera.plans import COVERS
    from tessera.plans import QUERIES as OWN

    assert set(COVERS) == set(OWN)
    covered = {op for ops in COVERS.values() for op in ops.split()}
    inventory = ({f"S{i}" for i in range(1, 13)} | {f"K{i}" for i in range(1, 7)}
                 | {f"P{i}" for i in range(1, 11)} - {"P5"}  # P5 is a no-op in the source
                 | {f"F{i}" for i in range(1, 11)} | {"J1", "J2", "J3"}
                 | {f"U{i}" for i in range(1, 5)} | {f"A{i}" for i in range(1, 6)}
                 | {f"M{i}" for i in range(1, 14)} | {"T1"})
    assert inventory - covered == set()
