"""The versioned table: failing, concurrent and partial writes, and what readers see."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tessera.sinks import ConcurrentCommit, NoTable, VersionedTable

SCHEMA = "id long, v string, year int, place string"
ROWS = [(1, "a", 2020, "a b"), (2, "b", 2020, "l'h/é%20x"), (3, None, 2021, None), (4, "d", None, ""), (5, "e", 2021, "a=b"), (5, "e", 2021, "a=b")]
BY = ["year", "place"]


def content(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture
def table(spark, tmp):
    return VersionedTable(spark, f"{tmp}/t")


def expected(rows):
    return sorted(((i, v, y, p or None) for i, v, y, p in rows), key=repr)      # an empty partition value is null, as in any such table


def test_overwrites_and_versions(spark, table):
    with pytest.raises(NoTable):
        table.read()
    df = spark.createDataFrame(ROWS, SCHEMA)
    assert table.overwrite(df, BY) == 1
    held = table.read()
    assert held.dtypes == df.dtypes and content(held) == expected(ROWS)
    assert table.overwrite(df.where("id = 1"), BY) == 2 and table.overwrite(df.where("id = 2"), BY) == 3
    assert content(table.read()) == expected(ROWS[1:2]) and content(table.read(2)) == expected(ROWS[:1])
    assert content(held) == expected(ROWS)                                      # an open reader keeps its version
    assert len(table.unreferenced(keep=1)) == 2 and table.unreferenced(keep=3) == []
    assert table.overwrite(df.limit(0), BY) == 4 and table.read().isEmpty() and table.read().dtypes == df.dtypes


def test_a_failed_overwrite_never_shows(spark, table):
    df = spark.createDataFrame(ROWS, SCHEMA)
    table.overwrite(df, BY)
    broken = df.withColumn("v", F.when(F.col("id") < 5, F.col("v")).otherwise(F.raise_error(F.lit("x"))))
    for write in (lambda: table.overwrite(broken, BY), lambda: table.replace_partitions(broken)):
        with pytest.raises(PySparkException):
            write()
    assert table.latest() == 1 and content(table.read()) == expected(ROWS)


def test_replaced_partitions(spark, table):
    df = spark.createDataFrame(ROWS, SCHEMA)
    table.overwrite(df, BY)
    new = spark.createDataFrame([(9, "z", 2021, "a=b"), (8, "y", 2030, "new"), (7, "x", None, "")], SCHEMA)
    assert table.replace_partitions(new) == 2
    assert content(table.read()) == expected(ROWS[:3] + [(9, "z", 2021, "a=b"), (8, "y", 2030, "new"), (7, "x", None, "")])
    plan = table.read().where("year = 2030")
    assert plan.count() == 1
    with pytest.raises(ValueError):
        table.replace_partitions(new.drop("v"))


def test_concurrent_writers(spark, table):
    df = spark.createDataFrame(ROWS, SCHEMA)
    base = table.overwrite(df, BY)
    other = lambda y, p, i: spark.createDataFrame([(i, "new", y, p)], SCHEMA)
    assert table.replace_partitions(other(2020, "a b", 10), base) == 2
    assert table.replace_partitions(other(2021, "a=b", 11), base) == 3           # another partition: put on top
    with pytest.raises(ConcurrentCommit):
        table.replace_partitions(other(2020, "a b", 12), base)                   # the same one
    with pytest.raises(ConcurrentCommit):
        table.overwrite(df, BY, base)
    ids = {r.id for r in table.read().collect()}
    assert {10, 11} <= ids and 12 not in ids


def test_a_number_is_taken_once(spark, table):
    """Two writers at the very same commit: one gets the number, whichever looks first."""
    table.overwrite(spark.createDataFrame(ROWS, SCHEMA), BY)
    record = {**table.commit(), "version": 2}
    assert table._publish(record) and not table._publish({**record, "partitions": {}})
    assert table.commit(2)["partitions"] and table.versions() == [1, 2]
    fs, claim = table._fs(table._path(3) + ".claim")
    fs.create(claim, False).close()                                              # a writer that has claimed, or died
    with pytest.raises(ConcurrentCommit):
        table.overwrite(spark.createDataFrame(ROWS, SCHEMA), BY)
    table.release(3)
    assert table.overwrite(spark.createDataFrame(ROWS, SCHEMA), BY) == 3
