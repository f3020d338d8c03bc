import json
import os

import pytest
from pyspark.sql.types import LongType, StringType, StructType

from tessera.streaming import ingest_available, keyed_merge, latest, unreferenced

SCHEMA = StructType().add("k", StringType()).add("d", LongType()).add("v", StringType())


def test_incremental_ingest_last_snapshot_wins(spark, tmp):
    src, tgt, ck = (os.path.join(tmp, p) for p in ("src", "tgt", "ck"))
    spark.createDataFrame([("a", 1, "a1"), ("b", 1, "b1")], SCHEMA).write.mode("append").json(src)
    out = ingest_available(spark, src, tgt, ck, SCHEMA, ["k"], ["-d"])
    assert {r.k: r.v for r in out.collect()} == {"a": "a1", "b": "b1"}
    spark.createDataFrame([("a", 2, "a2"), ("c", 2, "c2"), ("b", 0, "old")], SCHEMA) \
        .write.mode("append").json(src)
    out = ingest_available(spark, src, tgt, ck, SCHEMA, ["k"], ["-d"])
    assert {r.k: r.v for r in out.collect()} == {"a": "a2", "b": "b1", "c": "c2"}
    # nothing new: the table stays as it is
    out = ingest_available(spark, src, tgt, ck, SCHEMA, ["k"], ["-d"])
    assert out.count() == 3


def _merge(tmp, name="ck", **options):
    ck = os.path.join(tmp, name)
    os.makedirs(ck, exist_ok=True)
    with open(os.path.join(ck, "metadata"), "w") as f:
        json.dump({"id": f"stream-{name}"}, f)
    tgt = os.path.join(tmp, "tgt")
    return tgt, keyed_merge(tgt, ck, ["k"], ["-d"], buckets=4, **options)


def _rows(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def _state(df):
    return {r.k: r.v for r in df.collect()}


def test_merge_replay_is_idempotent(spark, tmp):
    tgt, merge = _merge(tmp)
    merge(_rows(spark, ("a", 1, "a1")), 0)
    b1 = _rows(spark, ("a", 2, "a2"), ("b", 1, "b1"))
    merge(b1, 1)
    merge(b1, 1)  # replay of the same batch
    merge(_rows(spark, ("b", 5, "b5"), (None, 1, "n")), 2)
    merge(_rows(spark), 3)  # an empty batch makes no version
    assert _state(latest(spark, tgt)) == {"a": "a2", "b": "b5", None: "n"}
    assert sorted(os.listdir(os.path.join(tgt, "commits"))) == ["v00000001", "v00000002", "v00000003"]


def test_new_checkpoint_on_an_old_target_keeps_its_rows(spark, tmp):
    src, tgt = os.path.join(tmp, "src"), os.path.join(tmp, "tgt")
    _rows(spark, ("a", 1, "a1"), ("b", 1, "b1"), ("c", 1, "c1")).write.json(src)
    ingest_available(spark, src, tgt, os.path.join(tmp, "ck1"), SCHEMA, ["k"], ["-d"])
    other = os.path.join(tmp, "other")
    for row, expected in ((("z", 1, "z1"), "abcz"), (("y", 1, "y1"), "abcyz")):
        _rows(spark, row).write.mode("append").json(other)
        out = ingest_available(spark, other, tgt, os.path.join(tmp, "ck2"), SCHEMA, ["k"], ["-d"])
        assert "".join(sorted(_state(out))) == expected


def test_half_written_version_is_not_seen_and_can_be_replayed(spark, tmp):
    tgt, merge = _merge(tmp)
    merge(_rows(spark, ("a", 1, "a1")), 0)
    _rows(spark, ("x", 9, "x9")).write.parquet(os.path.join(tgt, "data", "v00000002-half", "_bucket=0"))
    os.makedirs(os.path.join(tgt, "commits", "v00000002", "_temporary"))  # stopped while committing
    assert _state(latest(spark, tgt)) == {"a": "a1"}
    merge(_rows(spark, ("b", 1, "b1")), 1)
    assert _state(latest(spark, tgt)) == {"a": "a1", "b": "b1"}


def test_held_frame_stays_readable_and_only_touched_buckets_are_written(spark, tmp):
    tgt, merge = _merge(tmp)
    merge(_rows(spark, *((f"k{i}", 1, "old") for i in range(40))), 0)
    held = latest(spark, tgt)
    for n in range(1, 4):
        merge(_rows(spark, ("k0", 1 + n, f"new{n}")), n)
    assert set(_state(held).values()) == {"old"} and held.count() == 40
    assert _state(latest(spark, tgt))["k0"] == "new3" and latest(spark, tgt).count() == 40
    last = max(os.listdir(os.path.join(tgt, "data")))
    assert len([d for d in os.listdir(os.path.join(tgt, "data", last)) if d.startswith("_bucket=")]) == 1
    # the first folder still serves the other buckets; only version 2 is out of use
    assert [os.path.basename(p)[:9] for p in unreferenced(spark, tgt)] == ["v00000002"]


def test_damaged_commit_is_an_error(spark, tmp):
    tgt, merge = _merge(tmp)
    merge(_rows(spark, ("a", 1, "a1")), 0)
    with open(os.path.join(tgt, "commits", "v00000001", "part-bad.parquet"), "wb") as f:
        f.write(b"not parquet")
    with pytest.raises(Exception):
        merge(_rows(spark, ("b", 1, "b1")), 1)
