"""What executors and their Python workers hold at once: bounded batches, pieces and kept state."""

import random

import pyarrow as pa
import pytest
from pyspark.sql.types import StructType

from tessera.llm import base, op4_pii, op9_packing


class Handed:
    """Stands for a DataFrame and returns the function that a worker would run."""

    def __init__(self, schema):
        self.schema = StructType.fromDDL(schema)
        self.columns = self.schema.names

    def select(self, *names):
        return self

    def mapInArrow(self, run, schema):
        return run


@pytest.fixture(autouse=True)
def nothing_kept():
    yield
    base.kept()


def test_full_pool_forgets_only_what_no_later_text_met(monkeypatch):
    from tokenizers import Tokenizer

    monkeypatch.setattr(op9_packing, "CACHE_WORDS", 60)
    pieces = op9_packing.PieceIds(op9_packing.vocabulary_path())
    whole, rng, learned = Tokenizer.from_file(op9_packing.vocabulary_path()), random.Random(3), []
    learn = pieces.learn
    monkeypatch.setattr(pieces, "learn", lambda new: (learned.extend(new), learn(new)))
    for _ in range(40):
        text = " ".join(["river", "stone", "3.14!"] + ["".join(rng.choices("bcdfgklmnprst", k=9)) for _ in range(20)] + ["river"])
        assert pieces.ids(text).tolist() == whole.encode(text, add_special_tokens=False).ids
        assert len(pieces.code) == len(pieces.start) == len(pieces.length) == len(pieces.again) <= 60 + 23
        assert len(pieces.pool) == sum(pieces.length)
    assert all(learned.count(p) == 1 for p in ("river", "stone", "3.14!"))


def test_full_pool_of_pieces_met_again_starts_anew(monkeypatch):
    monkeypatch.setattr(op9_packing, "CACHE_WORDS", 4)
    pieces = op9_packing.PieceIds(op9_packing.vocabulary_path())
    text = "one two three four five six"
    first = pieces.ids(text).tolist()
    for other in (text, "seven", "", text, text):
        ids = pieces.ids(other).tolist()
        assert other != text or ids == first
        assert len(pieces.code) <= 4 + 6
    assert pieces.ids("").tolist() == []


def test_pack_hands_workers_small_batches(spark, monkeypatch):
    def tokenize(docs, *options):
        def run(batches):
            n = 0
            for b in batches:
                yield pa.RecordBatch.from_pylist([{"doc_id": i, "piece": 0, "start": b.num_rows, "length": 1, "ids_crc32": 0,
                                                   "part": 0, "local": n + i} for i in range(b.num_rows)])
                n += b.num_rows
        schema = "doc_id bigint, piece bigint, start bigint, length bigint, ids_crc32 bigint, part bigint, local bigint"
        return docs.mapInArrow(run, schema)

    monkeypatch.setattr(op9_packing, "tokenize", tokenize)
    before = spark.conf.get(base.BATCH_ROWS)
    docs = spark.range(0, 4500, 1, 1).selectExpr("id doc_id", "'x' text")
    rows = op9_packing.pack(docs).collect()
    assert len(rows) == 4500 and max(r.start for r in rows) <= 1000
    assert spark.conf.get(base.BATCH_ROWS) == before
    try:
        spark.conf.set(base.BATCH_ROWS, "300")          # a lower limit stays
        assert max(r.start for r in op9_packing.pack(docs).collect()) <= 300
        assert spark.conf.get(base.BATCH_ROWS) == "300"
    finally:
        spark.conf.set(base.BATCH_ROWS, before)


def test_redact_works_on_parts_of_a_batch():
    texts = [None if i % 7 == 0 else f"mail a{i}@b.org now" for i in range(1201)]
    run = op4_pii.redact(Handed("doc_id long, text string, n_chars long"))
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array(range(1201), pa.int64()), "text": pa.array(texts),
                                        "n_chars": pa.array([len(t or "") for t in texts], pa.int64())})
    out = list(run(iter([batch, batch.slice(0, 0), batch.slice(0, 1)])))
    assert max(b.num_rows for b in out) <= op4_pii.PART_ROWS
    rows = [r for b in out for r in b.to_pylist()]
    assert [r["doc_id"] for r in rows] == [*range(1201), 0]
    assert [r["text"] for r in rows] == [t and "mail [EMAIL] now" for t in texts] + [None]
    assert [r["n_chars"] for r in rows] == [16 if t else 0 for t in texts] + [0]


def test_a_worker_keeps_one_operators_state():
    base.kept("language")["cache"] = "words"
    run = base.map_batches(Handed("n long"), "n long", lambda b: {"n": b.column("n")}, owner="language")
    batch = pa.RecordBatch.from_pydict({"n": pa.array([1, 2], pa.int64())})
    assert list(run(iter([batch]))) == [batch] and base.kept("language") == {"cache": "words"}
    run = base.map_batches(Handed("n long"), "n long", lambda b: {"n": b.column("n")})
    list(run(iter([batch])))
    assert base.kept("language") == {}
    base.kept("language")["cache"] = "words"
    op9_packing.piece_ids(op9_packing.vocabulary_path())
    assert base.kept("language") == {}
