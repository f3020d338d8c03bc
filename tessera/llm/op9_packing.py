"""Best-fit packing of tokenized documents into fixed-length sequences."""

from __future__ import annotations

import re
import unicodedata
import zlib
from array import array
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.session import read_table

from .base import give_back, kept, ragged, slices, stored

CAPACITY = 4096
END = 1                      # the id that closes every document
VOCABULARY = "word_bpe_49k.json"
CACHE_WORDS = 500_000        # pieces a worker remembers before it forgets those met once
BATCH_ROWS = 1000            # documents a worker is handed at once

#: A leading run of Latin letters with an ASCII non-letter (or the end) behind it is one
#: pre-token of its own; whatever is left of a chunk between white space goes in whole.
PIECE = re.compile("[A-Za-zÀ-ÖØ-öø-įı-ſ]++(?=[\\x00-\\x40\\x5b-\\x60\\x7b-\\x7f]|$)"
                   "|[^ \\n\\t\\r]+")
CHUNK = re.compile("[^ \\n\\t\\r]+")


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class PieceIds:
    """Token ids of text pieces, remembered in one growing pool.

    Tokens never span white space, so a text's ids are those of its pieces in order;
    invented or rare words make up most encoder time.  Most of them never come again: a
    full pool keeps only what a later text has met, so it stays small."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        size = self.tokenizer.get_vocab_size()
        self.ends = np.array([(self.tokenizer.id_to_token(i) or "").endswith("</w>") for i in range(size)])
        self.clear()

    def clear(self):
        self.code, self.start, self.length, self.pool = {}, array("q"), array("q"), array("I")
        self.again = array("B")             # 1: a later text has met the piece

    def forget(self):
        """Drop the pieces that no later text has met, or all if most were met: the pool has
        to take up many new ones before it is full again."""
        met = np.flatnonzero(np.frombuffer(self.again, np.uint8))
        if 2 * len(met) > CACHE_WORDS:
            return self.clear()
        pieces = list(compress(self.code, self.again))          # a piece's code is its place
        lengths = np.frombuffer(self.length, np.int64)[met]
        ids = np.frombuffer(self.pool, np.uint32)[ragged(np.frombuffer(self.start, np.int64)[met], lengths)]
        self.clear()
        self.add(pieces, ids, lengths)

    def add(self, pieces: list, ids: np.ndarray, lengths: np.ndarray) -> None:
        """Remember pieces none of which is known, from all their ids in a row."""
        self.code.update(zip(pieces, range(len(self.start), len(self.start) + len(pieces))))
        self.start.frombytes((len(self.pool) + np.cumsum(lengths) - lengths).astype(np.int64).tobytes())
        self.length.frombytes(lengths.astype(np.int64).tobytes())
        self.pool.frombytes(ids.astype(np.uint32).tobytes())
        self.again.frombytes(bytes(len(pieces)))

    def learn(self, pieces: set) -> None:
        words = [p for p in pieces if p.isalpha() and p == p.lower() and PIECE.fullmatch(p)]
        for at in range(0, len(words), 512):
            part = words[at:at + 512]
            ids = np.array(self.tokenizer.encode(" ".join(part), add_special_tokens=False).ids, np.int64)
            cuts = np.flatnonzero(self.ends[ids]) + 1
            if len(cuts) == len(part):          # one word-end token for each word
                self.add(part, ids, np.diff(np.concatenate(([0], cuts[:-1], [len(ids)]))))
        rest = [p for p in pieces if p not in self.code]
        if rest:
            own = [e.ids for e in self.tokenizer.encode_batch(rest, add_special_tokens=False)]
            self.add(rest, np.array([i for ids in own for i in ids], np.uint32), np.array([len(ids) for ids in own]))

    def ids(self, text: str) -> np.ndarray:
        # lower case by letter is that of the whole piece, but for these two letters
        if "İ" not in text and "Σ" not in text and unicodedata.is_normalized("NFC", text):
            pieces = [p.lower() if p.isalpha() else p for p in PIECE.findall(text)]
        else:
            pieces = CHUNK.findall(text)
        if len(self.code) > CACHE_WORDS:
            self.forget()
        known = len(self.code)
        new = {p for p in set(pieces) if p not in self.code}
        if new:
            self.learn(new)
        codes = np.fromiter(map(self.code.__getitem__, pieces), np.int64, len(pieces))
        if known:
            np.frombuffer(self.again, np.uint8)[codes[codes < known]] = 1
        starts, lengths = np.frombuffer(self.start, np.int64)[codes] if len(codes) else codes, \
            np.frombuffer(self.length, np.int64)[codes] if len(codes) else codes
        pool = np.frombuffer(self.pool, np.uint32) if len(self.pool) else np.zeros(0, np.uint32)
        return pool[ragged(starts, lengths)]


def piece_ids(path: str) -> PieceIds:
    """The worker's encoder for a vocabulary file, kept between tasks."""
    held = kept("packing")
    if path not in held:
        held[path] = PieceIds(path)
    return held[path]


def tokenize(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32 (and ids), with the writing
    task (``part``) and the piece's rank among that task's pieces of its length.

    Null text is empty and gives the single closing id.  Only documents longer than
    ``capacity`` are cut.  Equal rows are documents of their own."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, piece int, start bigint, length bigint, ids_crc32 bigint, part int, local bigint"
    schema += ", ids array<int>" if with_ids else ""

    def run(batches):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encoder = piece_ids(path or vocabulary_path())
        part = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            rows, keep = [], []
            for i, text in enumerate(batch.column("text").to_pylist()):
                ids = [encoder.ids(s).astype("<u4") for s in slices(text or "")]
                ids = np.concatenate([*ids, np.array([END], "<u4")])
                for piece, at in enumerate(range(0, len(ids), capacity)):
                    own = ids[at:at + capacity]
                    rows.append((i, piece, at, len(own), zlib.crc32(own.tobytes()), seen[len(own)]))
                    seen[len(own)] += 1
                    if with_ids:
                        keep.append(own.astype(np.int32))
            cols = list(zip(*rows)) or [()] * 6
            own = [batch.column("doc_id").take(pa.array(cols[0], pa.int64())), pa.array(cols[1], pa.int32()),
                   pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.int64()), pa.array(cols[4], pa.int64()),
                   pa.array(np.full(len(rows), part), pa.int32()), pa.array(cols[5], pa.int64())]
            if with_ids:
                own.append(pa.array(keep, pa.list_(pa.int32())))
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "local"] + ["ids"] * with_ids
            yield pa.RecordBatch.from_arrays(own, names=names)
        give_back()

    return docs.select("doc_id", "text").mapInArrow(run, schema)


class Bins:
    """Bins as groups of equal fill: (first bin, how many, tokens used), by remaining gap."""

    def __init__(self, capacity: int):
        self.capacity, self.next = capacity, 0
        self.by_gap = [[] for _ in range(capacity + 1)]
        self.open = np.zeros(capacity + 1, bool)
        self.runs = []          # (length, first rank, last rank + 1, first bin, items a bin, offset)

    def keep(self, first, n, used):
        gap = self.capacity - used
        if n and gap:
            self.by_gap[gap].append((first, n, used))
            self.open[gap] = True

    def fill(self, length, rank, left, first, n, used, each):
        """Put up to ``each`` items into each of ``n`` equal bins; what is left of the items."""
        put = min(left, n * each)
        full, rest = divmod(put, each)
        self.runs.append((length, rank, rank + put, first, each, used))
        self.keep(first, full, used + each * length)
        if rest:
            self.keep(first + full, 1, used + rest * length)
        touched = full + bool(rest)
        self.keep(first + touched, n - touched, used)
        return put

    def best_fit(self, length, rank, left, most):
        """Fill the tightest gaps first, at most ``most`` items a bin."""
        for gap in (np.flatnonzero(self.open[length:]) + length).tolist():
            groups, self.by_gap[gap] = self.by_gap[gap], []
            self.open[gap] = False
            while groups and left:
                put = self.fill(length, rank, left, *groups.pop(), min(gap // length, most))
                rank, left = rank + put, left - put
            for g in groups:
                self.keep(*g)
            if not left:
                break
        return rank, left

    def open_new(self, length, rank, left, most):
        each = min(self.capacity // length, most)
        n = -(-left // each)
        self.next += n
        self.fill(length, rank, left, self.next - n, n, 0, each)


def plan(counts: dict, capacity: int = CAPACITY) -> np.ndarray:
    """Where the items of each length go, from the number of items of each length alone.

    Large items (above a third of the capacity) are matched first, the largest first and
    each with the tightest partner that still fits, so a bin holds two at most; a bin
    opened for items of one length starts with two of them if two fit.  The smaller ones
    then take the tightest remaining gap, largest first, and open bins only when none
    fits.  Work and result depend on the number of lengths, not of documents.

    A row (length, from, to, bin, each, offset) says: the item of rank r in [from, to)
    goes to bin + (r - from) // each, at offset + (r - from) % each * length."""
    bins = Bins(capacity)
    lengths = sorted(counts, reverse=True)
    for large in (True, False):
        for length in lengths:
            if (3 * length > capacity) == large:
                most = 2 if large else capacity
                rank, left = bins.best_fit(length, 0, counts[length], 1 if large else capacity)
                if left:
                    bins.open_new(length, rank, left, most)
    return np.array(sorted(bins.runs), np.int64).reshape(-1, 6)


def pack(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """``tokenize``'s pieces with sequence_id and offset; every sequence is gapless from 0.

    Pieces are written once with their rank in (task, length); task counts a length, summed
    along the tasks, turn it into a rank over all pieces without sorting any length's
    pieces together.  The driver sees one number for each length.  An empty table gives
    an empty result."""
    pieces = stored(tokenize(docs, path, capacity, with_ids), "pieces", batch_rows=BATCH_ROWS)
    per_task = stored(pieces.groupBy("length", "part").agg(F.count("*").alias("n")), "lengths")
    counts = {r.length: r.n for r in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    runs = plan(counts, capacity)
    ahead = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = per_task.select("length", "part", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("before"))
    ranked = pieces.join(before, ["length", "part"]).withColumn("rank", F.col("local") + F.col("before")) \
        .drop("part", "local", "before")
    names = [c for c in ranked.columns if c != "rank"]
    key = (runs[:, 0] << 44) | runs[:, 1]

    def place(batches):
        for b in batches:
            length, rank = b.column("length").to_numpy(), b.column("rank").to_numpy()
            r = runs[np.searchsorted(key, (length << 44) | rank, "right") - 1] if len(length) else runs[:0]
            at = rank - r[:, 1]
            yield pa.RecordBatch.from_arrays(
                [b.column(n) for n in names] + [pa.array(r[:, 3] + at // r[:, 4]), pa.array(r[:, 5] + at % r[:, 4] * length)],
                names=[*names, "sequence_id", "offset"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranked.schema.fields if f.name != "rank")
    return ranked.mapInArrow(place, schema + ", sequence_id bigint, offset bigint")


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences themselves, from ``pack(..., with_ids=True)``: sequence_id, ids."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
