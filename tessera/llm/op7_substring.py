"""Substring dedup: words covered by a run of ``WIDTH`` words that also starts elsewhere.

Two ways, of which the query takes the second and only the first uses suffix automata:

* ``strip_reference`` is for a given reference table: automata of its shards are broadcast,
  documents stream past them, and maximal spans by matching statistics go.
* ``repeats`` is for a table against itself.  Streaming every document past automata of the
  whole table would cost documents times shards; so places that can repeat are found first
  (winnowed anchors, then the windows around repeated anchors, both counted by hash), and
  only texts with such places go on."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import read_table

from .base import WORD_RE, by_bucket, hash_words, map_batches, small, stored, text_of, window_hashes

WIDTH = 35                   # words a window
GRAM = 8                     # words an anchor
BUCKET_ROWS = 1_500_000
PORTION = 4_000_000          # characters of texts handled at once


def first_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Position of the leftmost minimum of every run of ``width`` values."""
    n = len(values) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    best, at, span = values, np.arange(len(values)), 1
    while span < width:              # runs of twice the length, then an overlap for the rest
        step = min(span, width - span)
        left, right = best[:-step], best[step:]
        take = right < left
        at = np.where(take, at[step:], at[:-step])
        best = np.where(take, right, left)
        span += step
    return at[:n]


def anchors_of(words: np.ndarray, width: int, gram: int):
    """(gram hashes, anchor position of every window): equal windows have equal anchors at equal places."""
    grams = window_hashes(words, gram)
    return grams, first_minimum(grams, width - gram + 1)


def portions(texts: list, chars: int = PORTION):
    begin, held = 0, 0
    for i, t in enumerate(texts):
        held += len(t or "")
        if held >= chars:
            yield begin, i + 1
            begin, held = i + 1, 0
    if begin < len(texts):
        yield begin, len(texts)


def repeated_places(rows: DataFrame, places, buckets: int, name: str, runs: bool = False) -> DataFrame:
    """(key, at): for each text key the places whose value occurs at least twice in all rows, stored;
    with ``runs`` as first and last place of each run of consecutive ones.

    ``places(batch, i, j)`` gives (values, row, place) of rows i to j of an Arrow batch.  Values
    that repeat within a portion are reported on the spot, and each value is sent to its bucket
    once a portion: a value that a third of all texts hold costs its bucket one entry a portion."""
    def send(batches):
        home = TaskContext.get().partitionId() << 32
        for batch in batches:
            keys = batch.column("key").to_pylist()
            for i, j in portions(batch.column("text").to_pylist()):
                value, row, at = places(batch, i, j)
                order = np.argsort(value, kind="stable")
                value, row, at = value[order], row[order], at[order]
                first = np.concatenate(([True], value[1:] != value[:-1])) if len(value) else np.zeros(0, bool)
                times = np.bincount(np.cumsum(first) - 1)[np.cumsum(first) - 1] if len(value) else np.zeros(0, int)
                known = times > 1
                out = [(-1, home, b"", row[known].tobytes(), at[known].tobytes(), keys[i:j])]
                v, r, p = value[first], row[first], at[first]
                order, spans = by_bucket(v, buckets)
                out += [(b, home, v[order[x:y]].tobytes(), r[order[x:y]].tobytes(), p[order[x:y]].tobytes(), None)
                        for b, x, y in spans]
                cols = list(zip(*out))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.binary()),
                     pa.array(cols[3], pa.binary()), pa.array(cols[4], pa.binary()), pa.array(cols[5], pa.list_(pa.string()))],
                    names=["bucket", "home", "vals", "doc", "at", "keys"])
                home += 1

    schema = "bucket int, home bigint, vals binary, doc binary, at binary, keys array<string>"
    sent = rows.select("key", *[c for c in rows.columns if c != "key"]).mapInArrow(send, schema)
    sent = sent.withColumn("own", F.when(F.col("bucket") < 0, F.col("home")).otherwise(F.lit(0)))

    def meet(table: pa.Table) -> pa.Table:
        if table.column("bucket")[0].as_py() < 0:
            return table.select(["home", "doc", "at", "keys"])
        blocks = [np.frombuffer(v, np.uint64) for v in table.column("vals").to_pylist()]
        value = np.concatenate(blocks)
        order = np.argsort(value, kind="stable")
        new = np.concatenate(([True], value[order][1:] != value[order][:-1]))
        group = np.cumsum(new) - 1
        twice = np.empty(len(value), bool)
        twice[order] = np.bincount(group)[group] > 1
        homes, docs, ats, edge = [], [], [], 0
        for block, home, doc, at in zip(blocks, table.column("home").to_pylist(), table.column("doc").to_pylist(), table.column("at").to_pylist()):
            keep = twice[edge:edge + len(block)]
            edge += len(block)
            if keep.any():
                homes.append(home)
                docs.append(np.frombuffer(doc, np.int32)[keep].tobytes())
                ats.append(np.frombuffer(at, np.int32)[keep].tobytes())
        return pa.table([pa.array(homes, pa.int64()), pa.array(docs, pa.binary()), pa.array(ats, pa.binary()),
                         pa.array([None] * len(homes), pa.list_(pa.string()))], names=["home", "doc", "at", "keys"])

    met = sent.groupBy("bucket", "own").applyInArrow(meet, "home bigint, doc binary, at binary, keys array<string>")

    def gather(table: pa.Table) -> pa.Table:
        keys = next(k for k in table.column("keys").to_pylist() if k is not None)
        doc = np.frombuffer(b"".join(table.column("doc").to_pylist()), np.int32)
        at = np.frombuffer(b"".join(table.column("at").to_pylist()), np.int32)
        order = np.lexsort((at, doc))
        doc, at = doc[order], at[order]
        have = np.unique(doc)
        cut = np.searchsorted(doc, have)
        found = {}
        for d, part in zip(have.tolist(), np.split(at, cut[1:])):
            if runs:
                cuts = np.flatnonzero(np.diff(part) > 1)
                part = np.stack((part[np.concatenate(([0], cuts + 1))], part[np.concatenate((cuts, [-1]))]), 1)
            found.setdefault(keys[d], part.tobytes())       # equal texts have equal places
        return pa.table({"key": pa.array(list(found), pa.string()), "at": pa.array(list(found.values()), pa.binary())})

    return stored(met.groupBy("home").applyInArrow(gather, "key string, at binary").dropDuplicates(["key"]), name)


def keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with ``key``, a 128-bit digest of the text: equal texts share their places."""
    text = text_of()
    return docs.withColumn("text", text).withColumn("key", F.md5(text.cast("binary")))


def repeats(docs: DataFrame, width: int = WIDTH, gram: int = GRAM) -> DataFrame:
    """(key, at): for each text (by its key, see ``keyed``) the starts of its windows of
    ``width`` words whose words also start a window elsewhere, in the same text or another
    row; as runs, the first and last start of each, in 32-bit numbers.  Stored.

    Windows are compared by 64-bit hash.  Places with a repeated anchor are the only ones that
    can repeat, and the windows there are counted over all rows.  Equal rows repeat each other."""
    rows = keyed(docs.select("text"))
    chars = int(rows.agg(F.sum(F.length("text"))).first()[0] or 0)

    def anchors(batch, i, j):
        words, sizes = hash_words(batch.column("text").slice(i, j - i).to_pylist())
        out, edge = [], 0
        for r, n in enumerate(sizes.tolist()):
            w = words[edge:edge + n]
            edge += n
            if n >= width:
                grams, at = anchors_of(w, width, gram)
                at = np.unique(at)
                out.append((grams[at], np.full(len(at), r, np.int32), at.astype(np.int32)))
        return tuple(np.concatenate(x) for x in zip(*out)) if out else \
            (np.zeros(0, np.uint64), np.zeros(0, np.int32), np.zeros(0, np.int32))

    likely = repeated_places(rows, anchors, max(8, chars // 80 // BUCKET_ROWS + 1), "anchors")

    def windows(batch, i, j):
        words, sizes = hash_words(batch.column("text").slice(i, j - i).to_pylist())
        out, edge = [], 0
        for r, (n, at) in enumerate(zip(sizes.tolist(), batch.column("at").slice(i, j - i).to_pylist())):
            w = words[edge:edge + n]
            edge += n
            _, anchor = anchors_of(w, width, gram)
            start = np.flatnonzero(np.isin(anchor, np.frombuffer(at, np.int32)))
            out.append((window_hashes(w, width)[start], np.full(len(start), r, np.int32), start.astype(np.int32)))
        return tuple(np.concatenate(x) for x in zip(*out)) if out else \
            (np.zeros(0, np.uint64), np.zeros(0, np.int32), np.zeros(0, np.int32))

    some = rows.join(small(likely), "key")
    return repeated_places(some.select("key", "text", "at"), windows, max(8, chars // 40 // BUCKET_ROWS + 1), "windows", runs=True)


def covered(n: int, first: np.ndarray, last: np.ndarray, width: int) -> np.ndarray:
    """Mask of the words inside any window that starts from ``first`` to ``last``, run by run."""
    steps = np.zeros(n + 1, np.int32)
    np.add.at(steps, first, 1)
    np.add.at(steps, last + width, -1)
    return np.cumsum(steps[:-1]) > 0


def strip(docs: DataFrame, width: int = WIDTH, gram: int = GRAM) -> DataFrame:
    """doc_id, text (the kept words, joined by one space), n_words, n_removed for every row.

    Words of a window that also starts elsewhere go; all windows are judged on the input.
    Null, empty and shorter texts keep all their words.  Equal rows of ``width`` words and
    more repeat each other, so both lose every word."""
    found = repeats(docs, width, gram)
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batch):
        texts, n, removed = [], [], []
        for text, at in zip(batch.column("text").to_pylist(), batch.column("at").to_pylist()):
            words = WORD_RE.findall(text)
            n.append(len(words))
            if at:
                first, last = np.frombuffer(at, np.int32).astype(np.int64).reshape(-1, 2).T
                gone = covered(len(words), first, last, width)
                words = [w for w, g in zip(words, gone.tolist()) if not g]
            removed.append(n[-1] - len(words))
            texts.append(" ".join(words))
        return {"doc_id": batch.column("doc_id"), "text": texts, "n_words": n, "n_removed": removed}

    joined = keyed(docs.select("doc_id", "text")).join(small(found), "key", "left").select("doc_id", "text", "at")
    return map_batches(joined, f"doc_id {id_type}, text string, n_words bigint, n_removed bigint", run)


class SuffixAutomaton:
    """Suffix automaton of one sequence of word hashes (texts are parted by unique marks)."""

    def __init__(self, words):
        self.next, self.link, self.length = [{}], [-1], [0]
        last = 0
        for w in words:
            cur = len(self.next)
            self.next.append({})
            self.length.append(self.length[last] + 1)
            self.link.append(0)
            p = last
            while p >= 0 and w not in self.next[p]:
                self.next[p][w] = cur
                p = self.link[p]
            if p >= 0:
                q = self.next[p][w]
                if self.length[q] != self.length[p] + 1:
                    clone = len(self.next)
                    self.next.append(dict(self.next[q]))
                    self.length.append(self.length[p] + 1)
                    self.link.append(self.link[q])
                    while p >= 0 and self.next[p].get(w) == q:
                        self.next[p][w] = clone
                        p = self.link[p]
                    self.link[q] = clone
                    q = clone
                self.link[cur] = q
            last = cur

    def statistics(self, words) -> list:
        """For every word the length of the longest run ending there that the reference holds."""
        state = length = 0
        out = []
        for w in words:
            while state and w not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            state = self.next[state].get(w, 0)
            length = length + 1 if state else 0
            out.append(length)
        return out


def strip_reference(docs: DataFrame, reference: DataFrame, width: int = WIDTH, shard_words: int = 200_000) -> DataFrame:
    """doc_id, text, n_words, n_removed: ``docs`` without maximal spans of at least ``width``
    words that the ``reference`` texts hold.

    The reference, a table bounded by its nature (a benchmark), is cut into shards of about
    ``shard_words`` words.  Each shard's words are broadcast in turn, its automaton is built
    once a task, and documents stream past it; spans found so far travel with the text."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, text string, gone binary"
    now = keyed(docs.select("doc_id", "text")).select("doc_id", "text", F.lit(None).cast("binary").alias("gone"))
    shard, held = [], 0
    for r in [*reference.select("text").where("text is not null").toLocalIterator(), None]:
        if r is not None:
            words = hash_words([r.text])[0].tolist()
            shard.append(words)
            held += len(words)
        if shard and (r is None or held >= shard_words):
            now = stored(past_shard(now, docs.sparkSession.sparkContext.broadcast(shard), width, schema), "stripped")
            shard, held = [], 0

    def finish(batch):
        texts, n, removed = [], [], []
        for text, gone in zip(batch.column("text").to_pylist(), batch.column("gone").to_pylist()):
            words = WORD_RE.findall(text)
            mask = np.frombuffer(gone, bool) if gone is not None else np.zeros(len(words), bool)
            kept = [w for w, g in zip(words, mask.tolist()) if not g]
            texts.append(" ".join(kept))
            n.append(len(words))
            removed.append(len(words) - len(kept))
        return {"doc_id": batch.column("doc_id"), "text": texts, "n_words": n, "n_removed": removed}

    return map_batches(now, f"doc_id {id_type}, text string, n_words bigint, n_removed bigint", finish)


def past_shard(rows: DataFrame, shard, width: int, schema: str) -> DataFrame:
    def run(batches):
        flat = []
        for i, words in enumerate(shard.value):
            flat += [*words, -1 - i]
        automaton = SuffixAutomaton(flat)
        for batch in batches:
            out = []
            for text, gone in zip(batch.column("text").to_pylist(), batch.column("gone").to_pylist()):
                words = hash_words([text])[0].tolist()
                ends = np.flatnonzero(np.array(automaton.statistics(words), np.int64) >= width)
                mask = np.frombuffer(gone, bool) if gone is not None else np.zeros(len(words), bool)
                out.append((mask | covered(len(words), ends - width + 1, ends - width + 1, width)).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text"), pa.array(out, pa.binary())],
                                             names=["doc_id", "text", "gone"])

    return rows.mapInArrow(run, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = strip(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))
