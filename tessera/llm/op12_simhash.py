"""SimHash near duplicates: a byte-position inverted index with count filtering.

Fingerprints that differ in at most three bits agree in at least five of their eight bytes,
each at its position.  The index's postings are therefore the sets of five positional bytes
of every different fingerprint: two fingerprints meet under an entry exactly if their tally
of shared positional bytes reaches that guaranteed minimum, and no pair below it is ever
made.  Pairs that meet are verified bit by bit where they meet, and an entry hands on
joining edges only, fewer than it has fingerprints.  Five of eight bytes being fixed, an
entry has at most 2**24 fingerprints (128 MB), whatever the table's size."""

from __future__ import annotations

from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import read_table

from .base import WORD_BYTES, by_bucket, components, give_back, map_batches, mix, ragged, slices, small, stored

WIDTH = 3                    # words a shingle
BITS = 3                     # bits in which linked fingerprints may differ
SEED = 42                    # of XXH64
BUCKET_ROWS = 1_000_000      # postings a bucket should hold
PAIRWISE = 4096              # fingerprints of an entry compared pair by pair; more are looked up neighbour by neighbour
CHUNK = 1 << 16              # shingles whose bits are counted at once


def shingle_hashes(text: str, width: int = WIDTH):
    """XXH64 of all shingles of a text, in bounded portions (a text of fewer words: one shingle)."""
    carry, made = [], False
    for part in slices(text):
        words = carry + WORD_BYTES.findall(part.encode("utf-8", "surrogatepass").lower())
        n = len(words) - width + 1
        if n > 0:
            made = True
            at = [0, *accumulate(len(w) + 1 for w in words)]
            line = b" ".join(words)
            for i in range(0, n, CHUNK):
                yield np.fromiter((xxhash.xxh64_intdigest(line[a:b - 1], SEED)
                                   for a, b in zip(at[i:min(i + CHUNK, n)], at[i + width:])), np.uint64)
        carry = words[-(width - 1):] if width > 1 else []
    if carry and not made:
        yield np.array([xxhash.xxh64_intdigest(b" ".join(carry), SEED)], np.uint64)


def fingerprint(text: str | None, width: int = WIDTH) -> int:
    """The bits set in over half of the shingles' hashes; zero without words."""
    counts, n = np.zeros(64, np.int64), 0
    for h in shingle_hashes(text or "", width):
        bits = np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
        n += len(h)
    return sum(1 << int(j) for j in np.flatnonzero(2 * counts > n))


def fingerprints(docs: DataFrame, width: int = WIDTH, carry: tuple = ("doc_id",)) -> DataFrame:
    """``carry`` and fp, the fingerprint as a signed 64-bit number, of every row."""
    types = "".join(f"`{c}` {docs.schema[c].dataType.simpleString()}, " for c in carry)

    def run(batch):
        fp = np.array([fingerprint(t, width) for t in batch.column("text").to_pylist()], np.uint64)
        return {**{c: batch.column(c) for c in carry}, "fp": fp.view(np.int64)}

    return map_batches(docs.select(*carry, "text"), f"{types}fp bigint", run)


def entries(bits: int) -> np.ndarray:
    """Masks of all sets of positional bytes that linked fingerprints may have in common."""
    if not 0 <= bits <= 3:
        raise ValueError("fingerprints may differ in at most 3 bits")
    return np.array([sum(0xFF << 8 * p for p in use) for use in combinations(range(8), 8 - bits)], np.uint64)


def tags(fp: np.ndarray, entry: np.ndarray, masks: np.ndarray) -> np.ndarray:
    """64-bit name of (entry, its bytes)."""
    with np.errstate(over="ignore"):
        return mix((fp & masks[entry]) + mix(entry.astype(np.uint64) + np.uint64(1)))


class Joined:
    """Vertices 0..n-1 joined by edges given in bulk: every vertex knows its component's smallest."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            x, y = self.root[a], self.root[b]
            apart = x != y
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            np.minimum.at(self.root, np.maximum(x, y), np.minimum(x, y))
            while True:
                up = self.root[self.root]
                if np.array_equal(up, self.root):
                    break
                self.root = up


def pairwise(fp: np.ndarray, ends: np.ndarray, joined: Joined, bits: int) -> None:
    """Join what links within groups of neighbours: ``ends[i]`` is the end of row i's group."""
    at = np.arange(len(fp))
    lag = 1
    while True:
        at = at[at + lag < ends[at]]
        if not len(at):
            return
        new = at[joined.root[at] != joined.root[at + lag]]
        new = new[np.bitwise_count(fp[new] ^ fp[new + lag]) <= bits]
        joined.join(new, new + lag)
        lag += 1


def looked_up(fp: np.ndarray, begin: int, free: int, joined: Joined, bits: int) -> None:
    """The same for one sorted group, in time linear in its size: every fingerprint's
    neighbours, which differ in ``bits`` of the ``free`` bits only, are looked up."""
    places = [1 << j for j in range(64) if free >> j & 1]
    for n in range(1, bits + 1):
        for use in combinations(places, n):
            other = fp ^ np.uint64(sum(use))
            low = np.flatnonzero(other > fp)
            at = np.searchsorted(fp, other[low])
            hit = at < len(fp)
            hit[hit] = fp[at[hit]] == other[low[hit]]
            joined.join(begin + low[hit], begin + at[hit])


def links(fps: DataFrame, bits: int, total: int) -> DataFrame:
    """(a, b): edges between different fingerprints that join all linked ones, stored.
    ``fps`` has every different fingerprint (fp) once, ``total`` of them."""
    masks = entries(bits)
    buckets = int(max(8, total * len(masks) // BUCKET_ROWS + 1))

    def send(batches):
        for batch in batches:
            fp = np.repeat(batch.column("fp").to_numpy().view(np.uint64), len(masks))
            entry = np.tile(np.arange(len(masks), dtype=np.uint8), batch.num_rows)
            order, spans = by_bucket(tags(fp, entry, masks), buckets)
            fp, entry = fp[order], entry[order]
            rows = [(p, fp[a:b].tobytes(), entry[a:b].tobytes()) for p, a, b in spans]
            p, f, e = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(p, pa.int32()), pa.array(f, pa.binary()), pa.array(e, pa.binary())],
                                             names=["bucket", "fps", "entries"])
        give_back()

    def meet(table: pa.Table) -> pa.Table:
        fp = np.frombuffer(b"".join(table.column("fps").to_pylist()), np.uint64)
        entry = np.frombuffer(b"".join(table.column("entries").to_pylist()), np.uint8)
        tag = tags(fp, entry, masks)
        order = np.lexsort((fp, tag))
        fp, entry, tag = fp[order], entry[order], tag[order]
        begins = np.flatnonzero(np.concatenate(([True], tag[1:] != tag[:-1]))) if len(tag) else np.zeros(0, np.int64)
        sizes = np.diff(np.concatenate((begins, [len(tag)])))
        meets = sizes > 1
        at = ragged(begins[meets], sizes[meets])
        fp, entry, sizes = fp[at], entry[at], sizes[meets]
        ends = np.cumsum(sizes)
        joined = Joined(len(fp))
        few = np.repeat(sizes <= PAIRWISE, sizes)
        pairwise(fp, np.where(few, np.repeat(ends, sizes), 0), joined, bits)
        for size, end in zip(sizes[sizes > PAIRWISE].tolist(), ends[sizes > PAIRWISE].tolist()):
            begin = end - size
            free = ~int(masks[entry[begin]]) & (1 << 64) - 1
            looked_up(fp[begin:end], begin, free, joined, bits)
        tied = np.flatnonzero(joined.root != np.arange(len(fp)))
        edge = np.unique(np.stack((fp[tied], fp[joined.root[tied]]), axis=1), axis=0).view(np.int64) \
            if len(tied) else np.zeros((0, 2), np.int64)
        give_back()
        return pa.table({"a": pa.array(edge[:, 0].copy()), "b": pa.array(edge[:, 1].copy())})

    postings = fps.select("fp").mapInArrow(send, "bucket int, fps binary, entries binary")
    return stored(postings.groupBy("bucket").applyInArrow(meet, "a bigint, b bigint").distinct(), "fingerprint-links")


def link_groups(docs: DataFrame, width: int = WIDTH, bits: int = BITS) -> DataFrame:
    """doc_id, fp (signed) and component_id of every row of ``docs``.

    Null, empty and white-space texts have fingerprint zero and link like any other; a text
    of any length is hashed in portions.  Equal fingerprints (and so repeated rows) are one
    vertex.  component_id is the smallest non-null doc_id reachable; rows that share a
    doc_id are separate rows, and a row without one that reaches none has none.  Columns
    other than doc_id and text are not looked at."""
    rows = stored(fingerprints(docs, width), "fingerprints")
    fps = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("low"), F.count("*").alias("n")), "different")
    edges = links(fps, bits, fps.count())
    ends = edges.select(F.col("a").alias("v")).unionByName(edges.select(F.col("b").alias("v"))).distinct()
    joined = stored(components(ends, edges).select(F.col("v").alias("fp"), "component"), "joined")
    members = fps.join(small(joined), "fp", "left").where("n > 1 or component is not null") \
        .withColumn("component", F.coalesce("component", "fp"))
    members = stored(members, "members")
    least = small(stored(members.groupBy("component").agg(F.min("low").alias("component_id")), "least"))
    names = small(stored(members.join(least, "component").select("fp", "component_id"), "names"))
    return rows.join(names, "fp", "left").select("doc_id", "fp", F.coalesce("component_id", "doc_id").alias("component_id"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    linked = link_groups(read_table(spark, sf_dir, "documents"))
    return linked.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
