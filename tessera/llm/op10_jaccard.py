"""N-gram Jaccard join: groups of hashed tokens, count vectors in an R-tree, exact verification.

A pair that is similar enough differs in few shingles.  Shingles are hashed into more
groups than two linked sets can differ in, so some group is the same in both: rows meet by
the content of a group, which loses no link.  Among rows that meet, the counts of 32
coarser groups are points of an R-tree; the summed coordinate minima bound the overlap and
prune pairs, and a bitmap of each set (at most a byte a shingle) prunes most of the rest.  Bitmaps
of a quarter of that size go to all rows that meet, the whole ones to rows with a pair left,
and only rows with one left by these have their shingles shuffled; those pairs are counted
where they meet, and the edges that join components are verified on the whole sets.

(An R-tree over the whole table alone opens nearly every leaf: a linked pair may differ by
about 0.16 n, while any one coordinate or sum of coordinates of unrelated texts of n
shingles varies by about sqrt(n) only.)"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import read_table

from .base import by_bucket, components, discard, give_back, hash_words, map_batches, mix, small, stored

WIDTH = 4                    # words a shingle
PERCENT = 85                 # similarity from which two documents link, in percent
DIMS = 32                    # coordinates of a point
SPARSE = 4                   # bits of a set's bitmap, per shingle and at least
MARKS = 1 << 20              # bits of the table by which a set's overlap with others is bounded
NODE = 16                    # entries of an R-tree node
BLOCK = 512                  # rows of a group that one task compares with another such block
WIDER = 4                    # blocks that are one while only outlines are compared
LOT_ROWS = 2000              # rows of small groups that are looked at together
TURNS = 3                    # rounds in which the lots' outlines are shuffled, one round's at a time
TURN_ROWS = 100_000          # rows of lots that one round takes anyway
TURN_SHARE = 4               # rows of lots a round takes, for every outline there is; more rounds if need be
CLUSTER_ROWS = 100_000       # rows with a pair by their short bitmaps from which they are grouped anew
BUCKET_ROWS = 750_000      # signatures a bucket should hold
PORTION = 1_000_000          # characters of texts hashed at once


def shingle_sets(texts: list, width: int = WIDTH) -> list:
    """Sorted distinct 64-bit shingles of each text; a text of fewer words is one shingle."""
    words, sizes = hash_words(texts, lower=True)
    out, at = [], 0
    factors = mix(np.arange(1, width + 1, dtype=np.uint64)) | np.uint64(1)
    with np.errstate(over="ignore"):
        for n in sizes.tolist():
            w = words[at:at + n]
            at += n
            if n >= width:
                g = sum(w[i:n - width + 1 + i] * factors[i] for i in range(width))
                out.append(np.unique(mix(g)))
            elif n:
                g = (w * factors[:n]).sum(dtype=np.uint64) + np.uint64(n)
                out.append(mix(np.array([g], np.uint64)))
            else:
                out.append(np.zeros(0, np.uint64))
    return out


def set_key(grams: np.ndarray, salt: int) -> int:
    """Order-free 64-bit key of a set."""
    with np.errstate(over="ignore"):
        s = mix(grams ^ np.uint64(salt)).sum(dtype=np.uint64) + np.uint64(len(grams))
        return int(mix(np.array([s], np.uint64)).view(np.int64)[0])


def size_classes(largest: int, percent: int = PERCENT) -> np.ndarray:
    """Lower bounds of size classes: a set links only to sets of its own or a neighbouring one."""
    edges = [1]
    while edges[-1] <= largest * 100 // percent + 1:
        edges.append(edges[-1] * 100 // percent + 1)
    edges.append(edges[-1] * 100 // percent + 1)
    return np.array(edges, np.int64)


def subgroups(percent: int) -> int:
    """Parts a group is cut into.  Whole groups hold (100 + p) / 2(100 - p) shingles; where
    that is under six, unrelated texts that share a passage often agree on one, so groups
    are twice as large, may differ in one shingle, and have four parts of which three agree."""
    return 1 if 100 + percent >= 12 * (100 - percent) else 4


def signatures(sets: list, percent: int = PERCENT):
    """(signature, index of its set) of every set: the content of its groups, for the class
    of the larger partner being its own or the next.

    With sizes below u, linked sets differ in at most d = 2u(100 - p)/(100 + p) shingles.
    d + 1 + s groups leave 1 + s equal ones; (d + 1)/2 + s groups leave 1 + s that differ in
    at most one shingle, and then all but one of their four parts are equal: a signature is
    the content of a group, or of a group without one of its parts.  Signatures of at most
    one shingle, which unrelated texts may share, are left out unless the set has more than
    s groups with such a one: of a linked pair, the set with fewer then still has a larger
    signature in an equal group, which as it is equal is a larger one of the other set too."""
    n = np.array([len(s) for s in sets], np.int64)
    edges = size_classes(int(n.max(initial=1)), percent)
    own = np.searchsorted(edges, n, "right") - 1
    parts = subgroups(percent)
    sigs, owners = [], []
    for step in (0, 1):
        scheme = own + step
        u = edges[scheme + 1] - 1
        differ = 2 * u * (100 - percent) // (100 + percent)
        spare = u // 60
        use = np.flatnonzero((n > 0) & (differ > 0))
        if not len(use):
            continue
        m = (differ + 1 if parts == 1 else (differ + 2) // 2)[use] + spare[use]
        first = np.cumsum(m) - m                                     # each set's first group
        flat, rows = np.concatenate([sets[i] for i in use]), np.repeat(np.arange(len(use)), n[use])
        slot = ((flat >> np.uint64(32)) * (m * parts)[rows].astype(np.uint64)) >> np.uint64(32)
        slot = first[rows] * parts + slot.astype(np.int64)           # ascending, as the sets are
        cut = np.concatenate(([0], np.flatnonzero(np.diff(slot)) + 1))
        content, count = np.zeros(m.sum() * parts, np.uint64), np.zeros(m.sum() * parts, np.int64)
        with np.errstate(over="ignore"):
            content[slot[cut]] = np.add.reduceat(mix(flat), cut)
            count[slot[cut]] = np.diff(np.concatenate((cut, [len(flat)])))
            content, count = content.reshape(-1, parts), count.reshape(-1, parts)
            if parts > 1:
                content = content.sum(axis=1, dtype=np.uint64)[:, None] - content
                count = count.sum(axis=1)[:, None] - count
            light = count <= 1
            all_of = np.add.reduceat(light.any(axis=1).astype(np.int64), first) > spare[use]
            row = np.repeat(np.arange(len(use)), m)
            place = (np.arange(len(row)) - first[row])[:, None] * parts + np.arange(parts)
            tag = mix((scheme[use][row][:, None] * np.int64(1 << 32) + place).astype(np.uint64))
            keep = ~light | all_of[row][:, None]
            sigs.append(mix(content + tag)[keep])
        owners.append(np.repeat(use[row], parts).reshape(-1, parts)[keep])
    return (np.concatenate(sigs), np.concatenate(owners)) if sigs else (np.zeros(0, np.uint64), np.zeros(0, np.int64))


def portions(texts: list, chars: int = PORTION):
    """Index ranges of texts with about ``chars`` characters each."""
    begin, held = 0, 0
    for i, t in enumerate(texts):
        held += len(t or "")
        if held >= chars:
            yield begin, i + 1
            begin, held = i + 1, 0
    if begin < len(texts):
        yield begin, len(texts)


def set_rows(docs: DataFrame, width: int, salt: int, carry: tuple = ("doc_id",)) -> DataFrame:
    """``carry``, n_shingles, key, a second key, point and bitmap of every row's set (null if empty)."""
    types = ", ".join(f"{c} {docs.schema[c].dataType.simpleString()}" for c in carry)

    def run(batch):
        n, k, k2, point, bits, texts = [], [], [], [], [], batch.column("text").to_pylist()
        for a, b in portions(texts):
            for s in shingle_sets(texts[a:b], width):
                n.append(len(s))
                k.append(set_key(s, salt) if len(s) else None)
                k2.append(set_key(s, salt + 1) if len(s) else None)
                point.append(narrow(counts(s)) if len(s) else None)
                bits.append(bitmap(s).tobytes() if len(s) else None)
        return {**{c: batch.column(c) for c in carry}, "n": n, "k": k, "k2": k2, "point": point, "bits": bits}

    return map_batches(docs.select(*carry, "text"), f"{types}, n bigint, k bigint, k2 bigint, point binary, bits binary", run)


def counts(grams: np.ndarray) -> np.ndarray:
    """A set's point: how many of its shingles each of ``DIMS`` groups has."""
    return np.bincount((grams >> np.uint64(40)).astype(np.int64) & (DIMS - 1), minlength=DIMS).astype(np.uint32)


def narrow(point: np.ndarray) -> bytes:
    """A point as a byte a coordinate, if that holds it."""
    return (point.astype(np.uint8) if point.max() < 256 else point).tobytes()


def widened(points: list) -> np.ndarray:
    """Points from ``narrow``, a row each."""
    out = np.empty((len(points), DIMS), np.int64)
    for i, p in enumerate(points):
        out[i] = np.frombuffer(p, np.uint8 if len(p) == DIMS else np.uint32)
    return out


def bitmap(grams: np.ndarray) -> np.ndarray:
    """A set's bits, one a shingle, in 64-bit words: a power of two of at least ``SPARSE`` bits a shingle."""
    size = max(64, 1 << (SPARSE * len(grams) - 1).bit_length())
    out = np.zeros(size, bool)
    out[(grams & np.uint64(size - 1)).astype(np.int64)] = True
    return np.packbits(out).view(np.uint64)


def folded(bits: np.ndarray, words: int) -> np.ndarray:
    """The bitmap the same set has with fewer words."""
    while len(bits) > words:
        bits = bits[:len(bits) // 2] | bits[len(bits) // 2:]
    return bits


def within(x: np.ndarray, ys: np.ndarray, n, ns, percent: int) -> np.ndarray:
    """Whether a set of size n may link to others by their bitmaps (a row each): a bit that
    only one of the two has is a shingle that the other lacks."""
    both = np.bitwise_count(ys & x).sum(axis=1, dtype=np.int64)
    most = np.minimum(n - np.bitwise_count(x).sum(dtype=np.int64) + both, ns - np.bitwise_count(ys).sum(axis=1, dtype=np.int64) + both)
    return enough(most, n, ns, percent)


def meetings(docs: DataFrame, width: int, percent: int, salt: int, total: int) -> DataFrame:
    """(sig, k) of the signatures that different sets share, stored.

    Each batch sends one row per bucket, holding its (signature, key) pairs as numbers: 40
    bits of a signature, which within a bucket tell it from the others (two taken for one
    only meet in vain), key by key, and the keys with how many signatures each has.
    Keys of a batch that share a signature are reported on the spot and only the smallest
    is sent on, so a signature of a third of all rows reaches its bucket once a batch.

    The buckets take turns, the more the more signatures a shingle has: a turn hashes the texts
    anew and its shuffle files are gone before the next, so at most about two fifths of a
    signature a shingle are on disk at once."""
    share = 2 * (100 - percent) / (100 + percent) * (2.2 if subgroups(percent) == 1 else 4.4)
    buckets = int(max(8, total * share // BUCKET_ROWS + 1))
    turns = 1 if total * share <= BUCKET_ROWS else 1 + int(2.5 * share)
    met = [met_in_turn(docs, width, percent, salt, buckets, turn, turns) for turn in range(turns)]
    if turns == 1:
        return met[0]
    out = stored(reduce(DataFrame.unionByName, met), "meetings")
    discard(*met)
    return out


def met_in_turn(docs: DataFrame, width: int, percent: int, salt: int, buckets: int, turn: int, turns: int) -> DataFrame:
    """``meetings`` in every ``turns``-th bucket, from ``turn`` on, stored."""
    def send(batches):
        seen = set()
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for a, b in portions(texts):
                sets = []
                for s in shingle_sets(texts[a:b], width):
                    k = set_key(s, salt) if len(s) else None
                    if k is not None and k not in seen:
                        seen.add(k)
                        sets.append((k, s))
                if not sets:
                    continue
                sig, owner = signatures([s for _, s in sets], percent)
                key = np.array([k for k, _ in sets], np.int64)[owner]
                if turns > 1:
                    now = bucket_of(sig, buckets) % np.uint64(turns) == turn
                    sig, key = sig[now], key[now]
                order = np.lexsort((key, sig))
                sig, key = sig[order], key[order]
                first = np.concatenate(([True], sig[1:] != sig[:-1])) if len(sig) else np.zeros(0, bool)
                group = np.cumsum(first) - 1
                shared = np.bincount(group, minlength=1)[group] > 1 if len(sig) else first
                rows = [(-1, sig[shared].tobytes(), key[shared].tobytes(), None)] if shared.any() else []
                sig, key = sig[first], key[first]
                order, spans = by_bucket(sig, buckets)
                for p, x, y in spans:
                    here = order[x:y]
                    here = here[np.argsort(key[here], kind="stable")]
                    own, count = np.unique(key[here], return_counts=True)
                    count = count.astype(np.uint8 if count.max() < 256 else np.uint32)
                    rows.append((p, short(sig[here]), own.tobytes(), count.tobytes()))
                p, s, k, n = zip(*rows) if rows else ((), (), (), ())
                yield pa.RecordBatch.from_arrays([pa.array(p, pa.int32()), pa.array(s, pa.binary()), pa.array(k, pa.binary()),
                                                  pa.array(n, pa.binary())], names=["bucket", "sigs", "ks", "counts"])
        give_back()

    sent = docs.select("text").mapInArrow(send, "bucket int, sigs binary, ks binary, counts binary")
    spread = F.when(F.col("bucket") < 0, F.xxhash64("sigs")).otherwise(F.lit(0))
    sent = sent.withColumn("own", spread)

    def meet(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        rows = list(zip(*(table.column(c).to_pylist() for c in ("sigs", "ks", "counts"))))
        if bucket < 0:
            sig = np.concatenate([long_tag(np.frombuffer(x, np.uint64), buckets) for x, _, _ in rows])
            key = np.concatenate([np.frombuffer(k, np.int64) for _, k, _ in rows])
        else:
            sig = np.concatenate([unshort(x, bucket) for x, _, _ in rows])
            key = np.concatenate([spread_keys(k, n) for _, k, n in rows])
        if bucket >= 0:
            order = np.lexsort((key, sig))
            sig, key = sig[order], key[order]
            new = np.concatenate(([True], (sig[1:] != sig[:-1]) | (key[1:] != key[:-1])))
            sig, key = sig[new], key[new]
            group = np.cumsum(np.concatenate(([True], sig[1:] != sig[:-1]))) - 1
            keep = np.bincount(group)[group] > 1
            sig, key = sig[keep], key[keep]
            give_back()
        return pa.table({"sig": pa.array(sig.view(np.int64)), "k": pa.array(key)})

    return stored(sent.groupBy("bucket", "own").applyInArrow(meet, "sig bigint, k bigint").distinct(), "meetings")


def short(sig: np.ndarray) -> bytes:
    """40 bits of each signature, as 4 + 1 bytes."""
    return (sig & np.uint64(0xFFFFFFFF)).astype(np.uint32).tobytes() + (sig >> np.uint64(32)).astype(np.uint8).tobytes()


def unshort(data: bytes, bucket: int) -> np.ndarray:
    """Names of the signatures of a bucket, from ``short``."""
    n = len(data) // 5
    low, high = np.frombuffer(data, np.uint32, n), np.frombuffer(data, np.uint8, n, 4 * n)
    return (np.uint64(bucket) << np.uint64(40)) + (high.astype(np.uint64) << np.uint64(32)) + low


def long_tag(sig: np.ndarray, buckets: int) -> np.ndarray:
    """The same names from whole signatures."""
    return (bucket_of(sig, buckets) << np.uint64(40)) + (sig & np.uint64((1 << 40) - 1))


def bucket_of(sig: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of each signature, as in ``by_bucket``."""
    return (mix(sig) >> np.uint64(40)) % np.uint64(buckets)


def spread_keys(keys: bytes, counts: bytes) -> np.ndarray:
    """Each key as often as its count says."""
    own = np.frombuffer(keys, np.int64)
    return np.repeat(own, np.frombuffer(counts, np.uint8 if len(counts) == len(own) else np.uint32))


def needed_sets(docs: DataFrame, keys: DataFrame, width: int, salt: int, outlines: DataFrame | None = None) -> DataFrame:
    """(k, grams) of the sets whose key is in ``keys``, stored: made anew from the texts, so
    the sets of all other documents are never written or shuffled while ``keys`` is small.
    ``outlines`` has the hash ``t`` of a text of every key; then only texts with such a hash
    are hashed into shingles, if their number allows a broadcast."""
    def run(batches):
        seen = set()
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for a, b in portions(texts):
                ks, grams = [], []
                for s in shingle_sets(texts[a:b], width):
                    k = set_key(s, salt) if len(s) else None
                    if k is not None and k not in seen:
                        seen.add(k)
                        ks.append(k)
                        grams.append(s.tobytes())
                yield pa.RecordBatch.from_arrays([pa.array(ks, pa.int64()), pa.array(grams, pa.binary())],
                                                 names=["k", "grams"])
        give_back()

    texts = docs.select("text")
    if outlines is not None:
        wanted = stored(outlines.join(small(keys), "k", "left_semi").select("t").distinct(), "wanted")
        few = small(wanted)
        if few is not wanted:
            texts = texts.join(few, F.xxhash64("text") == F.col("t"), "left_semi")
    made = texts.mapInArrow(run, "k bigint, grams binary")
    return stored(made.join(small(keys), "k", "left_semi").dropDuplicates(["k"]), "sets")


def coarse(sets: list) -> np.ndarray:
    """Points: counts of ``DIMS`` groups of each set's shingles."""
    return np.array([np.bincount(s & np.uint32(DIMS - 1), minlength=DIMS) for s in sets], np.int64).reshape(-1, DIMS)


def enough(overlap, a, b, percent: int = PERCENT):
    """Whether sets of sizes a and b with this overlap link: 100 o >= p (a + b - o)."""
    return (100 + percent) * overlap >= percent * (a + b)


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that link, by the whole sets, stored."""
    one = sets.select(F.col("k").alias("a"), F.col("grams").alias("ga"))
    two = sets.select(F.col("k").alias("b"), F.col("grams").alias("gb"))

    def run(batch):
        a, b = [], []
        for ka, kb, x, y in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "ga", "gb"))):
            x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            if enough(min(len(x), len(y)), len(x), len(y), percent):
                both = np.sort(np.concatenate((x, y)))
                if enough(int((both[1:] == both[:-1]).sum()), len(x), len(y), percent):
                    a.append(ka)
                    b.append(kb)
        return {"a": a, "b": b}

    joined = pairs.join(one, "a").join(two, "b").select("a", "b", "ga", "gb")
    return stored(map_batches(joined, "a bigint, b bigint", run), "links")


class RTree:
    """Points packed into nodes of ``NODE`` by size and leading coordinates; a node keeps the
    largest value of every coordinate and the smallest size below it."""

    def __init__(self, points: np.ndarray):
        total = points.sum(axis=1)
        self.order = np.lexsort((points[:, 1], points[:, 0], total // 8))
        self.levels = [(points[self.order], total[self.order])]
        while len(self.levels[-1][0]) > NODE:
            top, low = self.levels[-1]
            at = np.arange(0, len(top), NODE)
            self.levels.append((np.maximum.reduceat(top, at, axis=0), np.minimum.reduceat(low, at)))

    def search(self, q: np.ndarray, percent: int) -> np.ndarray:
        """Points whose overlap with ``q`` may suffice: the summed coordinate minima bound it."""
        n, found = q.sum(), None
        for top, low in reversed(self.levels):
            at = np.arange(len(top)) if found is None else \
                (found[:, None] * NODE + np.arange(NODE)).ravel()
            at = at[at < len(top)]
            found = at[enough(np.minimum(top[at], q).sum(axis=1), n, low[at], percent)]
        return self.order[found]


def plausible(pairs: DataFrame, outlines: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that may link by their bitmaps, stored."""
    one = outlines.select(F.col("k").alias("a"), F.col("n").alias("na"), F.col("bits").alias("xa"))
    two = outlines.select(F.col("k").alias("b"), F.col("n").alias("nb"), F.col("bits").alias("xb"))

    def run(batch):
        a, b = [], []
        for ka, kb, na, nb, x, y in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "na", "nb", "xa", "xb"))):
            if enough(min(na, nb), na, nb, percent):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                words = min(len(x), len(y))
                if within(folded(x, words), folded(y, words)[None, :], na, nb, percent)[0]:
                    a.append(ka)
                    b.append(kb)
        return {"a": a, "b": b}

    joined = pairs.join(one, "a").join(two, "b").select("a", "b", "na", "nb", "xa", "xb")
    return stored(map_batches(joined, "a bigint, b bigint", run), "plausible")


def paired_rows(points: np.ndarray, bits: list, left: np.ndarray, right: np.ndarray, label: np.ndarray,
                percent: int) -> np.ndarray:
    """Whether each row of two blocks may link, by R-tree and bitmaps, to one of the other
    block with another label."""
    return partners(points, bits, left, right, label, percent) >= 0


def partners(points: np.ndarray, bits: list, left: np.ndarray, right: np.ndarray, label: np.ndarray,
             percent: int) -> np.ndarray:
    """The smallest row that each row of two blocks reaches over pairs that may link, by R-tree
    and bitmaps, and have two labels; -1 without such a pair.  A pair is looked at only while
    its rows do not reach each other."""
    size, width = points.sum(axis=1), np.array([len(b) for b in bits])
    tables = {}          # bitmaps of one width; rows of twice that width are folded to it
    for w in np.unique(width).tolist():
        own = np.flatnonzero((width == w) | (width == 2 * w))
        place = np.full(len(bits), -1)
        place[own] = np.arange(len(own))
        tables[w] = place, np.stack([folded(bits[i], w) for i in own])
    root, tree, same = np.full(len(bits), -1), RTree(points[right]), np.array_equal(left, right)
    for x in left.tolist():
        hit = right[tree.search(points[x], percent)]
        hit = hit[(label[hit] != label[x]) & ((hit > x) if same else True) & ((root[hit] < 0) | (root[hit] != root[x]))]
        common = np.minimum(width[hit], width[x])
        for w in np.unique(common).tolist():
            place, table = tables[w]
            ys = hit[common == w]
            ys = ys[(place[ys] >= 0)] if place[x] >= 0 else ys[:0]     # sizes further apart don't link
            good = ys[within(table[place[x]], table[place[ys]], size[x], size[ys], percent)] if len(ys) else ys
            if len(good):
                met = np.unique(np.append(root[good], root[x]))
                met, low = met[met >= 0], min(x, int(good.min()))
                if len(met):
                    low = min(low, int(met[0]))
                    root[np.isin(root, met)] = low
                root[x] = root[good] = low
    return root


def halves(sets: DataFrame, salt: int) -> DataFrame:
    """(k, half): the sets with 32 bits a shingle, sorted.  Equal shingles stay equal, so
    overlaps found with them are never too small."""
    def run(batch):
        return {"k": batch.column("k"), "half": [
            np.sort((mix(np.frombuffer(g, np.uint64) + np.uint64(salt)) >> np.uint64(32)).astype(np.uint32)).tobytes()
            for g in batch.column("grams").to_pylist()]}

    return map_batches(sets, "k bigint, half binary", run)


def overlaps(own: np.ndarray, others: list, marks: np.ndarray) -> np.ndarray:
    """Upper bounds of the overlaps of a set with others: shingles whose bits in a table are set."""
    mask = np.uint32(len(marks) - 1)
    marks[own & mask] = True
    found = np.add.reduceat(marks[np.concatenate(others) & mask].astype(np.int64), np.cumsum([0] + [len(o) for o in others[:-1]]))
    marks[own & mask] = False
    return found


def compare_blocks(sets: list, left: np.ndarray, right: np.ndarray, label: np.ndarray, percent: int) -> list:
    """(x, y) of edges that join the rows of two blocks as their links do.

    The R-tree of the right block's points gives each left row's candidates; those with
    another label are counted by a table of bits and, if that leaves them, exactly (to 32
    bits a shingle).  Of the links found, only those that join two labels are kept."""
    label = label.copy()
    size = np.array([len(s) for s in sets], np.int64)
    points, marks, edges = coarse(sets), np.zeros(MARKS, bool), []
    tree, same = RTree(points[right]), np.array_equal(left, right)
    for x in left.tolist():
        hit = right[tree.search(points[x], percent)]
        hit = hit[(label[hit] != label[x]) & ((hit > x) if same else True)]
        if not len(hit):
            continue
        hit = hit[enough(overlaps(sets[x], [sets[y] for y in hit], marks), size[hit], size[x], percent)]
        for y in hit.tolist():
            if label[y] != label[x]:
                both = np.sort(np.concatenate((sets[x], sets[y])))
                if enough(int((both[1:] == both[:-1]).sum()), size[x], size[y], percent):
                    edges.append((x, y))
                    label[label == label[y]] = label[x]
    return edges


def rows_to_compare(met: DataFrame, labels: DataFrame, outlines: DataFrame, percent: int) -> DataFrame:
    """The rows that have, where they meet, a row of another component to be compared with,
    stored: (home, i, j) is a task, ``block`` the row's side.

    Only signatures met by several components count.  Those with the same smallest member
    are one group, so the signatures that a cluster of copies shares are compared once and
    not one by one.  A group is cut into blocks of about ``BLOCK`` rows (``WIDER`` of them for
    outlines) and two blocks meet in one task, so no task holds a whole large group; small
    groups are dealt to lots."""
    rows = stored(met.join(labels, "k").select("sig", "k", "component"), "labelled")
    open_ = rows.groupBy("sig").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.min("k").alias("home")) \
        .where("low <> high").select("sig", "home")
    groups = stored(rows.join(open_, "sig").select("home", "k", "component").distinct(), "open")
    discard(rows)
    placed = stored(in_blocks(groups, groups.count() // LOT_ROWS + 1, WIDER * BLOCK), "placed")

    types = "home bigint, i int, j int, block int, k bigint, component bigint"

    def prune(table: pa.Table) -> pa.Table:
        home, i, j, block, c, k = (table.column(x).to_numpy() for x in ("home", "i", "j", "block", "component", "k"))
        points = widened(table.column("point").to_pylist())
        bits = [np.frombuffer(b, np.uint64) for b in table.column("bits").to_pylist()]
        order = np.lexsort((j, i, home))
        cuts = np.flatnonzero((np.diff(home[order]) != 0) | (np.diff(i[order]) != 0) | (np.diff(j[order]) != 0)) + 1
        alive, root = np.zeros(len(c), bool), k.copy()
        for own in np.split(order, cuts):
            left, right = np.flatnonzero(block[own] == i[own[0]]), np.flatnonzero(block[own] == j[own[0]])
            if len(left) and len(right):
                found = partners(points[own], [bits[x] for x in own], left, right, c[own], percent)
                alive[own], root[own] = found >= 0, k[own][found]
        return table.append_column("root", pa.array(root)).select(names).filter(pa.array(alive))

    # a set's outline goes to every lot it is in: first with a short bitmap, the whole one where that leaves a pair
    names = ["lot", "home", "i", "j", "block", "k", "component", "point", "root"]
    slim = stored(shortened(outlines), "slim")
    near = in_turns(placed, lambda lots: lots.join(slim, "k").groupBy("lot")
                    .applyInArrow(prune, f"lot bigint, {types}, point binary, root bigint"), "near", TURN_SHARE * slim.count())
    discard(groups, placed, slim)
    names = names[1:-2]
    paired = stored(near.select("k").distinct(), "paired")
    near = clustered(near, paired)
    whole = stored(outlines.select("k", "bits").join(small(paired), "k", "left_semi"), "whole")
    out = in_turns(near, lambda lots: lots.join(whole, "k").groupBy("lot").applyInArrow(prune, types), "pruned")
    discard(near, paired, whole)
    return out


def in_blocks(groups: DataFrame, lots: int, rows: int) -> DataFrame:
    """``groups`` (home, k and others) as tasks: lot, home, i, j and block besides.  Blocks have
    about so many rows; groups of one block are dealt to ``lots`` lots."""
    blocks = groups.groupBy("home").agg(F.ceil(F.count("*") / rows).cast("int").alias("blocks"))
    own = groups.join(blocks, "home").withColumn("block", F.pmod(F.xxhash64("k"), "blocks").cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    lot = F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("home"), F.lit(lots))).otherwise(F.xxhash64("home", "i", "j"))
    return own.withColumn("other", other).withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")}) \
        .select(lot.alias("lot"), "home", "i", "j", "block", *(c for c in groups.columns if c != "home"))


def clustered(near: DataFrame, paired: DataFrame) -> DataFrame:
    """``near`` with rows grouped by the cluster they reach each other in over pairs left, stored.

    Rows that are alike meet at many homes, so each is in several groups; both rows of a pair
    are in one cluster, where a row is once, or once a block of a large one.  A cluster stays
    in the groups it has if these hold fewer rows.  Few rows all stay as they are."""
    total = near.count()
    if total <= CLUSTER_ROWS:
        return near
    labels = stored(components(paired.select(F.col("k").alias("v")), near.select(F.col("k").alias("a"), F.col("root").alias("b")))
                    .select(F.col("v").alias("k"), F.col("component").alias("cluster")), "clusters")
    rows = stored(near.join(labels, "k"), "reached")
    size = rows.groupBy("cluster").agg(F.count("*").alias("now"), F.count_distinct("k").alias("keys"))
    size = size.withColumn("anew", F.col("keys") * F.ceil(F.col("keys") / BLOCK) <= F.col("now")).select("cluster", "anew")
    rows, before = stored(rows.join(size, "cluster"), "reached"), rows
    own = rows.where("anew").select(F.col("cluster").alias("home"), "k", "component", "point").dropDuplicates(["k"])
    anew = in_blocks(own, total // LOT_ROWS + 1, BLOCK)
    out = stored(anew.unionByName(rows.where("not anew").select(*anew.columns)), "clustered")
    discard(near, labels, before, rows)
    return out


def shortened(outlines: DataFrame) -> DataFrame:
    """k, point and a quarter of the bits of every outline: at least a bit a shingle."""
    def run(batch):
        return {"k": batch.column("k"), "point": batch.column("point"), "bits": [
            folded(x, max(1, len(x) // SPARSE)).tobytes() for x in (np.frombuffer(b, np.uint64) for b in batch.column("bits").to_pylist())]}

    return map_batches(outlines.select("k", "point", "bits"), "k bigint, point binary, bits binary", run)


def in_turns(rows: DataFrame, step: Callable[[DataFrame], DataFrame], name: str, most: int | None = None) -> DataFrame:
    """``step`` of all rows, whole lots at a time, stored: what it shuffles for one turn is gone
    before the next.  A turn takes about ``most`` rows at most."""
    total = rows.count()
    turns = 1 if total <= TURN_ROWS else max(TURNS, -(-total // most) if most else 1)
    parts = [stored(step(rows.where(F.pmod(F.xxhash64("lot"), F.lit(turns)) == turn)), name) for turn in range(turns)]
    if turns == 1:
        return parts[0]
    out = stored(reduce(DataFrame.unionByName, parts), "turns")
    discard(*parts)
    return out


def joining_edges(rows: DataFrame, sets: DataFrame, percent: int, salt: int) -> DataFrame:
    """Edges (a, b) that join the components of ``rows_to_compare`` as their links do, stored:
    fewer in a task than it has rows."""
    def compare(table: pa.Table) -> pa.Table:
        i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
        block, k, c = (table.column(x).to_numpy() for x in ("block", "k", "component"))
        sets = [np.frombuffer(h, np.uint32) for h in table.column("half").to_pylist()]
        left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
        found = compare_blocks(sets, left, right, c, percent) if len(left) and len(right) else []
        a, b = (np.array([f[side] for f in found], np.int64) for side in (0, 1))
        return pa.table({"a": pa.array(np.minimum(k[a], k[b])), "b": pa.array(np.maximum(k[a], k[b]))})

    placed = rows.join(halves(sets, salt), "k")
    return stored(placed.groupBy("home", "i", "j").applyInArrow(compare, "a bigint, b bigint").distinct(), "joining")


def more_edges(met: DataFrame, labels: DataFrame, sets: DataFrame, percent: int, salt: int) -> DataFrame:
    """Edges (a, b) that join the components of ``labels`` as the links among rows that meet
    do, stored, with all rows' sets at hand."""
    def run(batch):
        sets = [np.frombuffer(g, np.uint64) for g in batch.column("grams").to_pylist()]
        return {"k": batch.column("k"), "point": [narrow(counts(s)) for s in sets], "bits": [bitmap(s).tobytes() for s in sets]}

    outlines = map_batches(sets, "k bigint, point binary, bits binary", run)
    return joining_edges(rows_to_compare(met, labels, outlines, percent), sets, percent, salt)


def ends(pairs: DataFrame) -> DataFrame:
    """(k) of all rows in ``pairs``."""
    return pairs.select(F.explode(F.array("a", "b")).alias("k")).distinct()


def labelled_rows(docs: DataFrame, width: int, percent: int, carry: tuple = ("doc_id",)) -> DataFrame:
    """``carry``, n and c, the component of the row's set (null without shingles), of every row.

    Equal sets are one vertex, so copies cost nothing more.  Rows that share a signature
    are first tried against the smallest of them, one partner each, if their bitmaps let
    them link; once those links have joined components, only rows of different components
    that still meet are compared.  Whole sets are made anew from the texts for rows that
    have a pair left, so no others are stored or shuffled."""
    salt = 1
    while True:   # a clash of 64-bit keys shows in the second key; another salt then resolves it
        rows = stored(set_rows(docs.withColumn("t", F.xxhash64("text")), width, salt, (*carry, "t")), "rows")
        if rows.groupBy("k").agg(F.min("k2").alias("x"), F.max("k2").alias("y")).where("x <> y").isEmpty():
            break
        salt += 2
    total = int(rows.agg(F.sum("n")).first()[0] or 0)
    met = meetings(docs, width, percent, salt, total)
    members = stored(met.select("k").distinct(), "members")
    outlines = stored(rows.where("k is not null").select("k", "n", "t", "point", "bits").join(small(members), "k", "left_semi")
                      .dropDuplicates(["k"]), "outlines")
    wide, rows = rows, stored(rows.select(*carry, "n", "k"), "own")     # the outlines have the rest
    discard(wide)
    low = met.groupBy("sig").agg(F.min("k").alias("low"))
    first = met.join(low, "sig").where("k <> low").groupBy(F.col("k").alias("b")).agg(F.min("low").alias("a"))
    first = stored(first.select("a", "b"), "first")
    partnered, first = first, plausible(first, outlines, percent)
    discard(partnered)
    sets = needed_sets(docs, stored(ends(first), "tried"), width, salt, outlines)
    links = verified(first, sets, percent)
    discard(sets, first)
    first_salt = salt
    vertices = members.select(F.col("k").alias("v"))
    labels = stored(components(vertices, links).select(F.col("v").alias("k"), "component"), "labels")
    while True:
        pruned = rows_to_compare(met, labels, outlines, percent)
        if pruned.isEmpty():
            break
        sets = needed_sets(docs, stored(pruned.select("k").distinct(), "compared"), width, first_salt, outlines)
        edges = joining_edges(pruned, sets, percent, salt)
        sure = verified(edges, sets, percent)
        discard(pruned, sets)
        if edges.isEmpty():
            break
        links = links.unionByName(sure)
        before, labels = labels, stored(components(vertices, links).select(F.col("v").alias("k"), "component"), "labels")
        discard(before)
        if sure.count() == edges.count():      # all rows that link are joined now
            break
        salt += 2                              # one was not a link: with other bits it will not seem one
    discard(met, outlines)
    return rows.join(small(labels), "k", "left").withColumn("c", F.coalesce("component", "k"))


def link_groups(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id for every row of ``docs``.

    Null, empty and white-space texts have no shingles and link with nothing (component:
    their own doc_id); so does a null doc_id's row, whose component is the smallest
    non-null one it links to.  Rows sharing a doc_id are separate rows."""
    labelled = labelled_rows(docs, width, percent)
    names = labelled.where("c is not null").groupBy("c").agg(F.min("doc_id").alias("component_id"))
    return labelled.join(names, "c", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("c").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def keep_one(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one row of those that link over any path: the smallest by doc_id, then by
    a hash of the whole row; of equal rows one.

    Rows without doc_id stay, and so do rows without shingles, which link with nothing."""
    marked = docs.withColumn("h", F.xxhash64(*docs.columns, *(F.col(c).isNull() for c in docs.columns)))
    rows = labelled_rows(marked, width, percent, ("doc_id", "h")).where("c is not null and doc_id is not null")
    rows = stored(rows.groupBy("c", "doc_id", "h").agg(F.count("*").alias("n")), "own")
    low = rows.groupBy("c").agg(F.sum("n").alias("size"), F.min(F.struct("doc_id", "h")).alias("low"))
    low = stored(low.where("size > 1").select("c", "low"), "low")
    other = F.struct("doc_id", "h") != F.col("low")
    marks = rows.join(small(low), "c").where(other | (F.col("n") > 1)).select("doc_id", "h", other.alias("gone"))
    marks = stored(marks, "gone")
    kept = marked.join(small(marks), ["doc_id", "h"], "left").where("not coalesce(gone, false)")
    once = kept.where("gone is not null").dropDuplicates(["doc_id", "h"])
    return kept.where("gone is null").unionByName(once).select(*docs.columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_groups(read_table(spark, sf_dir, "documents"))
