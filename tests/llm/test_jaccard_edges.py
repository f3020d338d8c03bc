"""The Jaccard join's signatures at lower thresholds, its comparison by blocks, and clusters of near copies."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import op10_jaccard as op


@pytest.mark.parametrize("percent", [60, 75, 80, 85, 90])
def test_signatures_lose_no_link(percent):
    rng = np.random.default_rng(percent)
    tried = 0
    for n in (3, 7, 12, 20, 60, 300, 2000):
        base = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
        for _ in range(60):
            gone, new = rng.integers(0, max(1, int((100 - percent) / 130 * n)) + 2, 2)
            other = np.unique(np.concatenate((rng.permutation(base)[gone:], rng.integers(0, 2**64, new, dtype=np.uint64))))
            inter = len(np.intersect1d(base, other))
            if len(other) and 100 * inter >= percent * (len(base) + len(other) - inter) and len(np.setxor1d(base, other)):
                s, owner = op.signatures([base, other], percent)
                assert set(s[owner == 0].tolist()) & set(s[owner == 1].tolist())
                tried += 1
    assert tried > 100


def test_short_signatures_keep_their_name():
    rng = np.random.default_rng(1)
    sig = rng.integers(0, 2**64, 500, dtype=np.uint64)
    order, spans = op.by_bucket(sig, 9)
    for bucket, a, b in spans:
        own = sig[order[a:b]]
        assert np.array_equal(op.unshort(op.short(own), bucket), op.long_tag(own, 9))


def test_blocks_are_joined_as_their_links_join_them():
    rng = np.random.default_rng(2)
    for _ in range(20):
        base = rng.choice(2**32, 200, replace=False).astype(np.uint32)
        sets = []
        for _ in range(60):
            own = base.copy()
            at = rng.choice(200, rng.integers(0, 30), replace=False)
            own[at] = rng.integers(0, 2**32, len(at), dtype=np.uint32)
            sets.append(np.sort(own))
        label = rng.integers(0, 50, 60)
        for left, right in ((np.arange(60), np.arange(60)), (np.arange(25), np.arange(25, 60))):
            edges = op.compare_blocks(sets, left, right, label, 85)
            assert len(edges) < 60

            def closed(pairs):
                root = {int(c): int(c) for c in label}

                def find(c):
                    while root[c] != c:
                        c = root[c]
                    return c

                for x, y in pairs:
                    a, b = sorted((find(int(label[x])), find(int(label[y]))))
                    root[b] = a
                return {c: find(c) for c in root}

            linked = [(x, y) for x in left for y in right if x != y and op.enough(len(np.intersect1d(sets[x], sets[y])), 200, 200)]
            assert closed(edges) == closed(linked)
            assert all(op.enough(len(np.intersect1d(sets[x], sets[y])), 200, 200) for x, y in edges)


def cluster_texts():
    rng = random.Random(12)
    passage = [f"p{i}" for i in range(50)]
    texts = [" ".join([f"u{k}-{i}" for i in range(rng.randrange(20, 150))] + passage) for k in range(60)]
    body = [f"b{i}" for i in range(240)]
    for k in range(160):
        words = list(body)
        for _ in range(rng.randrange(0, 14)):
            words[rng.randrange(240)] = f"e{rng.randrange(10**6)}"
        texts.append(" ".join(words + passage * (k % 3 == 0)))
    return texts + texts[:3]


def smallest(texts, width, percent):
    sets = [{tuple(w[i:i + width]) for i in range(len(w) - width + 1)} for w in (t.split() for t in texts)]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: find(i) for i in range(len(texts))}


@pytest.mark.parametrize("width, percent, weak", [(4, 85, False), (5, 80, False), (4, 85, True)])
def test_clusters_of_near_copies(spark, monkeypatch, width, percent, weak):
    """Many copies just above and below the threshold, in blocks; ``weak`` leaves so few bits of
    each shingle in the first rounds that pairs seem to link that don't."""
    texts = cluster_texts()
    monkeypatch.setattr(op, "BLOCK", 40)
    if weak:
        whole, rounds = op.halves, []

        def few_bits(sets, salt):
            rounds.append(salt)
            keep = 0xF if len(rounds) < 3 else 0xFFFFFFFF

            def run(batch):
                return {"k": batch.column("k"), "half": [np.sort(np.frombuffer(h, np.uint32) & np.uint32(keep)).tobytes()
                                                         for h in batch.column("half").to_pylist()]}
            return op.map_batches(whole(sets, salt), "k bigint, half binary", run)

        monkeypatch.setattr(op, "halves", few_bits)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.component_id for r in op.link_groups(docs, width, percent).collect()}
    want = smallest(texts, width, percent)
    assert got == want and 5 < len(set(want.values())) < len(texts) - 20
    if weak:
        assert len(rounds) >= 3


def test_there_are_fewer_edges_than_meetings(spark):
    texts = cluster_texts()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    salt, total = 1, 60_000
    met = op.meetings(docs, 4, 85, salt, total)
    sets = op.needed_sets(docs, met.select("k").distinct(), 4, salt)
    labels = met.select("k").distinct().withColumn("component", F.col("k"))
    edges = op.more_edges(met, labels, sets, 85, salt)
    assert 0 < edges.count() < met.count()


@pytest.mark.parametrize("percent", [80, 85])
def test_bitmaps_lose_no_link(percent):
    rng = np.random.default_rng(percent)
    links = dropped = 0
    for _ in range(1500):
        base = np.unique(rng.integers(0, 2**64, int(rng.integers(1, 1500)), dtype=np.uint64))
        keep = rng.random(len(base)) > rng.random() * 0.4
        other = np.unique(np.concatenate((base[keep], rng.integers(0, 2**64, int((~keep).sum() * rng.random() * 1.5) + 1, dtype=np.uint64))))
        x, y = op.bitmap(base), op.bitmap(other)
        words = min(len(x), len(y))
        may = op.within(op.folded(x, words), op.folded(y, words)[None, :], len(base), len(other), percent)[0]
        inter = len(np.intersect1d(base, other))
        link = 100 * inter >= percent * (len(base) + len(other) - inter)
        assert may or not link
        links, dropped = links + link, dropped + (not may)
    assert links > 100 and dropped > 100


def test_rows_with_a_link_across_labels_stay():
    rng = np.random.default_rng(5)
    for n in (30, 250, 3000):
        base = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
        sets = []
        for _ in range(50):
            own = base[rng.random(len(base)) > rng.random() * 0.3]
            sets.append(np.unique(np.concatenate((own, rng.integers(0, 2**64, int(rng.integers(1, n)), dtype=np.uint64)))))
        label = rng.integers(0, 6, 50)
        points, bits = np.array([op.counts(s) for s in sets], np.int64), [op.bitmap(s) for s in sets]
        for left, right in ((np.arange(50), np.arange(50)), (np.arange(20), np.arange(20, 50))):
            alive = op.paired_rows(points, bits, left, right, label, 80)
            for x in left:
                for y in right:
                    if label[x] != label[y] and op.enough(len(np.intersect1d(sets[x], sets[y])), len(sets[x]), len(sets[y]), 80):
                        assert alive[x] and alive[y]


def test_outlines_are_shuffled_a_part_of_the_lots_at_a_time(spark, monkeypatch):
    texts = cluster_texts()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    monkeypatch.setattr(op, "BLOCK", 30)
    met = op.meetings(docs, 4, 85, 1, 60_000)
    outlines = op.stored(op.set_rows(docs, 4, 1).where("k is not null").dropDuplicates(["k"]), "outlines")
    labels = met.select("k").distinct().withColumn("component", F.col("k"))
    written, stored = [], op.stored

    def counted(df, name, *more):
        out = stored(df, name, *more)
        written.append((name, out.count()))
        return out

    monkeypatch.setattr(op, "stored", counted)
    once = sorted(map(tuple, op.rows_to_compare(met, labels, outlines, 85).collect()))
    written.clear()
    monkeypatch.setattr(op, "TURN_ROWS", 0)
    assert once and sorted(map(tuple, op.rows_to_compare(met, labels, outlines, 85).collect())) == once
    parts = [n for name, n in written if name == "pruned"]
    assert len(parts) == op.TURNS and sum(parts) == len(once) and max(parts) < len(once) / 2


def test_meetings_by_turns_are_those_of_one(spark):
    docs = spark.createDataFrame([(t,) for t in cluster_texts()], "text string").repartition(3)
    whole = {tuple(r) for r in op.met_in_turn(docs, 5, 80, 1, 8, 0, 1).collect()}
    parts = [{tuple(r) for r in op.met_in_turn(docs, 5, 80, 1, 8, turn, 3).collect()} for turn in range(3)]
    assert all(parts) and set.union(*parts) == whole and sum(map(len, parts)) == len(whole)


def test_short_bitmaps_lose_no_link(spark):
    """A quarter of the bits is shuffled for all rows that meet; linked sets stay candidates."""
    rng, rows, sets = np.random.default_rng(3), [], []
    for n in (3, 20, 60, 130, 1500):
        base = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
        gone = max(1, n // 12)
        sets += [base, np.unique(np.concatenate((base[gone:], rng.integers(0, 2**64, gone // 2, dtype=np.uint64)))),
                 np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))]
    rows = [(i, bytearray(op.narrow(op.counts(s))), bytearray(op.bitmap(s).tobytes())) for i, s in enumerate(sets)]
    got = sorted(op.shortened(spark.createDataFrame(rows, "k bigint, point binary, bits binary")).collect())
    points = op.widened([bytes(r.point) for r in got])
    bits = [np.frombuffer(bytes(r.bits), np.uint64) for r in got]
    assert np.array_equal(points, [op.counts(s) for s in sets]) and len(got[0].point) == op.DIMS
    assert all(len(b) == max(1, len(op.bitmap(s)) // 4) for b, s in zip(bits, sets))
    linked = {i for i, x in enumerate(sets) for j, y in enumerate(sets)
              if i != j and op.enough(len(np.intersect1d(x, y)), len(x), len(y), 80)}
    every = np.arange(len(sets))
    alive = set(np.flatnonzero(op.paired_rows(points, bits, every, every, every, 80)).tolist())
    assert len(linked) >= 6 and linked <= alive and alive != set(every.tolist())
    big = np.full(op.DIMS, 300, np.uint32)
    assert np.array_equal(op.widened([op.narrow(big)])[0], big)


@pytest.mark.parametrize("block", [40, 512])
def test_rows_left_are_compared_by_cluster(spark, monkeypatch, block):
    """Rows alike meet at many homes; by cluster each is compared once, or once a block, and no link is lost."""
    texts = cluster_texts()
    monkeypatch.setattr(op, "BLOCK", block)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    met = op.meetings(docs, 5, 80, 1, 60_000)
    outlines = op.stored(op.set_rows(docs, 5, 1).where("k is not null").dropDuplicates(["k"]), "outlines")
    labels = met.select("k").distinct().withColumn("component", F.col("k"))
    at_homes = op.rows_to_compare(met, labels, outlines, 80).count()
    monkeypatch.setattr(op, "CLUSTER_ROWS", 0)
    rows = op.rows_to_compare(met, labels, outlines, 80)
    keys = rows.select("k").distinct().count()
    assert keys and rows.count() <= keys * -(-len(texts) // block) and rows.count() < at_homes
    got = {r.doc_id: r.component_id for r in op.link_groups(docs, 5, 80).collect()}
    assert got == smallest(texts, 5, 80)


def test_partners_are_the_rows_reached_over_pairs():
    rng = np.random.default_rng(8)
    for n in (40, 300):
        bases = [np.unique(rng.integers(0, 2**64, n, dtype=np.uint64)) for _ in range(5)]
        sets = []
        for i in range(45):
            own = bases[i % 5][rng.random(len(bases[i % 5])) > rng.random() * 0.15]
            sets.append(np.unique(np.concatenate((own, rng.integers(0, 2**64, int(rng.integers(1, n // 8)), dtype=np.uint64)))))
        label = rng.integers(0, 12, 45)
        points, bits = np.array([op.counts(s) for s in sets], np.int64), [op.bitmap(s) for s in sets]
        for left, right in ((np.arange(45), np.arange(45)), (np.arange(20), np.arange(20, 45))):
            root = op.partners(points, bits, left, right, label, 80)
            assert np.array_equal(root >= 0, op.paired_rows(points, bits, left, right, label, 80))
            assert len(set(root[root >= 0].tolist())) > 1
            for x in left:
                for y in right:
                    if label[x] != label[y] and op.enough(len(np.intersect1d(sets[x], sets[y])), len(sets[x]), len(sets[y]), 80):
                        assert root[x] == root[y] >= 0


def test_lots_take_as_many_rounds_as_keep_one_small(spark, monkeypatch):
    monkeypatch.setattr(op, "TURN_ROWS", 10)
    seen, rows = [], op.stored(spark.range(1000).select(F.col("id").alias("lot")), "lots")

    def step(lots):
        seen.append(lots.count())
        return lots

    assert op.in_turns(rows, step, "turn", 100).count() == 1000
    assert len(seen) == 10 and sum(seen) == 1000 and max(seen) < 200
    seen.clear()
    assert op.in_turns(rows, step, "turn", 900).count() == 1000 and len(seen) == op.TURNS


def test_a_key_is_sent_once_for_its_signatures_of_a_bucket():
    keys = np.array([-5, 3, 9], np.int64)
    for counts in ([2, 1, 3], [2, 1000, 3]):
        counts = np.array(counts, np.uint8 if max(counts) < 256 else np.uint32)
        assert np.array_equal(op.spread_keys(keys.tobytes(), counts.tobytes()), np.repeat(keys, counts))
