"""SimHash near duplicates against brute force."""

import random
import re

import numpy as np
import pytest
import xxhash

from tessera.llm import op12_simhash as op

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, fp string, component string, n int, low int"


def plain_fingerprint(text):
    words = WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
    grams = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << j for j in range(64) if 2 * sum(h >> j & 1 for h in hashes) > len(hashes))


def plain_components(prints):
    """Smallest key reachable over links of at most three bits, for {key: fingerprint}."""
    keys = sorted(prints)
    root = {k: k for k in keys}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for i, a in enumerate(keys):
        for b in keys[i + 1:]:
            if (prints[a] ^ prints[b]).bit_count() <= 3:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {k: find(k) for k in keys}


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(6)
    out = []
    for i in range(60):
        out.append(" ".join(f"w{rng.randrange(400)}" for _ in range(rng.randrange(1, 200))))
    body = [f"b{i}" for i in range(400)]
    for k in range(60):                                    # near copies, in chains
        words = list(body)
        for j in range(k // 12):
            words[(97 * j + 31) % 400] = f"edit{k}-{j}"
        out.append("  ".join(words) if k % 2 else " ".join(words).upper())
    out += ["same text here again"] * 20
    out += [None, "", " \n\t", "one", "ONE", "one two", "É x", "é x", "a\x0bb\x0cc d", "x" * 100_000, " ".join(f"l{i % 977}" for i in range(50_000))]
    table = [(i, t, "c", "k", 1, 2) for i, t in enumerate(out)]
    return table + [table[3], (None, "same text here again", *table[0][2:]), (None, "nothing like it at all in here", *table[0][2:])]


def test_fingerprints_and_components(spark, rows):
    got = op.link_groups(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    assert len(got) == len(rows)
    prints = {i: plain_fingerprint(t) for i, t, *_ in rows if i is not None}
    want = plain_components(prints)
    assert len(set(want.values())) < len(want) - 35
    for r in got:
        if r.doc_id is not None:
            assert r.fp % (1 << 64) == prints[r.doc_id] and r.component_id == want[r.doc_id]
    same = next(i for i, t, *_ in rows if t == "same text here again")
    assert sorted(r.component_id is None for r in got if r.doc_id is None) == [False, True]
    assert {r.component_id for r in got if r.doc_id is None} == {None, want[same]}


def test_planted_distances(spark, monkeypatch):
    """Groups, chains and dense clusters of fingerprints, with both ways to compare an entry's fingerprints."""
    rng = random.Random(1)
    prints = {rng.getrandbits(64) for _ in range(500)} | {0, (1 << 64) - 1}
    for centre in list(prints)[:12]:
        x = centre
        for _ in range(40):
            for _ in range(rng.randrange(1, 5)):
                x ^= 1 << rng.randrange(64)
            prints.add(x)
    centre = rng.getrandbits(64)
    prints |= {centre ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(1, 6))) for _ in range(700)}
    signed = {p - (1 << 64) * (p >> 63): p for p in prints}
    fps = spark.createDataFrame([(s,) for s in signed], "fp long").repartition(4)
    want = plain_components(signed)
    for limit in (op.PAIRWISE, 5):
        monkeypatch.setattr(op, "PAIRWISE", limit)
        edges = [tuple(r) for r in op.links(fps, 3, len(signed)).collect()]
        assert len(edges) <= 56 * len(signed)
        root = dict(zip(signed, signed))

        def find(k):
            while root[k] != k:
                k = root[k]
            return k

        for a, b in edges:
            x, y = sorted((find(a), find(b)))
            root[y] = x
        assert {k: find(k) for k in signed} == want


@pytest.mark.parametrize("bits", [0, 1, 2, 3])
def test_linked_fingerprints_share_an_entry(bits):
    rng = np.random.default_rng(bits)
    masks = op.entries(bits)
    for _ in range(300):
        flip = sum(1 << int(b) for b in rng.choice(64, bits, replace=False))
        assert any(flip & int(m) == 0 for m in masks)


def test_portions_of_a_long_text(monkeypatch):
    from tessera.llm import base

    text = " ".join(f"w{i * i % 7919}" for i in range(5000))
    whole = op.fingerprint(text)
    monkeypatch.setattr(op, "slices", lambda t: base.slices(t, 300))
    monkeypatch.setattr(op, "CHUNK", 7)
    assert op.fingerprint(text) == whole == plain_fingerprint(text)
    assert op.fingerprint("a b") == plain_fingerprint("a b")


def test_an_empty_table(spark):
    assert op.link_groups(spark.createDataFrame([], SCHEMA)).isEmpty()
