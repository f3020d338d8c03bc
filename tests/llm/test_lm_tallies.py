"""The language model's tallies: one sort a block, names within buckets, own counts."""

import collections

import numpy as np

from tessera.llm import op8_lm as op


def test_tallies_and_own_counts_equal_brute_force():
    texts = ["a b a b a b", "", "b a", "a b c a b", " \n ", "z"]
    keys, doc, first, sizes = op.explode(texts)
    for buckets in (1, 8, 70_000):
        tokens = op.in_buckets(np.concatenate(keys), buckets)
        tokens.sort()
        _, names, n, place, special, spans = op.tallied(tokens, sizes, buckets)
        assert n[special].tolist() == [14, 4] and n.sum() == len(tokens) + 18
        assert sorted([*place, *special]) == list(range(len(n)))
        assert [s[0] for s in spans] == sorted({s[0] for s in spans}) and spans[-1][2] == len(n)
        assert all((np.diff(names[x:y].astype(np.int64)) > 0).all() for _, x, y in spans)
        answers = [op.packed(np.zeros(y - x, np.int64)) for _, x, y in spans]
        one, two, three, words, starts = op.others(keys, doc, first, sizes, answers, buckets)
        assert words.tolist() == (14 - sizes).tolist() and starts.tolist() == (4 - (sizes > 0)).tolist()
        places = np.flatnonzero(~first)
        for got, k, at in ((one, keys[0], np.arange(14)), (two, keys[1], np.arange(14)), (three[places], keys[2], places)):
            whole, own = collections.Counter(k.tolist()), collections.Counter(zip(k.tolist(), doc[at].tolist()))
            assert got.tolist() == [whole[x] - own[x, d] for x, d in zip(k.tolist(), doc[at].tolist())]
        assert not three[first].any()


def test_a_block_is_sorted_once(monkeypatch):
    """No sort of its own for each order's unique keys and for own counts."""
    keys, doc, first, sizes = op.explode(["a b c d"] * 50)
    tokens = np.sort(op.in_buckets(np.concatenate(keys), 8))
    spans = op.tallied(tokens, sizes, 8)[-1]
    called = []
    monkeypatch.setattr(op.np, "unique", lambda *a, **k: called.append(a))
    op.others(keys, doc, first, sizes, [op.packed(np.zeros(y - x, np.int64)) for _, x, y in spans], 8)
    assert not called
