"""Phrase mining against plain counting."""

import collections
import random
import re

import numpy as np
import pytest

from tessera.llm import op11_phrases as op

SCHEMA = "doc_id long, text string, lang string, word string, f long, n long, phrase string, size string"
LOWER = {c: c + 32 for c in range(65, 91)}


def counts_of(rows):
    f, n = collections.Counter(), collections.Counter()
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, 6):
                for i in range(len(words) - k + 1):
                    f[lang, tuple(words[i:i + k])] += 1
    return f, n


def plain(rows, least, top):
    f, n = counts_of(rows)
    held = {k for k, c in f.items() if len(k[1]) > 1 and c >= least}
    gone = set()
    for lang, words in held:
        for k in range(2, len(words)):
            for i in range(len(words) - k + 1):
                part = (lang, words[i:i + k])
                if 100 * f[lang, words] >= 100 * f[part]:
                    gone.add(part)
    found = collections.defaultdict(list)
    for lang, words in held - gone:
        a = f[lang, words]
        cuts = [(1000 * a * n[lang] // (f[lang, words[:k]] * f[lang, words[k:]]), k) for k in range(1, len(words))]
        score, k = min(cuts)
        found[lang].append((-score, -a, " ".join(words).encode(), f[lang, words[:k]], f[lang, words[k:]]))
    return {(lang, i): (phrase.decode(), -a, left, right, n[lang], -score) for lang, own in found.items()
            for i, (score, a, phrase, left, right) in enumerate(sorted(own)[:top], 1)}


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(8)
    vocabulary = [f"W{i}" for i in range(12)] + ["é", "ß", "\U0001F600", "É", "x\xa0y", "Zz"]
    out = []
    for i in range(150):
        words = [rng.choice(vocabulary) for _ in range(rng.randrange(0, 60))]
        for _ in range(rng.randrange(4)):
            words[rng.randrange(len(words) + 1):0] = "New York City Hall steps".split()[:rng.randrange(2, 6)]
        text = "".join(w + rng.choice([" "] * 12 + ["\t", "  ", ". ", ",", "\n", "\x0b", "\x0c\r", "\x1f ", "?!"]) for w in words)
        out.append((i, text, rng.choice(["en", "en", "en", "fr", "", None])))
    out += [(900, None, "en"), (901, "", None), (902, " . ,\t", "de"), (903, "one", "de"), (903, "a a a a a a a a", "de")] + [out[0]] * 3
    out.append((904, " ".join(rng.choice(vocabulary) for _ in range(30_000)), "en"))
    out.append((905, "y" * 100_000 + " and then", "en"))
    return [(*r, "w", 1, 2, "p", "s") for r in out]


@pytest.mark.parametrize("least, top", [(3, 100_000), (20, 25)])
def test_against_plain_counting(spark, rows, least, top):
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = {(r.lang, r["rank"]): tuple(r[c] for c in ("phrase", "a", "l", "r", "n", "score"))
           for r in op.ranked(op.collocations(docs, least), top).collect()}
    want = plain(rows, least, top)
    assert len(want) > 20 and got == want


def test_crowded_filter_and_small_portions_change_nothing(spark, rows, monkeypatch):
    """What a filter lets through wrongly is counted out; texts are cut anywhere between words."""
    monkeypatch.setattr(op, "FILTER_BITS", 1 << 12)
    monkeypatch.setattr(op, "PORTION", 500)
    monkeypatch.setattr(op.word_stream, "__defaults__", (500,))
    monkeypatch.setattr(op, "BUCKET_ROWS", 3000)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    want = plain(rows, 10, 100_000)
    got = op.ranked(op.collocations(docs, 10), 100_000).collect()
    assert {(r.lang, r["rank"]): (r.phrase, r.a, r.l, r.r, r.n, r.score) for r in got} == want


def test_portions_hold_every_word_once():
    text = " ".join(f"w{i}" + "." * (i % 50 == 0) for i in range(3000)) + " " + "z" * 3000 + " end"
    data = text.encode().translate(op.FOLD)
    whole = next(op.word_stream("en", data))[0]
    for cut in (1, 7, 100, 5000):
        parts = [stream[fresh:] for stream, fresh in op.word_stream("en", data, cut)]
        assert np.array_equal(np.concatenate(parts), whole)


def test_products_beyond_64_bits(spark):
    a, n, left, right = 3 * 10**12, 9 * 10**13, 7 * 10**12, 5 * 10**12 + 1
    found = spark.createDataFrame([("en", "x y z", 3, a, [left, left], [right, right], None, n),
                                   ("en", "p q", 2, 100, [100], [100], 100, n), ("en", "r s", 2, 100, [100], [100], 99, n)],
                                  "lang string, phrase string, size int, f long, firsts array<long>, rests array<long>, longer long, n long")
    got = {r.phrase: r for r in op.ranked(found).collect()}
    assert set(got) == {"x y z", "r s"}
    assert got["x y z"].score == 1000 * a * n // (left * right) and got["r s"].score == 1000 * n // 100


def test_an_empty_table(spark):
    assert op.ranked(op.collocations(spark.createDataFrame([], SCHEMA))).isEmpty()
