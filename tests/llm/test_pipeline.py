"""The corpus pipeline, stage by stage, against plain brute-force versions; odd and empty tables."""

import collections
import os
import re

import pytest

import corpus_pipeline
from tessera.llm.base import DOC_COLUMNS, stored

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n long, k long, size string, score double"


def survivors(docs):
    """Ids left if only the smallest id of every linked group stays."""
    sets = {}
    for d in docs:
        words = WORD.findall((d.text or "").translate({c: c + 32 for c in range(65, 91)}))
        grams = {tuple(words[i:i + 4]) for i in range(len(words) - 3)} if len(words) >= 4 else {tuple(words)} - {()}
        sets[d.doc_id] = grams
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for x, a in enumerate(ids):
        for b in ids[x + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 85 * (len(sets[a]) + len(sets[b]) - both):
                lo, hi = sorted((root(a), root(b)))
                parent[hi] = lo
    return {i for i in ids if root(i) == i}


def stages(spark, docs, sf_dir=SF):
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(stored(stage(spark, out[-1], sf_dir), f"test-{name}"))
    return out


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
def test_stages_against_brute_force(spark):
    odd = [(900_001, None, None, None, None, 1, 1, "x", 0.5), (900_002, "", "en", "a", 0, None, None, None, None),
           (900_003, "12 34 !", "en", "a", 7, 1, 1, "x", 0.5), (900_003, "12 34 !", "en", "a", 7, 1, 1, "x", 0.5)]
    given = spark.read.parquet(f"{SF}/documents.parquet").select(*DOC_COLUMNS) \
        .unionByName(spark.createDataFrame(odd, SCHEMA), allowMissingColumns=True)
    frames = stages(spark, given)
    for frame in frames[1:-1]:
        assert tuple(frame.columns) == DOC_COLUMNS
    docs, lang, near, private, mixed = (f.collect() for f in frames[:-1])

    texts = {d.doc_id: d.text for d in docs}
    kept = {d.doc_id for d in lang}
    assert len(kept) == len(lang) and all(d.text == texts[d.doc_id] and d.lang for d in lang)
    assert not kept & {900_001, 900_002, 900_003}
    assert len(kept) >= 0.95 * sum(bool(re.search(r"[^\W\d_]", t or "")) for t in texts.values())

    assert {d.doc_id for d in near} == survivors(lang) and len({d.doc_id for d in near}) == len(near)

    before = {d.doc_id: d.text for d in near}
    assert {d.doc_id for d in private} == set(before) and len(private) == len(near)
    assert not any(EMAIL.search(d.text) for d in private)
    assert sum(bool(EMAIL.search(t)) for t in before.values()) <= sum(d.text != before[d.doc_id] for d in private)

    clean = {d.doc_id: d for d in private}
    copies = collections.Counter(d.doc_id for d in mixed)
    assert set(copies) <= set(clean) and max(copies.values()) <= 3
    assert all(d.text == clean[d.doc_id].text and d.source == clean[d.doc_id].source for d in mixed)

    pieces = frames[-1].collect()
    filled = collections.defaultdict(list)
    for p in pieces:
        filled[p.sequence_id].append((p.offset, p.length))
    for parts in filled.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096
    assert collections.Counter(p.doc_id for p in pieces if p.piece == 0) == copies


def test_stages_on_an_empty_table(spark):
    frames = stages(spark, spark.createDataFrame([], SCHEMA))
    assert all(f.isEmpty() for f in frames)


def test_near_duplicates_share_runs_of_five_words(spark):
    """The stage's own contract, five words and 0.8, on scattered single-word edits."""
    texts = {}
    for group, size in enumerate((30, 60, 100, 100, 150, 400)):
        words = [f"g{group}w{i}" for i in range(size)]
        for copy in range(5):
            own = list(words)
            for e in range(copy * size // 90 + (copy > 0)):
                own[(7 + 13 * e + 29 * copy) % size] = f"edit{copy}-{e}"
            texts[len(texts)] = " ".join(own)
    sets = {i: {tuple(w[k:k + 5]) for k in range(len(w) - 4)} for i, w in ((i, t.split()) for i, t in texts.items())}
    root = {i: i for i in sets}
    links = [(a, b) for a in sets for b in sets if a < b and 10 * len(sets[a] & sets[b]) >= 8 * len(sets[a] | sets[b])]
    for _ in sets:
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    want = {i for i in root if root[i] == i}
    assert 6 < len(want) < len(sets)
    docs = spark.createDataFrame([(i, t, "en", "a", len(t)) for i, t in texts.items()],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    assert {d.doc_id for d in corpus_pipeline.near_duplicates(spark, docs, SF).collect()} == want


def test_language_keeps_clear_mixtures(spark):
    """Even mixtures of two and three languages stay; a text without letters goes."""
    own = {"en": "the of and to in is that it for on was with as be by this from are".split(),
           "de": "der die und das nicht mit ein auf sich von dem den für ist werden wird".split(),
           "fi": "joka olla tämä mutta kuin myös hän niin vain kaikki sitten kun minä sinä".split()}
    text = {lang: lambda i, n, ws=ws: " ".join(ws[(i * 7 + 3 * k) % len(ws)] for k in range(n)) for lang, ws in own.items()}
    rows = [(3 * i + j, text[lang](i, 30), lang) for i in range(30) for j, lang in enumerate(own)]
    rows += [(1000, " ".join(text[lang](1, 20) for lang in ("en", "de", "fi")), None),
             (1001, " ".join(text[lang](2, 30) for lang in ("de", "fi")), None),
             (1002, " ".join(text[lang](3, n) for lang, n in (("fi", 24), ("en", 18), ("de", 18))), None),
             (1003, "12 34 !", None)]
    docs = spark.createDataFrame([(i, t, lang, "a", len(t)) for i, t, lang in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.language(spark, docs, SF).collect()
    assert sorted(d.doc_id for d in kept) == [i for i, _, _ in rows if i != 1003]
    assert all(d.lang in own for d in kept)
