"""Language of each word of code-switched text: a linear-chain conditional random field."""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import regex
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.session import read_table

from .base import kept, map_batches

WORDS = regex.compile(r"\p{L}[\p{L}\p{M}]*")
FEATURES = 1 << 17           # hashed feature space
SAMPLE_DOCS = 250            # labelled documents a language to fit on
SEGMENTS = 16                # segments a document, spread evenly over its whole text
SEGMENT = 12                 # words a segment
PIECES = 4                   # segments a training chain
SWITCH = 0.2                 # share of training chains' joints that switch to another document
CHAIN = 64                   # words a chain at prediction; a longer text is several chains
ROUNDS, RATE, DECAY = 40, 0.15, 1e-4
BATCH_CHARS = 1 << 19        # characters labelled at once: bounds a worker's memory
CACHE_WORDS = 200_000        # words a worker remembers before it starts anew
SCORED = 8192                # new words scored at once
MIN_SCORE = 0.5
UNKNOWN = "und"


def features(word: str, lexicon: dict) -> list:
    """Hashed affixes, n-grams with word bounds, the word itself, and its lexicon."""
    bound = f"^{word}$"
    out = [f"p{word[:k]}" for k in (1, 2, 3)] + [f"s{word[-k:]}" for k in (1, 2, 3)]
    out += [bound[i:i + n] for n in (2, 3, 4) for i in range(len(bound) - n + 1)]
    out.append(f"w{word}")
    if word in lexicon:
        out.append(f"L{lexicon[word]}")
    return [zlib.crc32(f.encode()) % FEATURES for f in out]


def scores_of(words: list, weights: np.ndarray, lexicon: dict) -> np.ndarray:
    rows = [features(w, lexicon) for w in words]
    starts = np.cumsum([0] + [len(r) for r in rows[:-1]])
    flat = np.fromiter((f for r in rows for f in r), np.int64)
    return np.add.reduceat(weights[flat], starts, axis=0)


def forward_backward(emit: np.ndarray, trans: np.ndarray, mask: np.ndarray):
    """Marginals of chains (chains, steps, labels), expected transitions, and log Z.

    ``mask`` is true on real words, which come first in every chain."""
    n, steps, k = emit.shape
    top = emit.max(axis=2, keepdims=True)
    psi = np.exp(emit - top)
    a = np.exp(trans)
    alpha, scale = np.empty_like(psi), np.ones((n, steps))
    for t in range(steps):
        x = psi[:, t] if t == 0 else (alpha[:, t - 1] @ a) * psi[:, t]
        scale[:, t] = x.sum(axis=1)
        alpha[:, t] = x / scale[:, t, None]
    beta = np.ones_like(psi)
    for t in range(steps - 2, -1, -1):
        x = ((psi[:, t + 1] * beta[:, t + 1]) @ a.T) / scale[:, t + 1, None]
        beta[:, t] = np.where(mask[:, t + 1, None], x, 1.0)
    gamma = alpha * beta
    gamma /= gamma.sum(axis=2, keepdims=True)
    log_z = ((np.log(scale) + top[:, :, 0]) * mask).sum()
    return gamma, alpha, beta, psi, scale, log_z


def fit(texts: list, labels: list, rounds: int = ROUNDS, seed: int = 7) -> dict:
    """Train on (text, label) pairs; the labels of a text's words are the text's.

    Chains join segments of different texts, so transitions between languages are learned
    from real words on both sides of a switch."""
    names = sorted(set(labels))
    where = {name: i for i, name in enumerate(names)}
    segments = []
    for text, label in zip(texts, labels):
        words = WORDS.findall(text.lower())
        own = [words[i:i + SEGMENT] for i in range(0, len(words), SEGMENT)]
        pick = np.unique(np.linspace(0, len(own) - 1, min(SEGMENTS, len(own))).astype(int)) if own else []
        segments += [(own[i], where[label]) for i in pick]
    if not segments:
        return {"labels": names[:0], "weights": np.zeros((FEATURES, 0), np.float32), "trans": np.zeros((0, 0)),
                "lexicon": {}}
    counts = Counter((w, y) for ws, y in segments for w in set(ws))
    total = Counter()
    for (w, _), n in counts.items():
        total[w] += n
    lexicon = {w: names[y] for (w, y), n in counts.items() if n >= 3 and n >= 0.8 * total[w]}
    rng = np.random.default_rng(seed)
    by_label = [[i for i, s in enumerate(segments) if s[1] == y] for y in range(len(names))]
    chains, pool = [], rng.permutation(len(segments))
    for i in pool[:max(1, len(pool) // PIECES * 2)]:
        chain = [segments[i]]
        for _ in range(PIECES - 1):
            y = int(rng.integers(len(names))) if rng.random() < SWITCH else chain[-1][1]
            chain.append(segments[by_label[y][rng.integers(len(by_label[y]))]])
        chains.append(chain)
    vocabulary = sorted({w for c in chains for ws, _ in c for w in ws})
    code = {w: i for i, w in enumerate(vocabulary)}
    rows = [features(w, lexicon) for w in vocabulary]
    starts = np.cumsum([0] + [len(r) for r in rows[:-1]])
    flat, owner = np.array([f for r in rows for f in r]), np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    steps = max(sum(len(ws) for ws, _ in c) for c in chains)
    words = np.zeros((len(chains), steps), np.int64)
    gold = np.zeros((len(chains), steps), np.int64)
    mask = np.zeros((len(chains), steps), bool)
    for i, c in enumerate(chains):
        own, ys = [code[w] for ws, _ in c for w in ws], [y for ws, y in c for _ in ws]
        words[i, :len(own)], gold[i, :len(own)], mask[i, :len(own)] = own, ys, True
    k = len(names)
    target = np.eye(k)[gold] * mask[:, :, None]
    pairs = np.zeros((k, k))
    np.add.at(pairs, (gold[:, :-1][mask[:, 1:]], gold[:, 1:][mask[:, 1:]]), 1)
    weights, trans = np.zeros((FEATURES, k)), np.zeros((k, k))
    state = [[np.zeros_like(x), np.zeros_like(x)] for x in (weights, trans)]
    used = np.unique(flat)
    flat = np.searchsorted(used, flat)
    weights, state[0] = weights[used], [s[used] for s in state[0]]
    for step in range(1, rounds + 1):
        emit = np.add.reduceat(weights[flat], starts, axis=0)[words] * mask[:, :, None]
        gamma, alpha, beta, psi, scale, _ = forward_backward(emit, trans, mask)
        diff = (gamma * mask[:, :, None] - target).reshape(-1, k)
        seen = np.stack([np.bincount(words.ravel(), diff[:, j], len(vocabulary)) for j in range(k)], 1)
        g_w = np.stack([np.bincount(flat, seen[owner, j], len(used)) for j in range(k)], 1) / mask.sum()
        after = psi[:, 1:] * beta[:, 1:] / scale[:, 1:, None] * mask[:, 1:, None]
        expected = np.einsum("nti,ntj->ij", alpha[:, :-1], after) * np.exp(trans)
        g_t = (expected - pairs) / mask.sum()
        for x, g, (m, v) in zip((weights, trans), (g_w, g_t), state):
            g += DECAY * x * 0.01
            m *= 0.9
            m += 0.1 * g
            v *= 0.99
            v += 0.01 * g * g
            x -= RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    full = np.zeros((FEATURES, k), np.float32)
    full[used] = weights
    return {"labels": names, "weights": full, "trans": trans, "lexicon": lexicon}


def word_marginals(texts: list, model: dict, cache: dict | None = None) -> list:
    """For each text its words and their (words, labels) marginals."""
    cache = {} if cache is None else cache
    k = len(model["labels"])
    words = [WORDS.findall(t.lower()) if t else [] for t in texts]
    if len(cache.setdefault("code", {})) > CACHE_WORDS:
        cache.clear()
        cache["code"] = {}
    code = cache["code"]
    new = [w for w in {w for ws in words for w in ws} if w not in code]
    if new:
        made = np.concatenate([scores_of(new[i:i + SCORED], model["weights"], model["lexicon"])
                               for i in range(0, len(new), SCORED)])
        have = cache.get("n", 0)
        if have + len(new) > len(cache.get("emit", ())):
            grown = np.zeros((2 * (have + len(new)), k), np.float32)
            grown[:have] = cache.get("emit", grown)[:have]
            cache["emit"] = grown
        cache["emit"][have:have + len(new)] = made
        code.update(zip(new, range(have, have + len(new))))
        cache["n"] = have + len(new)
    sizes = np.array([len(ws) for ws in words], np.int64)
    total = int(sizes.sum())
    if not total or not k:
        return [(ws, np.zeros((len(ws), k))) for ws in words]
    codes = np.fromiter((code[w] for ws in words for w in ws), np.int64, total)
    # chains of at most CHAIN words, none crossing two texts
    of_text = np.repeat(np.arange(len(words)), -(-sizes // CHAIN))
    first = np.cumsum(-(-sizes // CHAIN)) - -(-sizes // CHAIN)
    nth = np.arange(len(of_text)) - first[of_text]
    begin = (np.cumsum(sizes) - sizes)[of_text] + nth * CHAIN
    length = np.minimum(CHAIN, sizes[of_text] - nth * CHAIN)
    at = np.arange(CHAIN)
    mask = at < length[:, None]
    emit = np.zeros((len(of_text), CHAIN, k), np.float32)
    emit[mask] = cache["emit"][codes[(begin[:, None] + at)[mask]]]
    gamma = forward_backward(emit, model["trans"].astype(np.float32), mask)[0]
    flat = gamma[mask]
    return [(ws, m) for ws, m in zip(words, np.split(flat, np.cumsum(sizes)[:-1]))]


def held_out(doc_id: Column) -> Column:
    """Documents kept from training: crc32 of the id as text leaves 1 modulo 3 (null: false)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> dict:
    """Fit on the ``sample_docs`` labelled, not held-out documents of each language whose
    id hashes lowest.  Only ids are ranked; texts are fetched for the chosen ones."""
    pool = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))
                      & F.col("text").rlike(r"\p{L}"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id"))
    chosen = pool.select("lang", "doc_id").withColumn("rank", rank).where(F.col("rank") <= sample_docs)
    keys = chosen.select("doc_id").distinct().collect()
    if not keys:
        return fit([], [])
    rows = pool.where(F.col("doc_id").isin([r.doc_id for r in keys])).select("doc_id", "text", "lang").collect()
    rows.sort(key=lambda r: (r.lang, r.doc_id, r.text))
    return fit([r.text for r in rows], [r.lang for r in rows])


def predict(docs: DataFrame, model: dict, carry: tuple = ("doc_id",)) -> DataFrame:
    """The ``carry`` columns with lang_pred, score and sure, one row for each row of ``docs``.

    A text's language is the label with the largest sum of word marginals, its score their
    mean.  ``sure`` is the mean of every word's largest marginal: high also for a text that
    mixes languages, as long as its words are clear.  Null texts and texts without a letter are ``und`` with score and sure 0, and so is every
    text if nothing could be learned.  Every word of every text is labelled."""
    types_of = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    schema = ", ".join(f"`{c}` {types_of[c]}" for c in carry) + ", lang_pred string, score double, sure double"
    tag = f"{zlib.crc32(model['weights'].tobytes()):x}-{len(model['labels'])}"
    shared = docs.sparkSession.sparkContext.broadcast(model)   # FEATURES x labels numbers

    def run(batch):
        held = kept("language")
        if held.get("tag") != tag:
            held.update(tag=tag, cache={})
        names, pred, score, sure = shared.value["labels"], [], [], []
        group, chars = [], 0
        texts = batch.column("text").to_pylist()
        for i, t in enumerate(texts):
            group.append(t)
            chars += len(t or "")
            if chars >= BATCH_CHARS or i == len(texts) - 1:
                for words, m in word_marginals(group, shared.value, held["cache"]):
                    if len(words) and names:
                        mean = m.mean(axis=0)
                        pred.append(names[int(mean.argmax())])
                        score.append(float(min(1.0, mean.max())))
                        sure.append(float(min(1.0, m.max(axis=1).mean())))
                    else:
                        pred.append(UNKNOWN)
                        score.append(0.0)
                        sure.append(0.0)
                group, chars = [], 0
        return {**{c: batch.column(c) for c in carry}, "lang_pred": pred, "score": score, "sure": sure}

    return map_batches(docs.select(*dict.fromkeys((*carry, "text"))), schema, run, owner="language")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    out = predict(docs, train(docs))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
