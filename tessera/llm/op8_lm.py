"""Language-model scoring: stupid backoff over tables of n-gram counts partitioned by hash.

All words of all texts count, up to trigrams, with no vocabulary.  A document is scored by
the counts of all other rows: the whole table's counts less its own.  So a text that occurs
twice, or shares passages with others, scores higher than one that stands alone."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import read_table

from .base import give_back, hash_words, mix, stored, text_of

BACKOFF = 0.4
BLOCK_CHARS = 4 << 20        # characters of the texts that are counted and scored together
BUCKET_GRAMS = 4_000_000     # exploded n-grams a bucket should hold, before those of a block are summed
WORD_CHARS = 6               # characters a word, by which the number of buckets is chosen
#: keys of the empty n-gram, counted once a word, and of the start of a text, once a text with words
NOTHING, START = np.uint64(0x51ED270B7F4A7C15), np.uint64(0x2545F4914F6CDD1D)
SPECIAL = np.array([NOTHING, START], np.uint64)


def text_blocks(docs: DataFrame) -> DataFrame:
    """(home, ids, texts, chars): rows of about ``BLOCK_CHARS`` characters, stored."""
    from pyspark.sql.pandas.types import to_arrow_type

    id_type = docs.schema["doc_id"].dataType
    id_arrow = to_arrow_type(id_type)

    def run(batches):
        home = TaskContext.get().partitionId() << 32
        for b in batches:
            ids, texts = b.column("doc_id"), b.column("text")
            ends = np.cumsum(pa.compute.utf8_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
            part = (ends - 1) // BLOCK_CHARS if len(ends) else ends
            edges = np.concatenate(([0], np.flatnonzero(np.diff(part)) + 1, [len(ends)])).tolist()
            for x, y in zip(edges[:-1], edges[1:]):
                if y > x:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([home], pa.int64()), pa.array([ids[x:y].to_pylist()], pa.list_(id_arrow)),
                         pa.array([texts[x:y].to_pylist()], pa.list_(pa.string())), pa.array([int(ends[y - 1] - (ends[x - 1] if x else 0))])],
                        names=["home", "ids", "texts", "chars"])
                    home += 1

    return stored(docs.select("doc_id", text_of().alias("text")).mapInArrow(
        run, f"home bigint, ids array<{id_type.simpleString()}>, texts array<string>, chars bigint"), "texts", "zstd")


def explode(texts: list):
    """Keys of the unigrams, bigrams and trigrams that end at each word, the text of each
    word, whether it is its text's first, and the texts' numbers of words.

    The start of a text counts as the word before its first; a first word has no trigram."""
    words, sizes = hash_words(texts)
    first = np.zeros(len(words), bool)
    first[(np.cumsum(sizes) - sizes)[sizes > 0]] = True
    before = np.concatenate(([START], words[:-1])) if len(words) else words
    before[first] = START
    with np.errstate(over="ignore"):
        a, b, c = mix(np.arange(1, 4, dtype=np.uint64)) | np.uint64(1)
        two = before * a + words * b
        three = (np.concatenate(([START], before[:-1])) if len(words) else words) * c + two
        keys = [mix(words + a), mix(two + b), mix(three + c)[~first]]
    return keys, np.repeat(np.arange(len(sizes)), sizes), first, sizes


def packed(n: np.ndarray, wide=np.int64) -> bytes:
    """Numbers as one byte each, those from 255 on as ``wide`` behind them."""
    return np.minimum(n, 255).astype(np.uint8).tobytes() + n[n >= 255].astype(wide).tobytes()


def unpacked(data: bytes, size: int, wide=np.int64) -> np.ndarray:
    n = np.frombuffer(data, np.uint8, size).astype(np.int64)
    n[n == 255] = np.frombuffer(data[size:], wide)
    return n


def in_buckets(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket and, below it, name of each key in one number.

    A name is 48 bits of a key (fewer beyond 65,536 buckets), which tell it from the others of
    its bucket (two of four million are taken for one with a chance of about 1e-8 each)."""
    bits = min(48, 64 - (buckets - 1).bit_length())
    bucket = (mix(keys) >> np.uint64(40)) % np.uint64(buckets)
    return (bucket << np.uint64(bits)) | (keys & np.uint64((1 << bits) - 1))


def tallied(tokens: np.ndarray, sizes: np.ndarray, buckets: int):
    """Of ascending tokens: the first of each gram, the grams with ``SPECIAL`` among them and
    their counts, the places of the grams and of ``SPECIAL``, (bucket, from, to)."""
    new = np.concatenate(([True], tokens[1:] != tokens[:-1])) if len(tokens) else np.zeros(0, bool)
    begin = np.flatnonzero(new)
    special = in_buckets(SPECIAL, buckets)
    grams = np.concatenate((tokens[begin], special))
    n = np.concatenate((np.diff(begin, append=len(tokens)), [sizes.sum(), (sizes > 0).sum()]))
    order = np.argsort(grams, kind="stable")
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    grams, bits = grams[order], min(48, 64 - (buckets - 1).bit_length())
    bucket = (grams >> np.uint64(bits)).astype(np.int64)
    edges = np.concatenate(([0], np.flatnonzero(np.diff(bucket)) + 1, [len(grams)])).tolist()
    spans = [(int(bucket[x]), x, y) for x, y in zip(edges[:-1], edges[1:])]
    return new, grams & np.uint64((1 << bits) - 1), n[order], place[:-2], place[-2:], spans


def gaps(names: np.ndarray) -> bytes:
    """Steps of the upper 16 bits of ascending names, most of them below 255."""
    return packed(np.diff((names >> np.uint64(32)).astype(np.int64), prepend=0), np.uint16)


def names_of(steps: bytes, low: bytes) -> np.ndarray:
    low = np.frombuffer(low, np.uint32).astype(np.uint64)
    return (np.cumsum(unpacked(steps, len(low), np.uint16)).astype(np.uint64) << np.uint64(32)) | low


def totals(blocks: DataFrame, buckets: int) -> DataFrame:
    """(home, bucket, ns): for every n-gram of a block its count in all other blocks, stored.

    A block sends each of its n-grams once, with its count there, to the bucket its hash
    names; so a very common n-gram is one key a block, and no bucket is hot."""
    def send(batches):
        for b in batches:
            for i in range(b.num_rows):
                home = b.column("home")[i].as_py()
                keys, _, _, sizes = explode(b.column("texts")[i].as_py())
                tokens = in_buckets(np.concatenate(keys), buckets)
                del keys
                tokens.sort()
                _, names, n, _, _, spans = tallied(tokens, sizes, buckets)
                del tokens
                yield pa.RecordBatch.from_arrays(
                    [pa.array([p for p, _, _ in spans], pa.int32()), pa.array([home] * len(spans), pa.int64()),
                     pa.array([gaps(names[x:y]) for _, x, y in spans], pa.binary()),
                     pa.array([names[x:y].astype(np.uint32).tobytes() for _, x, y in spans], pa.binary()),
                     pa.array([packed(n[x:y]) for _, x, y in spans], pa.binary())], names=["bucket", "home", "steps", "low", "ns"])
                give_back()

    def add(table: pa.Table) -> pa.Table:
        steps, low, ns = (table.column(c).to_pylist() for c in ("steps", "low", "ns"))
        ends = np.cumsum([len(k) // 4 for k in low]).tolist()
        _, at = np.unique(np.concatenate([names_of(g, k) for g, k in zip(steps, low)]), return_inverse=True)
        own = np.concatenate([unpacked(n, len(k) // 4) for k, n in zip(low, ns)])
        rest = np.bincount(at, own).astype(np.int64)[at] - own
        out = [packed(rest[x:y]) for x, y in zip([0, *ends[:-1]], ends)]
        give_back()
        return pa.table({"home": table.column("home"), "bucket": table.column("bucket"), "ns": pa.array(out, pa.binary())})

    sent = blocks.select("home", "texts").mapInArrow(send, "bucket int, home bigint, steps binary, low binary, ns binary")
    return stored(sent.groupBy("bucket").applyInArrow(add, "home bigint, bucket int, ns binary"), "totals", "zstd")


def others(keys: list, doc: np.ndarray, first: np.ndarray, sizes: np.ndarray, answers: list, buckets: int) -> tuple:
    """Counts in all other rows of each word's unigram, bigram and trigram (0 at a first
    word), and of all words and of all starts for each text."""
    tokens, whose = in_buckets(np.concatenate(keys), buckets), np.concatenate((doc, doc, doc[~first]))
    order = np.argsort(tokens, kind="stable")          # so a gram's tokens are in the order of their texts
    tokens, whose = tokens[order], whose[order]
    new, _, total, place, special, spans = tallied(tokens, sizes, buckets)
    total = total + np.concatenate([unpacked(ns, y - x) for ns, (_, x, y) in zip(answers, spans)])
    gram = np.cumsum(new) - 1
    new[1:] |= whose[1:] != whose[:-1]
    own = np.diff(np.flatnonzero(new), append=len(new))
    counts = np.empty(len(order), np.int64)
    counts[order] = total[place[gram]] - own[np.cumsum(new) - 1]
    three = np.zeros(len(doc), np.int64)
    three[~first] = counts[2 * len(doc):]
    words, starts = total[special]
    return counts[:len(doc)], counts[len(doc):2 * len(doc)], three, words - sizes, starts - (sizes > 0)


def score(docs: DataFrame, backoff: float = BACKOFF) -> DataFrame:
    """doc_id, n_words, log_prob and score (log_prob / n_words) for every row of ``docs``.

    With c the counts in all other rows and N their words: S(w | u v) = c(uvw) / c(uv) if that
    is not 0, else backoff * S(w | v); S(w | v) = c(vw) / c(v), else backoff * S(w); S(w) =
    c(w) / N, else the floor backoff / N (N at least 1).  A text's first word has the start of
    a text before it and begins at S(w | start), its second at S(w | start v).

    Null and empty texts have no words: log_prob 0, score null.  Repeated rows are rows like
    others and score each other; ties cannot matter; an empty table gives none.  Other columns
    are not read.  A text is handled by one task, which holds about 100 bytes a word of it."""
    from pyspark.sql.pandas.types import to_arrow_type

    id_type = docs.schema["doc_id"].dataType
    id_arrow = to_arrow_type(id_type)
    blocks = text_blocks(docs)
    chars = blocks.agg(F.sum("chars")).first()[0] or 0
    buckets = int(max(8, 3 * chars // WORD_CHARS // BUCKET_GRAMS + 1))
    counted = totals(blocks, buckets)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        ids, texts = left.column("ids")[0].as_py(), left.column("texts")[0].as_py()
        keys, doc, first, sizes = explode(texts)
        answers = [ns for _, ns in sorted(zip(right.column("bucket").to_pylist(), right.column("ns").to_pylist()))]
        one, two, three, words, starts = others(keys, doc, first, sizes, answers, buckets)
        v, uv = np.concatenate(([0], one[:-1])), np.concatenate(([0], two[:-1]))
        v = np.where(first, starts[doc], v[:len(doc)])
        size, back = np.maximum(words[doc], 1), math.log(backoff)
        with np.errstate(divide="ignore", invalid="ignore"):
            p = np.where(one > 0, np.log(one), back) - np.log(size) + back
            p = np.where(two > 0, np.log(two) - np.log(v), p)
            p = np.where(first, p, np.where(three > 0, np.log(three) - np.log(uv[:len(doc)]), p + back))
        total = np.bincount(doc, p, len(sizes)).astype(np.float64)
        mean = [float(x / n) if n else None for x, n in zip(total, sizes)]
        give_back()
        return pa.table({"doc_id": pa.array(ids, id_arrow), "n_words": pa.array(sizes),
                         "log_prob": pa.array(total), "score": pa.array(mean, pa.float64())})

    return blocks.select("home", "ids", "texts").groupBy("home").cogroup(counted.groupBy("home")) \
        .applyInArrow(run, f"doc_id {id_type.simpleString()}, n_words bigint, log_prob double, score double")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(read_table(spark, sf_dir, "documents"))
