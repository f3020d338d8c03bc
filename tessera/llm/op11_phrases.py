"""Phrase collocation mining by stripes: every prefix keys a counter of its next words.

A task folds its texts into stripes, kept flat as sorted (prefix, next word, count) entries;
equal entries are added up elementwise, in the task first and across tasks after.  A merged
stripe holds the extensions of its prefix (the candidates one word longer), and its largest
entry says whether one of them subsumes the prefix; the same stripes read from the other
end say it of extensions to the left.  Totals of prefixes are their own entries in the
stripes one word shorter, those of single words the stripe of the empty prefix.

A phrase of at least ``least`` occurrences has no part of fewer, so entries are made only
where the words (for pairs) or all pairs inside (for longer phrases) are frequent.  Tasks
know these from a Bloom filter of bounded size: what it lets through wrongly is counted and
then found too rare."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.session import read_table

from .base import arrow_types, by_bucket, give_back, map_batches, mix, small, stored

LONGEST = 5                  # words of a phrase
LEAST = 100                  # occurrences of a candidate
TOP = 2000                   # phrases reported a language
UNKNOWN = "und"
SHIFT = 1000                 # scores are thousandths
PORTION = 4_000_000          # bytes of text folded at once
BUCKET_ROWS = 2_000_000      # entries a bucket should hold
FILTER_BITS = 1 << 28        # of a Bloom filter at most (32 MB)
SECTIONS = 64                # parts in which a filter is put together
PROBES = 3

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: one byte for another: letters lowered, a tab as a space, what ends a piece as a newline
FOLD = bytes.maketrans((UPPER + "\t.,;:!?\n\x0b\x0c\r").encode(), (LOWER + " " + "\n" * 10).encode())
WORD_END = r"[.,;:!?\x09-\x0D\x20]+"


def hashed(tokens: list) -> np.ndarray:
    from pandas.util import hash_array

    return hash_array(np.array(tokens, dtype=object), categorize=False) if tokens else np.zeros(0, np.uint64)


def first_key(words: np.ndarray, lang: np.ndarray) -> np.ndarray:
    """Key of single words of a language."""
    return mix(words ^ mix(lang))


def longer_key(prefix: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Key of a phrase from its prefix's key and its last word's."""
    with np.errstate(over="ignore"):
        return mix(prefix * np.uint64(0x9E3779B97F4A7C15) + word)


def text_portions(langs: list, texts: list):
    """(language, folded bytes) of about ``PORTION`` bytes or one text each."""
    held = {}
    for lang, text in zip(langs, texts):
        if text:
            parts, size = held.get(lang, ([], 0))
            parts.append(text)
            size += len(text)
            if size >= PORTION:
                yield lang, "\n".join(parts).encode().translate(FOLD)
                held.pop(lang)
            else:
                held[lang] = parts, size
    for lang, (parts, _) in held.items():
        yield lang, "\n".join(parts).encode().translate(FOLD)


def word_stream(lang: str, data: bytes, cut: int = PORTION):
    """Keys of the words of a folded text in order, 0 between pieces; very long texts in
    portions cut where a piece ends, or where a word ends if a piece alone is longer (then
    the last words come again in the next one, and ``fresh`` is where it starts anew)."""
    marks = hashed([b"", b"\n", lang.encode()])
    at, tail = 0, []
    while at < len(data):
        end = len(data)
        if end - at > cut:
            newline = data.find(b"\n", at + cut, at + 2 * cut)
            space = data.find(b" ", at + 2 * cut) if newline < 0 else newline
            end = space + 1 if space >= 0 else end
        tokens = data[at:end].replace(b"\n", b" \n ").split(b" ")
        words = hashed(tokens)
        words = words[words != marks[0]]
        ended = words == marks[1]
        keys = first_key(words, marks[2:])
        keys[ended] = 0
        stream = np.concatenate((np.array(tail, np.uint64), keys))
        yield stream, len(tail)
        tail = stream[-(LONGEST - 1):].tolist()
        at = end


def frequent_words(docs: DataFrame, least: int) -> tuple:
    """(totals: lang, n), (words: lang, word, f, key) with ``least`` occurrences, both stored."""
    text = F.translate(F.coalesce("text", F.lit("")), UPPER, LOWER)
    lang = F.coalesce("lang", F.lit(UNKNOWN)).alias("lang")
    counts = docs.select(lang, F.explode(F.split(text, WORD_END)).alias("word")).where("word <> ''") \
        .groupBy("lang", "word").agg(F.count("*").alias("f"))
    counts = stored(counts, "words")
    totals = stored(counts.groupBy("lang").agg(F.sum("f").alias("n")), "totals")

    def run(batch):
        langs = hashed([x.encode() for x in batch.column("lang").to_pylist()])
        words = hashed([x.encode() for x in batch.column("word").to_pylist()])
        return {**{c: batch.column(c) for c in ("lang", "word", "f")}, "key": first_key(words, langs).view(np.int64)}

    words = map_batches(counts.where(F.col("f") >= least), "lang string, word string, f bigint, key bigint", run)
    return totals, stored(words, "frequent-words")


def positions(keys: np.ndarray, bits: int, probe: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(keys + np.uint64(probe + 1) * np.uint64(0xD1B54A32D192ED03)) % np.uint64(bits)


class Filter:
    """A Bloom filter over 64-bit keys, broadcast to the tasks."""

    def __init__(self, frame: DataFrame, column: str):
        """All keys of a column; its bits are set by sections on the executors."""
        n = frame.count()
        self.bits = min(FILTER_BITS, max(1 << 16, 1 << (16 * n).bit_length()))
        bits, width = self.bits, self.bits // SECTIONS

        def spread(batches):
            for batch in batches:
                keys = batch.column(0).to_numpy().view(np.uint64)
                at = np.unique(np.concatenate([positions(keys, bits, p) for p in range(PROBES)]))
                cuts = np.searchsorted(at, np.arange(SECTIONS + 1, dtype=np.uint64) * np.uint64(width))
                rows = [(s, (at[a:b] - np.uint64(s * width)).astype(np.uint32).tobytes())
                        for s, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])) if a < b]
                s, b = zip(*rows) if rows else ((), ())
                yield pa.RecordBatch.from_arrays([pa.array(s, pa.int32()), pa.array(b, pa.binary())], names=["section", "at"])

        def put(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own = np.zeros(width, bool)
            for batch in batches:
                for at in batch.column("at").to_pylist():
                    own[np.frombuffer(at, np.uint32)] = True
            yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([np.packbits(own).tobytes()], pa.binary())],
                                             names=["section", "bits"])

        sections = frame.select(column).mapInArrow(spread, "section int, at binary").groupBy("section") \
            .applyInArrow(put, "section int, bits binary")
        table = np.zeros(bits // 8, np.uint8)
        for row in sections.toLocalIterator():              # SECTIONS rows, FILTER_BITS / 8 bytes at most
            table[row.section * (width // 8):(row.section + 1) * (width // 8)] = np.frombuffer(row.bits, np.uint8)
        self.table = frame.sparkSession.sparkContext.broadcast(table)

    def has(self, keys: np.ndarray) -> np.ndarray:
        table, found = self.table.value, np.ones(len(keys), bool)
        for p in range(PROBES):
            at = positions(keys[found], self.bits, p)
            found[found] = table[at >> np.uint64(3)] >> (np.uint64(7) - (at & np.uint64(7))).astype(np.uint8) & 1 > 0
        return found


def folded(prefix: np.ndarray, word: np.ndarray, count: np.ndarray | None = None) -> tuple:
    """Entries with equal (prefix, word) added up."""
    order = np.lexsort((word, prefix))
    prefix, word = prefix[order], word[order]
    first = np.flatnonzero(np.concatenate(([True], (prefix[1:] != prefix[:-1]) | (word[1:] != word[:-1])))) if len(prefix) \
        else np.zeros(0, np.int64)
    if count is None:
        total = np.diff(np.concatenate((first, [len(prefix)])))
    else:
        total = np.add.reduceat(count[order], first) if len(first) else np.zeros(0, np.int64)
    return prefix[first], word[first], total


def pairs(stream: np.ndarray, fresh: int, words: Filter) -> list:
    """(prefix, next word) of all pairs of frequent words that end at ``fresh`` or behind it."""
    known = (stream != 0) & words.has(stream)
    at = np.flatnonzero(known[:-1] & known[1:])
    at = at[at + 1 >= fresh]
    return [(stream[at], stream[at + 1])]


def longer(stream: np.ndarray, fresh: int, couples: Filter) -> list:
    """The same for three to ``LONGEST`` words, all of whose pairs are frequent, one list a length."""
    prefix = longer_key(stream[:-1], stream[1:])
    solid = (stream[:-1] != 0) & (stream[1:] != 0)
    solid[solid] = couples.has(prefix[solid])
    at, out = np.flatnonzero(solid), []
    prefix = prefix[at]
    for n in range(3, LONGEST + 1):
        more = at + n - 2 < len(solid)
        more[more] = solid[at[more] + n - 2]
        at, prefix = at[more], prefix[more]
        word = stream[at + n - 1]
        new = at + n - 1 >= fresh
        out.append((prefix[new], word[new]))
        prefix = longer_key(prefix, word)
    return out


def stripes(docs: DataFrame, entries, known: Filter, shortest: int, total: int, least: int) -> DataFrame:
    """(size, prefix, word, f): merged stripe entries of at least ``least``, stored.

    ``entries`` lists the (prefix, word) entries of a stream, phrases of ``shortest`` words
    first.  Entries are dealt by prefix and word, so the stripe of a very frequent prefix is
    merged in many tasks; equal entries are one a portion before they are sent."""
    buckets = int(max(8, total // BUCKET_ROWS + 1))
    sent = "size int, bucket int, prefixes binary, words binary, counts binary"
    types = arrow_types(sent)

    def send(batches):
        for batch in batches:
            langs = [x if x is not None else UNKNOWN for x in batch.column("lang").to_pylist()]
            for lang, data in text_portions(langs, batch.column("text").to_pylist()):
                for stream, fresh in word_stream(lang, data):
                    rows = []
                    for size, (prefix, word) in enumerate(entries(stream, fresh, known), shortest):
                        prefix, word, count = folded(prefix, word)
                        order, spans = by_bucket(longer_key(prefix, word), buckets)
                        prefix, word, count = prefix[order], word[order], count[order].astype(np.uint32)
                        rows += [(size, p, prefix[a:b].tobytes(), word[a:b].tobytes(), count[a:b].tobytes()) for p, a, b in spans]
                    columns = zip(*rows) if rows else ([] for _ in types)
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)],
                                                     names=["size", "bucket", "prefixes", "words", "counts"])
        give_back()

    def merge(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, waiting = (np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64)), []

        def settle():
            columns = [np.concatenate(c) for c in zip(held, *waiting)]
            return folded(*columns)

        for batch in batches:
            for p, w, c in zip(*(batch.column(x).to_pylist() for x in ("prefixes", "words", "counts"))):
                waiting.append((np.frombuffer(p, np.uint64), np.frombuffer(w, np.uint64), np.frombuffer(c, np.uint32).astype(np.int64)))
            if sum(len(x[0]) for x in waiting) > max(BUCKET_ROWS // 2, len(held[0])):
                held, waiting = settle(), []
        prefix, word, count = settle()
        often = count >= least
        n = int(often.sum())
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()] * n, pa.int32()), pa.array(prefix[often].view(np.int64)),
                                          pa.array(word[often].view(np.int64)), pa.array(count[often])],
                                         names=["size", "prefix", "word", "f"])
        give_back()

    made = docs.select("lang", "text").mapInArrow(send, sent)
    merged = made.groupBy("size", "bucket").applyInArrow(merge, "size int, prefix bigint, word bigint, f bigint")
    return stored(merged, f"stripes-{shortest}")


def phrase_keys(entries: DataFrame) -> DataFrame:
    """``entries`` with key, that of the whole phrase."""
    return map_batches(entries, "size int, prefix bigint, word bigint, f bigint, key bigint", lambda b: {
        **{c: b.column(c) for c in ("size", "prefix", "word", "f")},
        "key": longer_key(*(b.column(c).to_numpy().view(np.uint64) for c in ("prefix", "word"))).view(np.int64)})


def collocations(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """lang, phrase, size, f, firsts (of its first 1, 2, ... words), rests (of the rest
    behind them) and longer, the most occurrences of a candidate that holds it and one word
    more, of every phrase of two to ``LONGEST`` words and ``least`` occurrences; and n, the
    language's words.

    Null texts are empty, a null lang is ``und``, repeated rows count again; texts of any
    length are counted whole, in portions.  Other columns than text and lang are not looked
    at.  Keys are 64-bit hashes: only two of the frequent prefixes can be taken for one
    another, whose number is at most a hundredth of the words."""
    totals, words = frequent_words(docs, least)
    total = int(totals.agg(F.sum("n")).first()[0] or 0)
    two = phrase_keys(stripes(docs, pairs, Filter(words, "key"), 2, total, least))
    two = stored(two, "pairs")
    more = stored(phrase_keys(stripes(docs, longer, Filter(two, "key"), 3, total, least)), "longer")

    shorter = words.select("lang", F.col("word").alias("phrase"), "f", "key",
                           F.array().cast("array<bigint>").alias("firsts"), F.array().cast("array<bigint>").alias("rests"))
    last = words.select(F.col("lang").alias("wl"), F.col("key").alias("word"), F.col("word").alias("last"))
    levels = []
    for size in range(2, LONGEST + 1):
        own = (two if size == 2 else more).where(F.col("size") == size).select("prefix", "word", "f", "key")
        head = shorter.select("lang", F.col("phrase").alias("head"), F.col("f").alias("hf"), F.col("key").alias("prefix"),
                              F.col("firsts").alias("hfirsts"))
        tail = shorter.select(F.col("lang").alias("tl"), F.col("phrase").alias("tail"), F.col("f").alias("tf"), F.col("rests").alias("trests"))
        named = own.join(head, "prefix").join(last, "word").where("lang = wl") \
            .withColumn("phrase", F.concat_ws(" ", "head", "last"))
        named = named.withColumn("tail", F.expr("substring(phrase, locate(' ', phrase) + 1)")) \
            .join(tail.withColumnRenamed("tl", "lang"), ["lang", "tail"])
        shorter = stored(named.select("lang", "phrase", "f", "key", F.concat("hfirsts", F.array("hf")).alias("firsts"),
                                      F.concat(F.array("tf"), "trests").alias("rests"), "head", "tail"), f"phrases-{size}")
        levels.append(shorter.select("lang", "phrase", "f", "firsts", "rests", "head", "tail", F.lit(size).alias("size")))
    every = levels[0]
    for level in levels[1:]:
        every = every.unionByName(level)
    wider = every.where("size > 2")
    grown = wider.select("lang", F.col("head").alias("phrase"), "f").unionByName(wider.select("lang", F.col("tail").alias("phrase"), "f")) \
        .groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    return every.join(grown, ["lang", "phrase"], "left").join(small(totals), "lang") \
        .select("lang", "phrase", "size", "f", "firsts", "rests", "longer", "n")


def ranked(found: DataFrame, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: of the candidates that no longer one subsumes,
    the ``top`` ones of each language by score, then occurrences, then the phrase's bytes.
    A score is that of the lowest-scoring cut, of equal ones the first."""
    own = found.where("longer is null or longer < f")
    score = "cast(cast({} as decimal(38,0)) * f * n div (cast(l as decimal(38,0)) * r) as bigint)".format(SHIFT)
    cuts = F.transform(F.arrays_zip("firsts", "rests"), lambda x, i: F.struct(x.firsts.alias("l"), x.rests.alias("r"), i.alias("k")))
    flat = own.select("lang", "phrase", "f", "n", F.inline(cuts)).withColumn("score", F.expr(score))
    best = flat.groupBy("lang", "phrase", "f", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("best")) \
        .select("lang", "phrase", F.col("f").alias("a"), "n", "best.*")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top) \
        .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked(collocations(read_table(spark, sf_dir, "documents")))


SQL = r"""
WITH pieces AS (
  SELECT doc_id, row_number() OVER () AS d, coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
lists AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces),
grams AS (
  SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
  FROM lists, (SELECT unnest(range(1, 6)) AS k) WHERE len(w) >= k),
f AS (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
candidates AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k >= 2 AND f >= 100),
inside AS (
  SELECT DISTINCT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, a
  FROM (SELECT *, unnest(range(1, k - m + 2)) AS i FROM (SELECT *, unnest(range(2, k)) AS m FROM candidates))),
own AS (
  SELECT c.* FROM candidates c
  WHERE NOT EXISTS (SELECT 1 FROM inside s WHERE s.lang = c.lang AND s.phrase = c.phrase AND 100 * s.a >= 100 * c.a)),
cuts AS (
  SELECT o.lang, o.phrase, o.a, cut, array_to_string(w[:cut], ' ') AS head, array_to_string(w[cut + 1:], ' ') AS rest
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM own) o),
scored AS (
  SELECT c.lang, c.phrase, c.a, c.cut, x.f AS l, y.f AS r, t.n,
         ((1000::HUGEINT * c.a * t.n) // (x.f::HUGEINT * y.f))::BIGINT AS score
  FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = c.head JOIN f y ON y.lang = c.lang AND y.phrase = c.rest
  JOIN totals t ON t.lang = c.lang),
least AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM least QUALIFY rank <= 2000"""
