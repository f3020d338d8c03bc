"""Quality rules: base counts per text and cross-document line frequency (DataFrame functions only)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import read_table

from .base import WORD, let, text_of

MIN_DOCS = 20          # a line is boilerplate only above this many documents of its host ...
MIN_SHARE = 0.01       # ... and above this share of the host's documents
MIN_LEFT = 0.5         # a document with a smaller share of its words left is depleted
SALTS = 16


def repeated_words(words: Column, width: int = 5) -> Column:
    """Words inside a ``width``-word window that occurs at least twice in the text.

    Windows are 64-bit hashes of word hashes.  Texts without a repeated window stop
    after one hash-set pass; the others sort (window, position) pairs, keep pairs with
    an equal neighbour and add up the union of their word ranges."""
    def windows(h: Column) -> Column:
        return F.transform(F.slice(h, F.lit(1), F.greatest(F.size(h) - (width - 1), F.lit(0))),
                           lambda x, i: F.xxhash64(x, *[F.get(h, i + k) for k in range(1, width)]))

    def covered(pairs: Column) -> Column:
        same = F.filter(pairs, lambda p, i: F.coalesce(p["h"] == F.get(pairs, i - 1)["h"], F.lit(False))
                        | F.coalesce(p["h"] == F.get(pairs, i + 1)["h"], F.lit(False)))
        at = F.array_sort(F.transform(same, lambda p: p["i"]))
        return let(at, lambda a: F.aggregate(
            F.transform(a, lambda x, i: F.least(F.lit(width), F.coalesce(F.get(a, i + 1) - x, F.lit(width)))),
            F.lit(0), lambda s, x: s + x))

    def count(w: Column) -> Column:
        pairs = F.array_sort(F.transform(w, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0)).otherwise(let(pairs, covered))

    hashes = F.transform(words, lambda w: F.xxhash64(w))
    return let(hashes, lambda h: let(windows(h), count)).cast("long")


def plain(line: Column) -> Column:
    """A line in lower case, white space collapsed and trimmed."""
    return F.trim(F.regexp_replace(F.lower(line), r"[\x20\x09-\x0D]+", " "))


def line_hash(line: Column) -> Column:
    """Hash of a line's ``plain`` form."""
    return F.xxhash64(plain(line))


def hash_and_words(line: Column) -> Column:
    """``line_hash`` and number of words of a line that has one: its spaces are those between words."""
    return let(plain(line), lambda x: F.struct(
        F.xxhash64(x).alias("h"), (F.length(x) - F.length(F.replace(x, F.lit(" "), F.lit(""))) + 1).alias("n")))


def measure(docs: DataFrame) -> DataFrame:
    """``docs`` with the base counts, ``base_failed``, ``text_hash`` and ``lines``: the
    (hash, words) of every line that has a word.  Null text counts as empty."""
    text = text_of()
    words = F.regexp_extract_all(text, F.lit(f"({WORD})"), F.lit(1))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    by_word = let(words, lambda w: F.struct(          # a text's words are found once
        F.size(w).cast("long").alias("n_words"), F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        repeated_words(w).alias("n_repeat_words")))
    out = docs.withColumn("__words", by_word).withColumns({
        "n_words": F.col("__words.n_words"),
        "word_chars": F.col("__words.word_chars"),
        "n_symbols": F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long"),
        "n_dup_lines": let(lines, lambda a: F.size(a) - F.size(F.array_distinct(a))).cast("long"),
        "n_repeat_words": F.col("__words.n_repeat_words"),
        "text_hash": F.xxhash64(text),
        "lines": F.transform(lines, hash_and_words),
    }).drop("__words")
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return out.withColumn("base_failed", failed)


def frequent_lines(measured: DataFrame, host: str = "source", min_docs: int = MIN_DOCS,
                   min_share: float = MIN_SHARE) -> DataFrame:
    """``(host, h)`` of the lines found in more than ``min_docs`` documents of a host and
    in more than ``min_share`` of them.

    Documents count once per different text, so a mirrored page is not evidence
    against its own lines.  Both steps combine on the map side: a line that a third
    of all documents hold reaches the reducers as one row per map task."""
    host_col = F.col(host).alias("host")
    docs = measured.select(host_col, "text_hash").distinct().groupBy("host").agg(F.count("*").alias("docs"))
    seen = (measured.select(host_col, "text_hash", F.explode(F.array_distinct(F.col("lines.h"))).alias("h"))
            .distinct().groupBy("host", "h").agg(F.count("*").alias("n")).where(F.col("n") > min_docs))
    docs = docs.select(F.col("host").alias("__host"), "docs")
    return (seen.join(docs, F.col("host").eqNullSafe(F.col("__host")))
            .where(F.col("n") > F.col("docs") * min_share).select("host", "h"))


def judge(docs: DataFrame, host: str = "source", min_docs: int = MIN_DOCS, min_share: float = MIN_SHARE,
          min_left: float = MIN_LEFT) -> DataFrame:
    """Base counts, ``removed`` (hashes of the document's boilerplate lines),
    ``words_left`` and ``kept`` for every row of ``docs`` (its text is not carried).

    ``kept`` is false for base_failed rows and for depleted ones: less than
    ``min_left`` of the words left once boilerplate lines are gone.  Null text is
    empty (base_failed).  A null host is a host of its own.  Equal rows get equal
    verdicts.  Joins match (host, line, salt) with the frequent side, small by
    construction, repeated per salt, so a hot line spreads over ``SALTS`` tasks."""
    base = measure(docs).drop("text")
    key = {"__k1": F.xxhash64(F.lit(1), F.col(host), "text_hash"),
           "__k2": F.xxhash64(F.lit(2), F.col(host), "text_hash")}
    frequent = frequent_lines(base, host, min_docs, min_share) \
        .select(F.coalesce(F.xxhash64("host"), F.lit(0)).alias("hk"), F.col("host").isNull().alias("hn"), "h",
                F.explode(F.array(*[F.lit(i) for i in range(SALTS)])).alias("salt"))
    texts = base.withColumns(key).groupBy("__k1", "__k2").agg(F.first("lines").alias("lines"),
                                                              F.first(host).alias("host"))
    lines = texts.select("__k1", "__k2", F.coalesce(F.xxhash64("host"), F.lit(0)).alias("hk"),
                         F.col("host").isNull().alias("hn"),
                         F.explode(F.array_distinct(F.col("lines.h"))).alias("h"),
                         F.pmod(F.col("__k1"), F.lit(SALTS)).cast("int").alias("salt"))
    removed = lines.join(frequent, ["hk", "hn", "h", "salt"]).groupBy("__k1", "__k2") \
        .agg(F.collect_set("h").alias("removed"))
    left = F.aggregate(F.filter("lines", lambda x: ~F.array_contains("removed", x["h"])),
                       F.lit(0), lambda s, x: s + x["n"]).cast("long")
    out = base.withColumns(key).join(removed, ["__k1", "__k2"], "left")
    out = out.withColumn("removed", F.coalesce("removed", F.array().cast("array<bigint>")))
    out = out.withColumn("words_left", left)
    return out.withColumn("kept", ~F.col("base_failed")
                          & (F.col("words_left") >= F.lit(min_left) * F.col("n_words"))) \
        .drop("__k1", "__k2", "lines")


def clean(docs: DataFrame, **options) -> DataFrame:
    """The kept documents with their boilerplate lines taken out of ``text``."""
    verdict = judge(docs, **options).where("kept") \
        .select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__h"), "removed").distinct()
    hit = docs.withColumn("__t", F.xxhash64(text_of())) \
        .join(verdict, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__t") == F.col("__h")))
    text = F.array_join(F.filter(F.split("text", "\n"), lambda x: ~F.array_contains("removed", line_hash(x))), "\n")
    return hit.withColumn("text", text).select(*docs.columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return judge(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                              "n_repeat_words", "base_failed", "kept", "words_left")


SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM d),
win AS (SELECT r, i, words[i:i + 4] AS g FROM w, unnest(generate_series(1, len(words) - 4)) AS u(i)),
dup AS (SELECT r, i FROM win WHERE (r, g) IN (SELECT (r, g) FROM win GROUP BY r, g HAVING count(*) > 1)),
rep AS (SELECT r, count(DISTINCT i + k) AS n FROM dup, unnest([0, 1, 2, 3, 4]) AS u(k) GROUP BY r),
ln AS (SELECT r, source, text, line, row_number() OVER () AS j FROM
       (SELECT r, source, text, unnest(string_split(text, chr(10))) AS line FROM d)
       WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
norm AS (SELECT *, trim(regexp_replace(lower(line), '[\x20\x09-\x0D]+', ' ', 'g')) AS nl,
                len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n FROM ln),
dl AS (SELECT r, count(*) - count(DISTINCT line) AS n FROM ln GROUP BY r),
hosts AS (SELECT source, count(DISTINCT text) AS docs FROM d GROUP BY source),
freq AS (SELECT norm.source, nl FROM norm GROUP BY norm.source, nl HAVING count(DISTINCT text) > 20),
cnt AS (SELECT source, nl, count(DISTINCT text) AS n FROM norm GROUP BY source, nl),
bad AS (SELECT cnt.source, cnt.nl FROM cnt JOIN hosts ON cnt.source IS NOT DISTINCT FROM hosts.source
        WHERE cnt.n > 20 AND cnt.n > hosts.docs * CAST(0.01 AS DOUBLE)),
lft AS (SELECT r, sum(n) AS n FROM norm WHERE NOT EXISTS
        (SELECT 1 FROM bad WHERE bad.nl = norm.nl AND bad.source IS NOT DISTINCT FROM norm.source) GROUP BY r),
m AS (SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words,
             CAST(len(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
             CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
             CAST(coalesce(dl.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words,
             CAST(coalesce(lft.n, 0) AS BIGINT) AS words_left
      FROM w LEFT JOIN rep USING (r) LEFT JOIN dl USING (r) LEFT JOIN lft USING (r)),
f AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND words_left >= 0.5 * n_words AS kept, words_left
FROM f
"""
