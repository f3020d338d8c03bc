"""Train / validation splits that depend on the rows only.

``random_split`` draws every row's part from a hash of its values and a seed: a projection,
so neither the input's layout nor the number of cores changes it.  Rows that occur more
than once are numbered, so that each copy draws for itself; only those are shuffled.
``key_split`` is a split by key bucket: the same key always lands in the same part.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType, BinaryType

from tessera.operators.joins import bounded_broadcast


def key_bucket(key, n_buckets: int, hashed: bool = True):
    k = F.col(key) if isinstance(key, str) else key
    h = F.xxhash64(k) if hashed else k
    return F.pmod(h, F.lit(n_buckets))


def key_split(df: DataFrame, key, train_buckets: int = 8, n_buckets: int = 10,
              hashed: bool = True, label_col: str = "part_name") -> DataFrame:
    """Label each row 'train' / 'validation' by ``bucket(key) < train_buckets``.

    ``hashed=False`` buckets an integer key by its own value (``key mod n``)."""
    bucket = key_bucket(key, n_buckets, hashed)
    return df.withColumn(label_col, F.when(bucket < train_buckets, F.lit("train"))
                         .otherwise(F.lit("validation")))


def split_parts(labelled: DataFrame, label_col: str = "part_name"):
    train = labelled.filter(F.col(label_col) == "train").drop(label_col)
    val = labelled.filter(F.col(label_col) == "validation").drop(label_col)
    return train, val


_LINE, _H1, _H2, _COPY = "__tessera_line", "__tessera_h1", "__tessera_h2", "__tessera_copy"
SEPARATOR, NULL = "\x1f", "\\N"
#: copies of one row that a task numbers at once
COPIES = 10_000


def row_line(df: DataFrame, columns=None) -> Column:
    """The row's values as one string: nulls as ``\\N``, nested values as JSON, in the
    order of ``columns`` (default: all)."""
    def text(name: str) -> Column:
        dtype, c = df.schema[name].dataType, F.col(f"`{name}`")
        if isinstance(dtype, BinaryType):
            c = F.hex(c)
        elif not isinstance(dtype, AtomicType):
            c = F.to_json(F.struct(c))
        return F.coalesce(c.cast("string"), F.lit(NULL))
    return F.concat_ws(SEPARATOR, *[text(c) for c in (columns or df.columns)])


def draw(line: Column, copy: Column, seed: int) -> Column:
    """A number in [0, 1): the first 52 bits of MD5 over seed, row and the copy's number."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), copy.cast("string"), line).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / float(16 ** 13)


def _label(value: Column, weights, names) -> Column:
    total = float(sum(weights))
    out = F.lit(names[-1])
    for bound, name in reversed(list(zip(accumulate(weights), names))[:-1]):
        out = F.when(value < bound / total, F.lit(name)).otherwise(out)
    return out


def random_split_labelled(df: DataFrame, weights=(0.8, 0.2), seed: int = 42,
                          names=("train", "validation"), label_col: str = "part_name",
                          by=None, distinct: bool = False) -> DataFrame:
    """``df`` with ``label_col``: each row's part, independent draws with the given weights.

    Equal rows are counted by hash first (map-side combined, 16 bytes a row); those that
    occur once, all of most tables, are then labelled where they lie.  Repeated rows are
    numbered copy by copy; a row of very many copies is spread over tasks by ``COPIES``.
    ``distinct=True`` says that there are no equal rows (or that they may share a draw):
    one projection.  ``by`` draws by some columns only, so rows that agree on them stay
    together; that needs no numbers either."""
    line = row_line(df, by)
    if by is not None or distinct:
        return df.withColumn(label_col, _label(draw(line, F.lit(1), seed), weights, names))
    hashes = [F.xxhash64(_LINE).alias(_H1), F.xxhash64(F.lit(1), _LINE).alias(_H2)]
    marked = df.withColumn(_LINE, line).select("*", *hashes)
    counts = marked.groupBy(_H1, _H2).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(_H1, _H2)
    repeated, _ = bounded_broadcast(counts)
    once = marked.join(repeated, [_H1, _H2], "left_anti").withColumn(_COPY, F.lit(1).cast("long"))
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    groups = marked.join(repeated, [_H1, _H2], "left_semi").groupBy(_LINE).agg(F.count(F.lit(1)).alias("n"), F.first(row).alias("row"))
    blocks = groups.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / COPIES)))) \
        .repartition(F.xxhash64(_LINE, "block"))
    low = F.col("block") * COPIES
    copies = blocks.withColumn(_COPY, F.explode(F.sequence(low + 1, F.least(low + COPIES, F.col("n")))))
    again = copies.select(*[F.col("row")[c].alias(c) for c in df.columns], _LINE, _COPY)
    rows = once.select(*[F.col(f"`{c}`") for c in df.columns], _LINE, _COPY).unionByName(again)
    label = _label(draw(F.col(_LINE), F.col(_COPY), seed), weights, names)
    return rows.select(*[F.col(f"`{c}`") for c in df.columns], label.alias(label_col))


def random_split(df: DataFrame, weights=(0.8, 0.2), seed: int = 42, by=None, distinct: bool = False) -> list:
    """One frame per weight, see ``random_split_labelled``."""
    names = [str(i) for i in range(len(weights))]
    part = "__tessera_part"
    labelled = random_split_labelled(df, weights, seed, names, part, by, distinct)
    return [labelled.filter(F.col(part) == n).drop(part) for n in names]
