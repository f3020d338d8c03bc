"""Helpers shared by the training-data operators: words, scratch tables, Arrow maps, components."""

from __future__ import annotations

import ctypes
import re
import sys
import types
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.session import scratch_path

#: a word: a run of characters other than the six ASCII white-space characters
WORD = r"[^\x20\x09-\x0D]+"
WORD_RE = re.compile(WORD)

#: rows and bytes up to which a small side may be broadcast; beyond either the same join shuffles
BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 32 << 20

DOC_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def text_of(col: str = "text") -> Column:
    """The text, a null one as the empty string."""
    return F.coalesce(F.col(col), F.lit(""))


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once.

    A lambda that refers to an outer *expression* evaluates it again for every
    element; bound as a lambda variable it is evaluated once per row."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


#: Spark's setting by which a query's shuffle files are removed once it has ended
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: and that for the rows of an Arrow batch (none or less: no limit)
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def stored(df: DataFrame, name: str, compression: str | None = None, batch_rows: int = 0) -> DataFrame:
    """Cut lineage: write to the shared checkpoint folder and read back.

    Nothing reads the write's own shuffles afterwards, so Spark removes their files then.
    ``batch_rows`` lowers the rows of an Arrow batch, of which an executor holds one a task
    outside its heap and the task's worker another."""
    path = scratch_path(df.sparkSession, f"llm-{name}")
    conf = df.sparkSession.conf
    before = {k: conf.get(k) for k in (CLEANUP, BATCH_ROWS)}
    conf.set(CLEANUP, "true")
    if batch_rows and not 0 < int(before[BATCH_ROWS]) < batch_rows:
        conf.set(BATCH_ROWS, str(batch_rows))
    try:
        df.write.parquet(path, compression=compression)
    finally:
        for k, v in before.items():
            conf.set(k, v)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.stored_at = path
    return table


def discard(*tables: DataFrame) -> None:
    """Delete ``stored`` tables that nothing still to be run reads."""
    for table in tables:
        spark = table.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(table.stored_at)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def small(df: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> DataFrame:
    """Mark a stored table for broadcast only if it has at most ``rows`` rows and ``size`` bytes."""
    wide = [F.coalesce(F.octet_length(f.name), F.lit(0)) if f.dataType.simpleString() in ("string", "binary")
            else F.lit(16) for f in df.schema.fields]
    found = df.agg(F.count("*").alias("n"), F.sum(sum(wide, F.lit(0))).alias("b")).first()
    return F.broadcast(df) if found.n <= rows and (found.b or 0) <= size else df


def give_back() -> None:
    """Return freed memory to the system, so that an idle worker keeps no batch's memory."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)   # glibc has it
    if trim:
        trim(0)


def kept(owner: str | None = None) -> dict:
    """What a worker keeps between the tasks of ``owner``; what others kept is dropped."""
    module = sys.modules.setdefault("_llm_kept", types.ModuleType("_llm_kept"))
    if getattr(module, "owner", None) != owner or not hasattr(module, "state"):
        module.owner, module.state = owner, {}
    return module.state


def parts(batches, rows: int = 0):
    """The batches, those of more than ``rows`` rows in parts."""
    for batch in batches:
        size = rows or batch.num_rows or 1
        for at in range(0, batch.num_rows, size):
            yield batch.slice(at, size)


def map_batches(df: DataFrame, schema: str, fn: Callable[[pa.RecordBatch], dict], rows: int = 0,
                owner: str | None = None) -> DataFrame:
    """Apply ``fn`` (Arrow batch -> dict of columns) to every batch of ``df``.

    ``rows``: a larger batch is handed over in parts of so many rows.  ``owner``: whose
    ``kept`` state the worker may hold on to meanwhile."""
    from pyspark.sql.types import StructType

    names = [f.name for f in StructType.fromDDL(schema).fields]
    types = arrow_types(schema)

    def run(batches):
        kept(owner)
        for batch in parts(batches, rows):
            if batch.num_rows:
                out = fn(batch)
                yield pa.RecordBatch.from_arrays(
                    [out[n] if isinstance(out[n], (pa.Array, pa.ChunkedArray))
                     else pa.array(out[n], type=t) for n, t in zip(names, types)], names=names)
        give_back()

    return df.mapInArrow(run, schema)


def arrow_types(schema: str) -> list:
    from pyspark.sql.pandas.types import to_arrow_type
    from pyspark.sql.types import StructType

    return [to_arrow_type(f.dataType) for f in StructType.fromDDL(schema).fields]


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices of the concatenated ranges ``[start, start + length)``."""
    ends = np.cumsum(lengths)
    if not len(ends) or not ends[-1]:
        return np.zeros(0, np.int64)
    return np.repeat(starts - ends + lengths, lengths) + np.arange(ends[-1])


def components(vertices: DataFrame, edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Smallest reachable vertex of every vertex: ``(v, component)``.

    ``vertices`` has ``v``; ``edges`` has ``a`` and ``b`` (any direction).
    Alternating large-star and small-star rounds: each contracts the graph
    towards the smallest ids and ends, in about log(vertices) rounds, with
    every vertex pointing at its component's smallest one.  Each round's edges
    are a written table; a vertex with very many neighbours is only ever
    aggregated by ``min`` (map-side combined) and joined (AQE splits it)."""
    def arrange(e: DataFrame) -> DataFrame:
        return e.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))

    def star(both: DataFrame, larger: bool) -> DataFrame:
        low = both.groupBy("a").agg(F.min("b").alias("m"))
        low = low.select("a", F.least("a", "m").alias("m"))
        joined = both.join(low, "a")
        if larger:
            return joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        return (joined.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                .unionByName(low.where("a <> m").select("a", F.col("m").alias("b"))))

    now = stored(arrange(edges).distinct(), "edges")
    seen = None
    for _ in range(max_rounds):
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = stored(arrange(star(both, True)).distinct(), "large")
        before, now = now, stored(arrange(star(large, False)).distinct(), "small")
        discard(before, large)
        state = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if state == seen:
            break
        seen = state
    else:
        raise RuntimeError(f"no fixed point in {max_rounds} rounds")
    return vertices.join(now.select(F.col("a").alias("v"), F.col("b").alias("component")), "v", "left") \
        .select("v", F.coalesce("component", "v").alias("component"))


BREAK = re.compile("[ \\n\\t\\r]")
SLICE_CHARS = 1 << 22        # characters of a text handled at once: bounds a worker's memory


def slices(text: str, size: int = SLICE_CHARS):
    """Cut a text at white space into slices of about ``size`` characters."""
    at = 0
    while len(text) - at > size:
        m = BREAK.search(text, at + size)
        if not m:
            break
        yield text[at:m.end()]
        at = m.end()
    yield text[at:]


WORD_BYTES = re.compile(rb"[^\x20\x09-\x0D]+")


def hash_words(texts: list, lower: bool = False):
    """64-bit hashes of the words of all texts, in order, and how many each text has.

    ``lower`` first lowers A-Z.  Words are hashed in bounded portions, so a very long text
    costs eight bytes a word beside itself."""
    from pandas.util import hash_array

    flat, portion, held, sizes = [], [], 0, []
    for text in texts:
        n = 0
        for part in slices(text or ""):
            data = part.encode("utf-8", "surrogatepass")
            words = WORD_BYTES.findall(data.lower() if lower else data)
            n += len(words)
            portion += words
            if len(portion) > 400_000:
                flat.append(hash_array(np.array(portion, dtype=object), categorize=False))
                portion = []
        sizes.append(n)
    if portion:
        flat.append(hash_array(np.array(portion, dtype=object), categorize=False))
    return (np.concatenate(flat) if flat else np.zeros(0, np.uint64)), np.array(sizes, np.int64)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def window_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of ``width`` words, from one prefix sum modulo 2**64."""
    n = len(words)
    if n < width:
        return np.zeros(0, np.uint64)
    base = 0x9E3779B97F4A7C15
    back = pow(base, -1, 1 << 64)
    with np.errstate(over="ignore"):
        one = np.ones(1, np.uint64)
        up = np.cumprod(np.concatenate((one, np.full(n - 1, base, np.uint64))))
        down = np.cumprod(np.concatenate((one, np.full(n - width, back, np.uint64))))
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(words) * up, dtype=np.uint64)))
        return mix((total[width:] - total[:-width]) * down)


def by_bucket(keys: np.ndarray, buckets: int):
    """Order that sorts ``keys`` by bucket (high bits of a mixed key), and (bucket, from, to)."""
    bucket = ((mix(keys) >> np.uint64(40)) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    cuts = np.flatnonzero(np.diff(bucket[order])) + 1
    edges = np.concatenate(([0], cuts, [len(keys)])) if len(keys) else np.zeros(1, np.int64)
    return order, [(int(bucket[order[a]]), int(a), int(b)) for a, b in zip(edges[:-1], edges[1:])]
