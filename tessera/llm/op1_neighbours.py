"""Approximate nearest neighbours: a forest of random-projection trees, exact reranking."""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.session import read_table

from .base import stored

TREES = 8
DEPTH = 6                    # 2 ** DEPTH leaves a tree
SAMPLE = 8192                # vectors the trees are fitted on; all are indexed
EXAMINE = 1.6                # rows in the leaves a query opens, over all trees, as a multiple of the table's
BLOCK = 4096                 # rows of a leaf (and queries) a task takes at once
TOP = 20


def valid_rows(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, vec) of the usable rows: id not null; vector of the table's most frequent
    length (the shorter of two as frequent), not zero, all components finite."""
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).alias("vec"))
    good = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(F.col("vec_id").isNotNull() & good & F.exists("vec", lambda x: x != 0))
    size = rows.groupBy(F.size("vec").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return rows.where(F.size("vec") == (size.d if size else 0))


def classes_of(rows: DataFrame, top: int, query_every: int) -> DataFrame:
    """One row for each different vector, stored: cid, vec, its ``top + 1`` smallest ids, and
    whether a query has it.

    Equal vectors score alike, so a result never needs more of them; a vector that a third of
    all rows share is one point of the index.  Ids are cut per vector before the shuffle."""
    keyed = rows.select(F.xxhash64("vec").alias("k1"), F.xxhash64(F.lit(1), "vec").alias("k2"), "vec_id", "vec")
    lowest = keyed.select("k1", "k2", "vec_id").distinct() \
        .withColumn("r", F.row_number().over(Window.partitionBy("k1", "k2").orderBy("vec_id"))) \
        .where(F.col("r") <= top + 1).groupBy("k1", "k2").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    asked = F.max((F.col("vec_id") % query_every == 0).cast("int")).alias("asked")
    vecs = keyed.join(lowest.select("k1", "k2", F.get("ids", F.lit(0)).alias("vec_id")), ["k1", "k2", "vec_id"]) \
        .dropDuplicates(["k1", "k2"]).select("k1", "k2", "vec")
    out = lowest.join(keyed.groupBy("k1", "k2").agg(asked), ["k1", "k2"]).join(vecs, ["k1", "k2"])
    return stored(out.select(F.monotonically_increasing_id().alias("cid"), "k1", "k2", "vec", "ids",
                             (F.col("asked") == 1).alias("asked")), "vectors")


def grow(sample: np.ndarray, depth: int, seed: int):
    """One tree: at every inner node a direction between two sampled points, split at the median."""
    rng = np.random.default_rng(seed)
    dirs = np.zeros((2 ** depth - 1, sample.shape[1]))
    cuts = np.zeros(2 ** depth - 1)
    node = np.zeros(len(sample), np.int64)
    for i in range(2 ** depth - 1):
        own = sample[node == i]
        w = rng.normal(size=sample.shape[1])
        if len(own) > 1:
            a, b = own[rng.choice(len(own), 2, replace=False)]
            w = a - b if np.any(a != b) else w
            dirs[i] = w / np.linalg.norm(w)
            cuts[i] = np.median(own @ dirs[i])
        else:
            dirs[i] = w / np.linalg.norm(w)
        inside = np.flatnonzero(node == i)
        node[inside] = 2 * i + 1 + (own @ dirs[i] > cuts[i])
    return dirs, cuts


def leaf_of(points: np.ndarray, tree) -> np.ndarray:
    dirs, cuts = tree
    node = np.zeros(len(points), np.int64)
    while len(points) and node[0] < len(dirs):
        node = 2 * node + 1 + ((points * dirs[node]).sum(axis=1) > cuts[node])
    return node - len(dirs)


def open_leaves(point: np.ndarray, forest: list, sizes: np.ndarray, wanted: float) -> list:
    """Leaves of all trees in order of promise, until they hold ``wanted`` rows.

    One priority queue holds nodes of every tree; a node's priority is the smallest margin
    by which the query lies on its side of the splits above it."""
    margins = [dirs @ point - cuts for dirs, cuts in forest]
    inner = len(margins[0]) if forest else 0
    queue = [(-np.inf, t, 0) for t in range(len(forest))]
    out, held = [], 0
    while queue and held < wanted:
        worst, t, i = heapq.heappop(queue)
        if i >= inner:
            out.append((t, i - inner))
            held += sizes[t, i - inner]
            continue
        m = margins[t][i]
        heapq.heappush(queue, (max(worst, m), t, 2 * i + 1))
        heapq.heappush(queue, (max(worst, -m), t, 2 * i + 2))
    return out


def score_block(queries: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Inner products in double precision, each summed in component order: the same for a
    pair in whichever block it is met."""
    out = np.zeros((len(queries), len(points)))
    for d in range(points.shape[1]):
        out += np.multiply.outer(queries[:, d], points[:, d])
    return out


def best_of(scores: np.ndarray, ids: np.ndarray, top: int) -> np.ndarray:
    """Positions of the ``top`` largest scores, ties to the smaller id."""
    if len(scores) > top:
        floor = np.partition(scores, len(scores) - top)[len(scores) - top]
        keep = np.flatnonzero(scores >= floor)
    else:
        keep = np.arange(len(scores))
    return keep[np.lexsort((ids[keep], -scores[keep]))][:top]


def neighbours(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", top: int = TOP,
               query_every: int = 20, trees: int = TREES, depth: int = DEPTH, sample: int = SAMPLE,
               examine: float = EXAMINE, block: int = BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score: the ``top`` nearest found of every row whose id is
    divisible by ``query_every``, by inner product; ties to the smaller id.

    Largest inner product is nearest direction once every point gets one more component
    that lifts it to the longest norm (0 for queries).  Rows without id or usable vector take no part; rows
    equal in id and vector count once.  With at most ``top`` other rows all are returned; an empty
    table gives none.  A group of tasks' work is one leaf block against one query block, both of
    at most about ``block`` rows, whatever the table's size."""
    spark = vectors.sparkSession
    points = classes_of(valid_rows(vectors, id_col, vec_col), top, query_every)
    stats = points.agg(F.count("*").alias("n"), F.max(F.aggregate(
        "vec", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))).alias("longest")).first()
    if not stats.n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    longest = stats.longest
    picked = points.orderBy(F.xxhash64("k1"), "k2").limit(sample).select("vec").collect()
    fitted = np.array([r.vec for r in picked], np.float64).reshape(len(picked), -1)
    lift = lambda v: np.c_[v, np.sqrt(np.maximum(0, longest - (v * v).sum(axis=1)))]
    depth = max(0, min(depth, int(np.log2(max(1, len(picked) / 8)))))
    forest = [grow(lift(fitted), depth, seed) for seed in range(trees)] if len(picked) else []
    shared = spark.sparkContext.broadcast(forest)      # trees * 2 ** depth * dimensions numbers

    def index(batches):
        for b in batches:
            v = lift(np.array(b["vec"].tolist(), np.float64).reshape(len(b), -1))
            for t, tree in enumerate(shared.value):
                yield pd.DataFrame({"leaf": (t << 20) + leaf_of(v, tree), "cid": b["cid"]})

    placed = stored(points.select("cid", "vec").mapInPandas(index, "leaf long, cid long"), "leaves")
    sizes = np.zeros((max(1, len(forest)), 2 ** depth))
    for r in placed.groupBy("leaf").count().collect():   # trees * 2 ** depth rows
        sizes[r["leaf"] >> 20, r["leaf"] & 0xFFFFF] = r["count"]

    def search(batches):
        for b in batches:
            v = np.array(b["vec"].tolist(), np.float64).reshape(len(b), -1)
            found = [open_leaves(p, shared.value, sizes, max(examine * stats.n, 2 * top)) for p in np.c_[v, np.zeros(len(v))]]
            yield pd.DataFrame({"leaf": [(t << 20) + leaf for f in found for t, leaf in f],
                                "qid": np.repeat(b["cid"].to_numpy(), [len(f) for f in found])})

    asked = points.where("asked").select("cid", "vec")
    opened = stored(asked.mapInPandas(search, "leaf long, qid long"), "opened")
    visits = {r["leaf"]: r["count"] for r in opened.groupBy("leaf").count().collect()}
    q_blocks = {leaf: -(-n // block) for leaf, n in visits.items()}
    p_blocks = {(t << 20) + i: max(1, -(-int(sizes[t, i]) // block)) for t in range(len(forest)) for i in range(2 ** depth)}
    blocks = spark.createDataFrame([(k, q_blocks.get(k, 0), p) for k, p in p_blocks.items()] or [(-1, 0, 1)],
                                   "leaf long, qb int, pb int")
    to = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = placed.join(F.broadcast(blocks.where("qb > 0")), "leaf") \
        .select("leaf", "cid", F.pmod(F.xxhash64("cid"), "pb").cast("int").alias("p"), to("qb").alias("q")) \
        .join(points.select("cid", F.col("vec").alias("point"), F.get("ids", F.lit(0)).alias("low")), "cid")
    right = opened.join(F.broadcast(blocks), "leaf") \
        .select("leaf", "qid", F.pmod(F.xxhash64("qid"), "qb").cast("int").alias("q"), to("pb").alias("p")) \
        .join(asked.select(F.col("cid").alias("qid"), F.col("vec").alias("asked_point")), "qid")

    def rerank(p: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(p) and len(q):
            pv, low, cid = np.array(p["point"].tolist(), np.float64), p["low"].to_numpy(), p["cid"].to_numpy()
            qv, qid = np.array(q["asked_point"].tolist(), np.float64), q["qid"].to_numpy()
            for at in range(0, len(qv), 256):
                for i, s in enumerate(score_block(qv[at:at + 256], pv)):
                    keep = best_of(s, low, top + 1)
                    out.append((np.full(len(keep), qid[at + i]), cid[keep], low[keep], s[keep]))
        cols = [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0, np.int64)] * 3 + [np.zeros(0)]
        return pd.DataFrame(dict(zip(("qid", "cid", "low", "score"), cols)))

    near = left.groupBy("leaf", "p", "q").cogroup(right.groupBy("leaf", "p", "q")) \
        .applyInPandas(rerank, "qid long, cid long, low long, score double")
    near = near.groupBy("qid", "cid").agg(F.max("score").alias("score"), F.min("low").alias("low"))
    order = Window.partitionBy("qid").orderBy(F.desc("score"), "low")
    near = near.withColumn("r", F.row_number().over(order)).where(F.col("r") <= top + 1)
    listed = near.join(points.select("cid", "ids"), "cid") \
        .select("qid", (-F.col("score")).alias("s"), F.explode("ids").alias("vec_id")) \
        .withColumn("r", F.row_number().over(Window.partitionBy("qid").orderBy("s", "vec_id"))) \
        .where(F.col("r") <= top + 1) \
        .groupBy("qid").agg(F.array_sort(F.collect_list(F.struct("s", "vec_id"))).alias("found")) \
        .join(points.select(F.col("cid").alias("qid"), "k1", "k2"), "qid").select("k1", "k2", "found")
    queries = valid_rows(vectors, id_col, vec_col).where(F.col("vec_id") % query_every == 0) \
        .select(F.col("vec_id").alias("query_id"), F.xxhash64("vec").alias("k1"),
                F.xxhash64(F.lit(1), "vec").alias("k2")).distinct()
    others = F.slice(F.filter("found", lambda f: f["vec_id"] != F.col("query_id")), 1, top)
    return queries.join(listed, ["k1", "k2"]).select("query_id", F.posexplode(others).alias("rank", "f")) \
        .select("query_id", (F.col("rank") + 1).cast("int").alias("rank"), F.col("f.vec_id").alias("vec_id"),
                (-F.col("f.s")).alias("score"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours(read_table(spark, sf_dir, "embeddings"))
