"""Co-moments of all pairs of columns in one pass, and what follows from them.

A task folds its rows, Arrow batch by Arrow batch, into four k x k arrays: for every pair
(i, j) over the rows where both are there, their number, the mean of i, the sum of squared
deviations of i and the sum of products of deviations.  Two such states merge exactly
(pairwise updates, no raw sums of squares), so the tasks' states are merged in two rounds
and one row of 4 k^2 numbers is left, whatever the number of rows.  Rows never move."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STATE = "size array<double>, mean array<double>, square array<double>, cross array<double>"
PARTS = ("size", "mean", "square", "cross")
#: groups in which the tasks' states are merged before the last round
SLOTS = 256


def batch_state(x: np.ndarray, there: np.ndarray) -> tuple:
    """The state of some rows (rows x k); ``there`` marks values that are not null.

    Columns are shifted by their first value and then by their mean, so a constant column
    has deviations of exactly zero and large values lose no digits."""
    first = x[there.argmax(axis=0), np.arange(x.shape[1])] if len(x) else np.zeros(x.shape[1])
    first = np.where(there.any(axis=0), first, 0.0)
    away = np.where(there, x - first, 0.0)
    middle = away.sum(axis=0) / np.maximum(there.sum(axis=0), 1)
    away = np.where(there, away - middle, 0.0)
    mask = there.astype(np.float64)
    size = mask.T @ mask
    total = away.T @ mask                       # of i where j is there
    some = np.maximum(size, 1)
    mean = np.where(size > 0, (first + middle)[:, None] + total / some, 0.0)
    square = np.where(size > 0, np.maximum((away * away).T @ mask - total * total / some, 0.0), 0.0)
    cross = np.where(size > 0, away.T @ away - total * total.T / some, 0.0)
    return size, mean, square, cross


def merged(a: tuple, b: tuple) -> tuple:
    """The state of the rows of two states."""
    size = a[0] + b[0]
    some = np.maximum(size, 1)
    apart = np.where((a[0] > 0) & (b[0] > 0), b[1] - a[1], 0.0)
    weight = a[0] * b[0] / some
    mean = np.where(a[0] > 0, a[1] + apart * b[0] / some, b[1])
    return size, mean, a[2] + b[2] + apart * apart * weight, a[3] + b[3] + apart * apart.T * weight


def co_moments(df: DataFrame, columns) -> DataFrame:
    """One row ``STATE`` (k x k arrays, row by row) of numeric columns: names, or a dict of
    name -> Column.  A null is left out of the pairs it is in; no rows give zeros."""
    columns = columns if isinstance(columns, dict) else {c: F.col(c) for c in columns}
    k = len(columns)
    values = df.select((F.spark_partition_id() % SLOTS).alias("slot"),
                       *[_as_col(c).cast("double").alias(f"c{i}") for i, c in enumerate(columns.values())])

    def row(slot: int, state: tuple) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([slot], pa.int32()), *(pa.array([part.ravel().tolist()], pa.list_(pa.float64())) for part in state)],
            names=["slot", *PARTS])

    def fold(batches):
        state, slot = None, 0
        for batch in batches:
            if batch.num_rows:
                slot = batch.column(0)[0].as_py()
                own = [batch.column(i + 1) for i in range(k)]
                there = np.stack([c.is_valid().to_numpy(zero_copy_only=False) for c in own], axis=1)
                x = np.stack([c.to_numpy(zero_copy_only=False) for c in own], axis=1).astype(np.float64)
                new = batch_state(np.where(there, x, 0.0), there)
                state = new if state is None else merged(state, new)
        if state is not None:
            yield row(slot, state)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = tuple(np.zeros((k, k)) for _ in PARTS)
        for batch in batches:
            for parts in zip(*(batch.column(p).to_pylist() for p in PARTS)):
                state = merged(state, tuple(np.array(p).reshape(k, k) for p in parts))
        yield row(0, state)

    schema = f"slot int, {STATE}"
    states = values.mapInArrow(fold, schema).groupBy("slot").applyInArrow(merge, schema)
    nothing = df.sparkSession.range(1, numPartitions=1).select(
        F.lit(0).alias("slot"), *[F.array_repeat(F.lit(0.0), k * k).alias(p) for p in PARTS])
    return states.unionByName(nothing).groupBy(F.lit(0).alias("all")).applyInArrow(merge, schema).select(*PARTS)


def _as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def correlation_matrix(df: DataFrame, columns, digits: int | None = None) -> DataFrame:
    """Pearson's r of every pair of columns as rows ``(x, y, r)``, k * k of them, from one job.

    ``columns`` is a list of names or a dict of name -> Column.  A pair uses the rows where
    both values are there; r is null if either is constant on them (or there is none)."""
    columns = columns if isinstance(columns, dict) else {c: F.col(c) for c in columns}
    k, names = len(columns), F.array(*[F.lit(c) for c in columns])
    state = co_moments(df, columns)
    at = F.explode(F.sequence(F.lit(0), F.lit(k * k - 1)))
    cells = state.select(at.alias("p"), "square", "cross")
    i, j = F.floor(F.col("p") / k).cast("int"), (F.col("p") % k).cast("int")
    own, other = F.get("square", i * k + j), F.get("square", j * k + i)
    r = F.when((own > 0) & (other > 0), F.least(F.greatest(F.get("cross", F.col("p")) / (F.sqrt(own) * F.sqrt(other)), F.lit(-1.0)), F.lit(1.0)))
    return cells.select(F.get(names, i).alias("x"), F.get(names, j).alias("y"),
                        (F.round(r, digits) if digits is not None else r).alias("r"))
