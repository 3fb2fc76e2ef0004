"""Exact top-k by inner product with multi-resolution segment statistics.

Vectors are cut into segments; a segment is described by its mean m and deviation s.
With n_i components in segment i,

    |q - x|^2 >= sum n_i ((mq_i - mx_i)^2 + (sq_i - sx_i)^2)

is a lower bound of the distance.  As q.x = (|q|^2 + |x|^2 - |q - x|^2) / 2, and
n (m^2 + s^2) sums to the squared norm, it reads q.x <= sum n_i (mq_i mx_i + sq_i sx_i):
one small matrix product for each resolution.  Candidates whose bound is below the k-th
best score so far are dropped from coarse (1 segment) to fine (d/2 segments), and the
survivors are scored exactly.  Ties with the k-th score survive.

Queries go out in blocks of bounded size; every task scans its candidates once per
block and returns at most k rows per query, of which the best k are kept.

Vectors that are null or hold a null or non-finite component take no part, nor do rows
without ``vec_id``.  Vectors are compared with those of their own length only.  Rows
with the query's ``vec_id`` are its own.  Repeated candidate rows count each, repeated
query rows once.  Fewer than k candidates are all returned; empty tables give no rows.
Scores are exact whatever the size of the components; one that passes a long (components
beyond about 10^8 for 64 dimensions) is refused with an error.  Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

K = 5
SCALE = 256.0
BLOCK_BYTES = 16 << 20
QUERY_STEP = 64
EXACT = 2.0 ** 53
NONE = np.iinfo(np.int64).min


def usable(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(vec_id, v): rows that take part, components as doubles."""
    v = F.col(vec_col).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return df.where(F.col(id_col).isNotNull() & v.isNotNull() & finite).select(
        F.col(id_col).cast("long").alias("vec_id"), v.alias("v"))


def resolutions(d: int) -> list[np.ndarray]:
    """Segment starts for 1, 2, 4, ... segments, up to two components a segment."""
    out, n = [], 1
    while n <= max(1, d // 2):
        out.append(np.linspace(0, d, n + 1).astype(np.int64)[:-1])
        n *= 2
    return out


def statistics(x: np.ndarray) -> list[np.ndarray]:
    """For every resolution: weighted means and deviations, whose inner products bound those of the vectors."""
    d = x.shape[1]
    out = []
    for starts in resolutions(d):
        n = np.diff(np.append(starts, d))
        mean = np.add.reduceat(x, starts, axis=1) / n
        square = np.add.reduceat(x * x, starts, axis=1) / n
        deviation = np.sqrt(np.maximum(square - mean * mean, 0.0))
        out.append(np.hstack([mean * np.sqrt(n), deviation * np.sqrt(n)]))
    return out


def _exact_products(q: np.ndarray, x: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Inner products of integer-valued doubles too large for exact sums of doubles, of the ``wanted`` pairs."""
    if not (np.isfinite(q).all() and np.isfinite(x).all()):
        raise OverflowError("a component is too large for an exact score")
    score = np.array([[int(c) for c in row] for row in q], object).reshape(q.shape) @ np.array(
        [[int(c) for c in row] for row in x], object).reshape(x.shape).T
    score = np.where(wanted, score, 0)
    if any(abs(v) >= 2 ** 63 - 1 for v in score.flat):
        raise OverflowError("a score passes the range of a long")
    return score.astype(np.int64)


class _Best:
    """The k best candidates so far of the queries of one length."""

    def __init__(self, numbers, ids, vectors, k):
        self.numbers, self.ids, self.k = np.array(numbers), np.array(ids, np.int64), k
        self.q = np.array(vectors, np.float64).reshape(len(ids), -1)
        self.score = np.full((len(ids), k), NONE)
        self.vec = np.full((len(ids), k), np.iinfo(np.int64).max)
        self.stats = statistics(self.q) if self.q.shape[1] and np.abs(self.q).max(initial=0) < EXACT else []

    def add(self, ids: np.ndarray, x: np.ndarray) -> None:
        large = max(np.abs(self.q).max(initial=0), 1) * max(np.abs(x).max(initial=0), 1) * max(x.shape[1], 1)
        # bounds are rounded to about 1e-16 of the largest product; scores below 2^53 are exact
        stats = statistics(x) if x.shape[1] and large < EXACT else []
        slack = large * max(x.shape[1], 1) * 1e-12
        for a in range(0, len(self.ids), QUERY_STEP):
            b = min(a + QUERY_STEP, len(self.ids))
            floor = self.score[a:b, -1].astype(np.float64)
            alive = ids[None, :] != self.ids[a:b, None]
            cols = np.arange(len(ids))
            for mine, theirs in zip(self.stats, stats) if large < EXACT else ():
                alive &= mine[a:b] @ theirs[cols].T >= floor[:, None] - slack
                some = alive.any(axis=0)
                if not some.all():
                    cols, alive = cols[some], alive[:, some]
                if not len(cols):
                    break
            if len(cols):
                self._merge(a, b, ids[cols], alive, x[cols], large < EXACT)

    def _merge(self, a, b, ids, alive, x, exact):
        score = (self.q[a:b] @ x.T).astype(np.int64) if exact else _exact_products(self.q[a:b], x, alive)
        score = np.where(alive, score, NONE)
        vec = np.where(alive, ids[None, :], np.iinfo(np.int64).max)
        score, vec = np.hstack([self.score[a:b], score]), np.hstack([self.vec[a:b], vec])
        order = np.lexsort((vec, ~score), axis=1)[:, :self.k]  # ~x falls as x grows, without overflow
        self.score[a:b] = np.take_along_axis(score, order, axis=1)
        self.vec[a:b] = np.take_along_axis(vec, order, axis=1)

    def rows(self):
        held = self.vec < np.iinfo(np.int64).max
        at = np.nonzero(held)[0]
        return self.numbers[at], self.ids[at], self.vec[held], self.score[held]


def _matrices(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, matrix) for every vector length in a batch."""
    ids = batch.column(0).to_numpy(zero_copy_only=False)
    lists = batch.column(1)
    width = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    first = np.cumsum(width) - width
    for d in np.unique(width):
        rows = np.flatnonzero(width == d)
        yield ids[rows], flat[first[rows][:, None] + np.arange(d)[None, :]]


def scaled(x: np.ndarray, scale: float) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.floor(scale * x)


def top_k(df: DataFrame, is_query, k: int = K, scale: float = SCALE, id_col: str = "vec_id",
          vec_col: str = "embedding", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best candidates of every query row."""
    spark = df.sparkSession
    vectors = usable(df, id_col, vec_col)
    queries = vectors.where(is_query(F.col("vec_id"))).distinct()
    n, width = queries.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    blocks = max(1, -(-n * max(width or 0, 1) * 8 // block_bytes))
    found = None
    for block in range(blocks):
        mine = queries.where(F.pmod(F.xxhash64("vec_id", "v"), F.lit(blocks)) == block).orderBy("vec_id").collect()
        shared = spark.sparkContext.broadcast([(r.vec_id, list(r.v)) for r in mine])

        def search(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            by_length: dict[int, list[int]] = {}
            for i, (_, v) in enumerate(shared.value):
                by_length.setdefault(len(v), []).append(i)
            best = {d: _Best(at, [shared.value[i][0] for i in at],
                             scaled(np.array([shared.value[i][1] for i in at], np.float64), scale), k)
                    for d, at in by_length.items()}
            for batch in batches:
                for ids, x in _matrices(batch):
                    if x.shape[1] in best:
                        best[x.shape[1]].add(ids, scaled(x, scale))
            for group in best.values():
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in group.rows()],
                                                 names=["query", "query_id", "vec_id", "score"])

        part = vectors.mapInArrow(search, "query long, query_id long, vec_id long, score long").withColumn(
            "block", F.lit(block))
        found = part if found is None else found.unionByName(part)
    order = Window.partitionBy("block", "query").orderBy(F.col("score").desc(), F.col("vec_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")


def top_k_report(df: DataFrame) -> DataFrame:
    """Queries: every 50th ``vec_id``, against all rows."""
    return top_k(df, lambda vec_id: vec_id % 50 == 0)
