"""Whitening of embeddings; the components come from a FEAST contour integration.

Every entry c becomes the integer x = floor(scale * c) + OFFSET.  Three passes of Spark over
the vectors give what the fit needs, each summed by Spark over the tasks' partial sums:

1. n, the sums S of every dimension and the largest |x| (exact integers),
2. the covariance V, from (n x - S) / n, so it is centred before anything is multiplied
   (n x - S is an exact integer),
3. after the fit, the covariance of the whitened rows (identity_error).

The fit sees V only, a matrix of d x d whatever the number of rows.  Inertia counts (signs of
the pivots of V - s I) cut the part of the spectrum that holds the leading eigenvalues into
intervals of a few eigenvalues.  For every interval the rational filter of FEAST, a Gauss
quadrature of complex shifted solves (z I - V)^-1 Y on a circle around the interval, projects
a random block onto the interval's eigenvectors; Rayleigh-Ritz on that block extracts them,
and the filter is repeated until the residuals are at rounding level.  The number found must
equal the difference of the inertia counts at the interval's ends; otherwise the block grows.

Rows take no part whose vector is null, empty or holds a null or non-finite entry.  Vectors of
different lengths are fitted apart, each length with its own n, S and components.  Repeated
rows count each; null ids stay.  Components whose eigenvalue is zero to rounding (constant or
dependent dimensions, fewer rows than dimensions) cannot be whitened and are left out; where
none is left, a length has no rows in the result.  Entries so large that the exact integers
would pass 64 bits (n |x| of 2^62 and more) are refused with an error, never wrapped.  Further
columns are ignored; empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize

SCALE, OFFSET = 64.0, 1_000_000
COMPONENTS = 32
PER_INTERVAL = 8
NODES = 8
ROUNDS = 40
LIMIT = 1 << 62
EPS = float(np.finfo(np.float64).eps)


# --- the eigenproblem ----------------------------------------------------------------

def count_below(v: np.ndarray, shift: float) -> int:
    """Number of eigenvalues of the symmetric ``v`` below ``shift``: negative pivots of v - shift I.

    Symmetric elimination with complete pivoting, by one diagonal entry or by a 2 x 2 block
    (which has one negative eigenvalue) where the off-diagonal entries are larger.
    """
    a = v - shift * np.eye(len(v))
    negative, threshold = 0, (1 + 17 ** 0.5) / 8
    while len(a):
        i = int(np.argmax(np.abs(np.diag(a))))
        off = np.abs(np.tril(a, -1))
        r, s = np.unravel_index(int(np.argmax(off)), off.shape)
        if abs(a[i, i]) >= threshold * off[r, s]:
            if a[i, i] == 0:
                return negative
            pivots = np.array([i])
            negative += int(a[i, i] < 0)
        else:
            pivots = np.array([s, r])
            negative += 1
        rest = np.setdiff1d(np.arange(len(a)), pivots)
        side = a[np.ix_(rest, pivots)]
        a = a[np.ix_(rest, rest)] - side @ np.linalg.solve(a[np.ix_(pivots, pivots)], side.T)
        a = (a + a.T) / 2
    return negative


def intervals(v: np.ndarray, wanted: int, per: int = PER_INTERVAL) -> list[tuple[float, float, int]]:
    """(low, high, count), falling, that together hold at least the ``wanted`` largest eigenvalues.

    Bisected by inertia counts until ``per`` eigenvalues are left in each, or until an
    interval is too narrow to tell its eigenvalues apart.
    """
    top = float(np.abs(v).sum(axis=1).max()) * (1 + 1e-6)
    bottom = -1e-6 * top
    out, todo, held = [], [(bottom, top, 0, len(v))], 0
    while todo and held < wanted:
        low, high, below_low, below_high = todo.pop()
        count = below_high - below_low
        if not count:
            continue
        if count <= per or high - low <= 1e-9 * top:
            out.append((low, high, count))
            held += count
            continue
        middle = (low + high) / 2
        below = count_below(v, middle)
        todo += [(low, middle, below_low, below), (middle, high, below, below_high)]  # the upper half first
    return out


def contour(low: float, high: float, nodes: int = NODES) -> list[tuple[complex, complex]]:
    """Nodes and weights of the upper half of a circle around the interval; the lower half is its conjugate."""
    x, w = np.polynomial.legendre.leggauss(nodes)
    angle = np.pi / 2 * (1 - x)
    turn = np.exp(1j * angle)
    centre, radius = (low + high) / 2, (high - low) / 2
    return [(complex(centre + radius * t), complex(wt * radius * t / 2)) for t, wt in zip(turn, w)]


def feast(v: np.ndarray, low: float, high: float, count: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` eigenvalues of ``v`` in [low, high) with their vectors, falling."""
    d, norm = len(v), float(np.abs(v).sum(axis=1).max())
    # the filter's circle is a little wider than the interval, so that no eigenvalue sits on its rim
    pad = max((high - low) * 0.05, 1e-10 * norm)
    nodes = contour(low - pad, high + pad)
    draw = np.random.default_rng(seed)
    size = min(d, count + max(4, count // 2))
    while True:
        block = draw.standard_normal((d, size))
        for _ in range(ROUNDS):
            projected = np.zeros_like(block)
            for z, weight in nodes:
                projected += (weight * np.linalg.solve(z * np.eye(d) - v, block.astype(complex))).real
            basis, _ = np.linalg.qr(projected)
            values, small = np.linalg.eigh(basis.T @ v @ basis)
            block = basis @ small
            inside = np.flatnonzero((values >= low) & (values < high))
            if len(inside) == count:
                residual = np.abs(v @ block[:, inside] - block[:, inside] * values[inside]).max()
                if residual <= 8 * d * EPS * norm:
                    order = inside[::-1]
                    return values[order], block[:, order]
        if size == d:
            raise ArithmeticError(f"{count} eigenvalues counted in [{low}, {high}), {len(inside)} found")
        size = min(d, 2 * size)


def leading(v: np.ndarray, wanted: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues of a covariance, falling, with unit vectors as columns; zeros are left out."""
    trace = float(np.trace(v))
    if not trace > 0:
        return np.empty(0), np.empty((len(v), 0))
    scaled = v / trace
    found = [feast(scaled, low, high, count, seed=i) for i, (low, high, count) in enumerate(intervals(scaled, wanted))]
    values, vectors = np.concatenate([e for e, _ in found]), np.hstack([w for _, w in found])
    order = np.argsort(-values, kind="stable")[:wanted]
    order = order[values[order] > 16 * len(v) * EPS]
    # once more over all intervals together: vectors of neighbouring intervals become orthogonal to rounding
    basis, _ = np.linalg.qr(vectors[:, order])
    values, small = np.linalg.eigh(basis.T @ scaled @ basis)
    values, vectors, order = values[::-1], (basis @ small)[:, ::-1], np.arange(len(values))
    # either sign is right; the largest entry positive makes reruns agree
    flip = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(order))])
    return values[order] * trace, vectors * flip


# --- Spark passes ---------------------------------------------------------------------

def integers(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", scale: float = SCALE,
             offset: int = OFFSET) -> DataFrame:
    """(vec_id, x): rows that take part, entries as longs; entries out of the range of a long raise."""
    v = F.col(vec_col).cast("array<double>")
    finite = (F.size(v) > 0) & F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    held = df.where(v.isNotNull() & finite)
    whole = F.transform(v, lambda c: F.when(F.abs(c * scale) < float(LIMIT), F.floor(c * scale) + F.lit(offset)).otherwise(
        F.raise_error(F.lit("an entry of a vector is too large for exact integers")).cast("bigint")))
    return held.select(F.col(id_col).alias("vec_id"), whole.alias("x"))


def _matrices(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, integer matrix) for every vector length in a batch."""
    lists = batch.column("x")
    width = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    first = np.cumsum(width) - width
    for d in np.unique(width).tolist():
        rows = np.flatnonzero(width == d)
        yield rows, flat[first[rows][:, None] + np.arange(d)[None, :]]


class Fit(NamedTuple):
    """What whitens the vectors of one length."""

    n: int
    sums: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n x - S, exact."""
        return self.n * x - self.sums

    def whiten(self, x: np.ndarray) -> np.ndarray:
        return (self.centred(x) / self.n) @ self.vectors / np.sqrt(self.values)

    def deviation(self, x: np.ndarray) -> list[int]:
        """Sum over the dimensions of (n x - S)^2, exact."""
        y = self.centred(x)
        if float(np.abs(y).max(initial=0)) ** 2 * y.shape[1] < LIMIT:
            return (y * y).sum(axis=1).tolist()
        return [sum(int(c) * int(c) for c in row) for row in y]


def column_sums(vectors: DataFrame) -> dict[int, tuple[int, np.ndarray]]:
    """n and the sums of every dimension, by vector length (one entry per length)."""
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for batch in batches:
            for rows, x in _matrices(batch):
                n, sums, large = held.get(x.shape[1], (0, 0, 0))
                # Python integers, so that nothing wraps before the range is checked
                held[x.shape[1]] = (n + len(rows), sums + x.astype(object).sum(axis=0) if float(
                    np.abs(x).max()) * len(rows) >= LIMIT else sums + x.sum(axis=0).astype(object),
                    max(large, int(np.abs(x.astype(np.float64)).max()) + 1))
        for d, (n, sums, large) in held.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([d] * d), pa.array(range(d)), pa.array([n] * d), pa.array([str(int(s)) for s in sums]),
                 pa.array([float(large)] * d)], names=["d", "i", "n", "total", "large"])

    parts = vectors.select("x").mapInArrow(partial, "d long, i long, n long, total string, large double")
    per = parts.groupBy("d", "i").agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total"),
                                      F.max("large").alias("large"))
    out: dict[int, tuple[int, np.ndarray]] = {}
    for row in per.orderBy("d", "i").collect():  # one row per dimension
        if row.n * row.large >= LIMIT:
            raise ArithmeticError("the vectors' entries are too large for exact 64-bit sums")
        n, sums = out.setdefault(row.d, (row.n, np.zeros(row.d, np.int64)))
        sums[row.i] = int(row.total)
    return out


def _second_moments(vectors: DataFrame, centre) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Sums of y and of y y^T over all rows, by vector length; y = centre(d)(x) may have other columns than x."""
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for _, x in _matrices(batch):
                y = centre(x)
                first, second = held.get(x.shape[1], (0.0, 0.0))
                held[x.shape[1]] = first + y.sum(axis=0), second + y.T @ y
        for d, (first, second) in held.items():
            for i in range(len(first)):
                # row i of the upper triangle, behind it the sum of y_i
                values = [*second[i, i:].tolist(), float(first[i])]
                at = [*range(i, len(first)), -1]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([d] * len(at)), pa.array([i] * len(at)), pa.array(at), pa.array(values)],
                    names=["d", "i", "j", "value"])

    parts = vectors.select("x").mapInArrow(partial, "d long, i long, j long, value double")
    sums = parts.groupBy("d", "i", "j").agg(F.sum("value").alias("value"))
    rows = sums.groupBy("d", "i").agg(F.array_sort(F.collect_list(F.struct("j", "value"))).alias("row"))
    out: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for row in rows.orderBy("d", "i").toLocalIterator():  # d rows of at most d + 1 numbers
        values = np.array([e.value for e in row.row])
        size = row.i + len(values) - 1
        first, second = out.setdefault(row.d, (np.zeros(size), np.zeros((size, size))))
        first[row.i] = values[0]
        second[row.i, row.i:] = second[row.i:, row.i] = values[1:]
    return out


def fit_whitening(vectors: DataFrame, components: int = COMPONENTS) -> dict[int, Fit]:
    """Fits of integer ``vectors`` (vec_id, x), by vector length; a fit is as large as d x ``components``."""
    spark = vectors.sparkSession
    sums = column_sums(vectors)
    shared = spark.sparkContext.broadcast(sums)

    def centre(x):
        n, total = shared.value[x.shape[1]]
        return (n * x - total) / n

    fits = {}
    for d, (_, moments) in _second_moments(vectors, centre).items():
        n, total = sums[d]
        v = moments / n
        values, found = leading(v, components)
        fits[d] = Fit(n, total, values, found, float(np.trace(v)))
    return fits


def identity_error(vectors: DataFrame, fits: dict[int, Fit]) -> float:
    """Largest absolute entry of the whitened rows' covariance minus the identity, over all rows."""
    shared = vectors.sparkSession.sparkContext.broadcast(fits)
    worst = 0.0
    for d, (first, second) in _second_moments(vectors, lambda x: shared.value[x.shape[1]].whiten(x)).items():
        mean = first / fits[d].n
        off = second / fits[d].n - np.outer(mean, mean) - np.eye(len(mean))
        worst = max(worst, float(np.abs(off).max(initial=0.0)))
    return worst


def whiten(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", components: int = COMPONENTS,
           scale: float = SCALE, offset: int = OFFSET) -> DataFrame:
    """(vec_id, whitened array, deviation decimal, n, explained array, identity_error), a row per vector.

    ``deviation`` is exact; beyond 38 digits it would be null.
    """
    vectors = materialize(integers(df, id_col, vec_col, scale, offset), "whitening")
    fits = fit_whitening(vectors, components)
    error = identity_error(vectors, fits)
    shared = vectors.sparkSession.sparkContext.broadcast(fits)
    id_type = vectors.schema["vec_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, x in _matrices(batch):
                fit = shared.value[x.shape[1]]
                if not len(fit.values):
                    continue
                explained = (fit.values / fit.trace).tolist()
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id").take(pa.array(rows)), pa.array(fit.whiten(x).tolist(), pa.list_(pa.float64())),
                     pa.array([str(s) for s in fit.deviation(x)]), pa.array([fit.n] * len(rows)),
                     pa.array([explained] * len(rows), pa.list_(pa.float64()))],
                    names=["vec_id", "whitened", "deviation", "n", "explained"])

    out = vectors.mapInArrow(
        run, f"vec_id {id_type}, whitened array<double>, deviation string, n long, explained array<double>")
    return out.withColumns({"deviation": F.expr("try_cast(deviation AS decimal(38,0))"), "identity_error": F.lit(error)})


def whitening_report(df: DataFrame) -> DataFrame:
    """Contract columns: a row per vector and component.

    ``deviation`` is null where the exact sum passes a long; ``deviation_exact`` still holds it.
    """
    rows = whiten(df.select("vec_id", "embedding"))
    each = rows.select("vec_id", "n", F.col("deviation").alias("deviation_exact"), "identity_error",
                       F.posexplode(F.arrays_zip("whitened", "explained")).alias("at", "c"))
    return each.select(
        "vec_id", (F.col("at") + 1).alias("component"), "n", F.expr("try_cast(deviation_exact AS bigint)").alias("deviation"),
        F.col("c.whitened").alias("whitened"), F.col("c.explained").alias("explained"), "identity_error", "deviation_exact")
