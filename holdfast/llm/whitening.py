"""Whitening of embeddings along their principal components, the eigenvectors good to double precision.

1. Entries become integers. Sums and sums of products about a whole number near the mean are exact, batch by batch in tasks
   and then as decimals in Spark, so the covariance is exact whatever the order of rows or partitions.
2. The driver holds one covariance (dimension x dimension). Its eigenvectors in float32 start an iteration by matrix
   products in extended precision (Ogita and Aishima 2018), which doubles the right digits each time: from X, the residuals
   R = I - X'X and S = X'VX give the correction E of X + XE.
3. Where eigenvalues are too near each other for their difference to be told at the present precision, the correction cannot part
   their vectors (2019, part II): such a cluster is first solved on its own, as the small matrix of S about the cluster's mean, and
   its vectors are turned by what comes out. Eigenvalues that are equal have any basis of their space.
4. Rows are projected on the components in a pass of their own. Nothing is shuffled but sums.

Defined cases: a row is dropped if its vector is NULL, holds NULL or non-finite entries, or entries of 2^30 or more (whose products
would not fit), or has another length than most vectors (the smaller of two equally frequent lengths). Components whose
eigenvalue is zero (up to rounding: at most dimension x 2^-52 of the largest) have no rows, as nothing can be divided by it; so one row
alone, equal rows and an empty table give no rows. `deviation` is NULL where the exact sum passes 2^63. Repeated rows count and are returned each; a
NULL identifier stays NULL; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal
from itertools import combinations_with_replacement

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCALE, OFFSET = 1024, 100_000
LARGEST = 1 << 30
ROWS = 4096
_EPS = float(np.finfo(np.longdouble).eps)


# --- eigenvectors --------------------------------------------------------------------

def _clusters(values: np.ndarray, gap: float) -> Iterator[np.ndarray]:
    """Places of eigenvalues that lie within `gap` of a neighbour, cluster by cluster."""
    order = np.argsort(-values, kind="stable")
    apart = np.flatnonzero(-np.diff(values[order]) > gap) + 1
    return (c for c in np.split(order, apart) if len(c) > 1)


def _norm(m: np.ndarray) -> float:
    return float(np.linalg.norm(m.astype(np.float64), 2))


def refined(v: np.ndarray, most_rounds: int = 30) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and eigenvectors (columns) of a symmetric matrix, from a float32 start."""
    v = np.asarray(v, np.longdouble)
    n = len(v)
    scale = np.abs(v).max(initial=0)
    if n == 0 or scale == 0:
        return np.zeros(n, np.longdouble), np.eye(n, dtype=np.longdouble)
    a = v / scale
    x = np.linalg.eigh(a.astype(np.float32))[1].astype(np.longdouble)
    size, eye = _norm(a), np.eye(n, dtype=np.longdouble)
    solved, before = False, np.inf
    for _ in range(most_rounds):
        r = eye - x.T @ x
        s = x.T @ (a @ x)
        s = (s + s.T) / 2
        values = np.diag(s) / (1 - np.diag(r))
        gap = 2 * (_norm(s - np.diag(values)) + size * _norm(r))
        if gap < 1e-3 * size and not solved:
            # vectors of a cluster are any mix of the true ones: solve the cluster about its mean, where its small
            # differences have all their digits, and turn the vectors
            solved = True
            for c in _clusters(values, gap):
                block = s[np.ix_(c, c)] + (r[np.ix_(c, c)] * values[c].mean())  # as if the vectors were orthonormal
                block = (block + block.T) / 2 - values[c].mean() * np.eye(len(c), dtype=np.longdouble)
                top = np.abs(block).max()
                if top > 0:
                    x[:, c] = x[:, c] @ np.linalg.eigh((block / top).astype(np.float64))[1][:, ::-1].astype(np.longdouble)
                    solved = False
            if not solved:
                solved = True
                continue
        apart = values[None, :] - values[:, None]
        far = np.abs(apart) > gap
        e = np.where(far, (s + values[None, :] * r) / np.where(far, apart, 1), r / 2)
        x = x + x @ e
        change = float(np.abs(e).max())
        if change < 8 * _EPS * n or (change < 1e-15 and change >= before / 2):
            break
        solved = solved and change >= before / 4  # a cluster may be told apart once the precision has grown
        before = change
    x = x @ (1.5 * eye - 0.5 * (x.T @ x))  # where differences are at the last digit, corrections are not quite skew
    values = np.einsum("ij,ij->j", x, a @ x) / np.einsum("ij,ij->j", x, x)
    order = np.argsort(-values, kind="stable")
    x = x[:, order] / np.sqrt(np.einsum("ij,ij->j", x, x))[order]
    return values[order] * scale, x


# --- exact sums ----------------------------------------------------------------------

def _summed(rows: DataFrame, column: str, width: int, of: Callable[[np.ndarray], list[int]]) -> list[int]:
    """Element-wise sums over all rows of what `of` makes of a matrix of vectors: whole numbers, exact."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = of(_matrix(batch.column(0).slice(at, ROWS), width))
                total = part if total is None else [a + b for a, b in zip(total, part)]
        if total is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(total)), pa.int32()), pa.array([Decimal(t) for t in total], pa.decimal128(38, 0))], ["i", "s"])

    found = rows.select(column).mapInArrow(run, "i int, s decimal(38,0)").groupBy("i").agg(F.sum("s").alias("s")).collect()
    return [int(r["s"]) for r in sorted(found)]


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _products(y: np.ndarray) -> list[int]:
    """Upper triangle of y'y in whole numbers."""
    i, j = np.triu_indices(y.shape[1])
    most = int(np.abs(y).max(initial=0))
    if most * most * len(y) < 1 << 53:  # all partial sums are whole numbers that a double holds
        y = y.astype(np.float64)
        return [int(t) for t in (y.T @ y)[i, j]]
    high, low = y >> 16, y & 0xFFFF  # halves of up to 30 bits, whose products sum in 64
    hh, hl, ll = high.T @ high, high.T @ low, low.T @ low
    return [(int(a) << 32) + (int(b) + int(c) << 16) + int(d) for a, b, c, d in zip(hh[i, j], hl[i, j], hl.T[i, j], ll[i, j])]


# --- whitening -----------------------------------------------------------------------

def whole_numbers(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> tuple[DataFrame, int]:
    """(id, x) of the usable vectors in whole numbers, and their length."""
    v = F.col(f"`{vec_col}`").cast("array<double>")
    fit = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < LARGEST))
    lean = vectors.select(F.col(f"`{id_col}`").alias("id"), v.alias("v")).where(v.isNotNull() & fit & (F.size(v) > 0))
    most = lean.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    width = most["d"] if most else 0
    x = F.transform("v", lambda c: F.floor(c * SCALE) + OFFSET)
    return lean.where(F.size("v") == width).select("id", x.alias("x")), width


@dataclass(frozen=True)
class Whitener:
    """n vectors, their exact sums, and the components: eigenvalues, unit vectors (columns) and the trace."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    @property
    def width(self) -> int:
        return len(self.sums)


def fitted(rows: DataFrame, width: int, most: int = 8) -> Whitener | None:
    """Covariance (divisor n) and its first components over (id, x); None where nothing varies."""
    if not width:
        return None
    counted = _summed(rows, "x", width, lambda x: [len(x), *(int(t) for t in x.sum(axis=0))])
    n, sums = counted[0], counted[1:]
    near = np.array([round(s / n) for s in sums])
    products = _summed(rows, "x", width, lambda x: _products(x - near))
    rest = [s - n * int(m) for s, m in zip(sums, near)]
    v = np.zeros((width, width), np.longdouble)
    for (i, j), p in zip(combinations_with_replacement(range(width), 2), products):
        v[i, j] = v[j, i] = np.longdouble(str(n * p - rest[i] * rest[j])) / np.longdouble(str(n * n))
    values, vectors = refined(v)
    kept = min(most, int((values > width * 2.0**-52 * values[0]).sum()))
    if not kept:
        return None
    return Whitener(n, tuple(sums), values[:kept].astype(np.float64), vectors[:, :kept].astype(np.float64), float(np.trace(v)))


def whitened(rows: DataFrame, fit: Whitener) -> DataFrame:
    """(id, deviation, z): exact squared distance from the mean times n^2, and one whitened value per component."""
    n, width = fit.n, fit.width
    sums = np.array(fit.sums, np.int64) if max(map(abs, fit.sums)) < 1 << 62 else np.array(fit.sums, object)
    near = np.array([round(s / n) for s in fit.sums])
    rest = np.array([float(s - n * int(m)) for s, m in zip(fit.sums, near)]) / n
    scaled = fit.vectors / np.sqrt(fit.values)

    def squares(x: np.ndarray) -> list[int | None]:
        far = np.abs(x - near).max(initial=0) + 1
        if sums.dtype != object and float(far) * n < 2.0**31 / np.sqrt(width) and float(np.abs(x).max(initial=1)) * n < 2.0**62:
            return ((n * x - sums) ** 2).sum(axis=1).tolist()
        exact = (((n * x.astype(object)) - sums) ** 2).sum(axis=1)
        return [int(t) if t < 1 << 63 else None for t in exact]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                x = _matrix(part.column(1), width)
                z = ((x - near) - rest) @ scaled
                yield pa.RecordBatch.from_arrays([
                    part.column(0), pa.array(squares(x), pa.int64()),
                    pa.ListArray.from_arrays(np.arange(len(z) + 1, dtype=np.int32) * z.shape[1], pa.array(z.ravel())),
                ], ["id", "deviation", "z"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, deviation long, z array<double>")


def identity_error(white: DataFrame, fit: Whitener) -> float:
    """Largest entry by which the covariance of the whitened values differs from the identity; one aggregation."""
    pairs = list(combinations_with_replacement(range(len(fit.values)), 2))

    def off(i: int, j: int) -> Column:
        z = F.col("z")
        return F.abs(F.covar_pop(z[i], z[j]) - F.lit(1.0 if i == j else 0.0)).alias(f"c{i}_{j}")

    return max(white.agg(*[off(i, j) for i, j in pairs]).first())


def report(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", most: int = 8) -> DataFrame:
    """One row per usable vector and component."""
    rows, width = whole_numbers(vectors, id_col, vec_col)
    fit = fitted(rows, width, most)
    if fit is None:
        white = rows.where(F.lit(False)).select("id", F.lit(0).cast("long").alias("deviation"), F.array(F.lit(0.0)).alias("z"))
        n, share, error = 0, [0.0], 0.0
    else:
        white = whitened(rows, fit)
        n, share, error = fit.n, [float(e) / fit.trace for e in fit.values], identity_error(white, fit)
    at = F.col("i") + 1
    return white.select("id", "deviation", F.posexplode("z").alias("i", "whitened")).select(
        F.col("id").alias(id_col), at.cast("int").alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        F.element_at(F.array(*[F.lit(s) for s in share]), at).alias("explained"), F.lit(float(error)).alias("identity_error"))
