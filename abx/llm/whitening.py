"""Whitening of embeddings, its eigenpairs found by contour integration (FEAST).

The covariance comes from two passes that add up integers and centred products. On the
driver, inertia counts (signs in a Sturm sequence) cut the spectrum from the
top into intervals of few eigenvalues; for each, a Gauss-Legendre quadrature
of shifted solves (z I - V)^-1 Y on a circle about the interval filters a block of
vectors, Rayleigh-Ritz takes the eigenpairs out of it, and the interval is done when their
number equals the inertia count and their residuals are at rounding level.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from abx.llm.moments import finite_vector, matrix, packed_matrix, packed_rows, summed
from abx.llm.runtime import written

BLOCK = 8           # eigenvalues in an interval at most, unless they lie within rounding of each other
NODES = 8           # quadrature points on the upper half circle
SWEEPS = 60


def tridiagonal(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and off-diagonal of a tridiagonal matrix with the eigenvalues of ``v``."""
    a = v.copy()
    for k in range(len(a) - 2):
        u = a[k + 1:, k].copy()
        size = np.linalg.norm(u)
        if size == 0.0:
            continue
        u[0] += size if u[0] >= 0 else -size
        u /= np.linalg.norm(u)
        a[k + 1:] -= 2.0 * np.outer(u, u @ a[k + 1:])
        a[:, k + 1:] -= 2.0 * np.outer(a[:, k + 1:] @ u, u)
    return np.diag(a).copy(), np.diag(a, -1).copy()


def above(tri: tuple[np.ndarray, np.ndarray], shift: float) -> int:
    """Inertia: how many eigenvalues exceed ``shift``."""
    diagonal, off = tri
    tiny = np.finfo(float).tiny
    count, q = 0, 1.0
    for i, d in enumerate(diagonal):
        q = d - shift - (off[i - 1] ** 2 / q if i else 0.0)
        if q == 0.0:
            q = -tiny
        count += q > 0
    return count


def intervals(tri: tuple[np.ndarray, np.ndarray], lo: float, hi: float, wanted: int) -> Iterator[tuple[float, float, int]]:
    """Intervals (lo, hi] with their counts, from the top, until they hold ``wanted`` eigenvalues."""
    stack = [(lo, hi, above(tri, lo) - above(tri, hi))]
    while stack and wanted > 0:
        a, b, n = stack.pop()
        if n == 0:
            continue
        cut = a + 0.5 * (b - a)
        if n > BLOCK:
            # A cut keeps clear of eigenvalues, beyond the rounding of their places; a cluster that
            # leaves no room for one stays whole.
            clear = [c for c in (a + part * (b - a) for part in (0.5, 0.45, 0.55, 0.4, 0.6, 0.35, 0.65, 0.3, 0.7))
                     if above(tri, c - (gap := max(1e-3 * (b - a) / n, 1e-13 * (hi - lo)))) == above(tri, c + gap)]
            cut = clear[0] if clear else cut
        if n <= BLOCK or (not clear and b - a <= 1e-8 * (hi - lo)):
            wanted -= n
            yield a, b, n
            continue
        upper = above(tri, cut) - above(tri, b)
        stack += [(a, cut, n - upper), (cut, b, upper)]


def feast(v: np.ndarray, lo: float, hi: float, count: int, seed: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` eigenpairs of symmetric ``v`` with eigenvalues in (lo, hi]."""
    dim = len(v)
    size = min(dim, count + max(8, count // 2))
    y = np.random.default_rng(seed).standard_normal((dim, size))
    centre, radius = (lo + hi) / 2, max((hi - lo) / 2, 1e-10 * max(abs(lo), abs(hi), 1e-300)) * (1 + 1e-9)
    points, weights = np.polynomial.legendre.leggauss(NODES)
    turns = np.exp(1j * np.pi / 2 * (1 + points))
    scale = np.abs(v).sum(axis=1).max()
    for _ in range(SWEEPS):
        q = np.zeros((dim, y.shape[1]))
        for turn, w in zip(turns, weights, strict=True):
            solved = np.linalg.solve((centre + radius * turn) * np.eye(dim) - v, y.astype(complex))
            q += w / 2 * (radius * turn * solved).real
        basis, strength, _ = np.linalg.svd(q, full_matrices=False)
        basis = basis[:, strength > 1e-14 * strength[0]]
        values, turned = np.linalg.eigh(basis.T @ v @ basis)
        y = basis @ turned
        inside = (values > lo) & (values <= hi)
        if inside.sum() == count:
            found = y[:, inside]
            if np.abs(v @ found - found * values[inside]).max() <= 4e-15 * dim * scale:
                return values[inside], found
        if y.shape[1] < min(dim, count + 4):      # the block lost rank
            more = np.random.default_rng(seed + 1).standard_normal((dim, size - y.shape[1]))
            y = np.concatenate((y, more), axis=1)
    raise ArithmeticError(f"contour integration found {int(inside.sum())} of {count} eigenvalues in ({lo}, {hi}]")


def principal(v: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues of a covariance, falling, and their unit
    eigenvectors as columns (the entry of largest size is positive). Eigenvalues
    within rounding of zero are left out."""
    trace = float(np.trace(v))
    if not trace > 0.0:
        return np.empty(0), np.empty((len(v), 0))
    unit = v / trace
    tri = tridiagonal(unit)
    edge = 1e-12
    found = [feast(unit, a, b, n)[1] for a, b, n in intervals(tri, edge, 1.0 + edge, wanted)]
    if not found:
        return np.empty(0), np.empty((len(v), 0))
    basis = np.linalg.qr(np.concatenate(found, axis=1))[0]
    values, turned = np.linalg.eigh(basis.T @ unit @ basis)     # one Rayleigh-Ritz across intervals
    vectors = (basis @ turned)[:, ::-1][:, :wanted]
    largest = vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])]
    return values[::-1][:wanted] * trace, vectors * np.sign(largest)


@dataclass(frozen=True)
class Whitener:
    """Fitted over ``n`` integer vectors with component sums ``sums``; ``values`` and
    ``vectors`` are eigenpairs of their covariance, whose trace is ``trace``."""

    n: int
    sums: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    def offsets(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, exact (as Python integers where 62 bits would not hold the product)."""
        if x.size and self.n * int(np.abs(x).max()) >= 1 << 62:
            return x.astype(object) * self.n - self.sums.astype(object)
        return self.n * x - self.sums

    def whiten(self, offsets: np.ndarray) -> np.ndarray:
        return (offsets.astype(float) / self.n) @ (self.vectors / np.sqrt(self.values))


def _sum_of_squares(offsets: np.ndarray) -> list[int]:
    """Exact, whatever their size."""
    if not offsets.size:
        return [0] * len(offsets)
    if offsets.dtype != object and float(np.abs(offsets).max()) ** 2 * offsets.shape[1] < 2.0 ** 62:
        return (offsets ** 2).sum(axis=1).tolist()
    return (offsets.astype(object) ** 2).sum(axis=1).tolist()


def fit(rows: DataFrame, dim: int, components: int) -> Whitener:
    """Fit over rows whose binary column ``x`` packs ``dim`` longs. Two passes: counts and
    sums, then products of centred rows."""
    def count(b: pa.RecordBatch) -> np.ndarray:
        x = packed_matrix(b.column("x"), np.int64, dim)
        # Parts of 18 bits are summed apart, so that no sum overflows.
        return np.concatenate(([len(x)], *(part.sum(axis=0) for part in (x >> 36, x >> 18 & 0x3FFFF, x & 0x3FFFF))))

    total = summed(rows.select("x"), count, 1 + 3 * dim, np.int64).tolist()
    n = total[0]
    sums = [(a << 36) + (b << 18) + c for a, b, c in zip(total[1:dim + 1], total[dim + 1:2 * dim + 1], total[2 * dim + 1:], strict=True)]
    if n == 0:
        return Whitener(0, np.zeros(dim, np.int64), np.empty(0), np.empty((dim, 0)), 0.0)
    if max(abs(s) for s in sums) >= 1 << 61:
        raise OverflowError("component sums exceed 61 bits")
    blank = Whitener(n, np.array(sums, np.int64), np.empty(0), np.empty((dim, 0)), 0.0)

    def products(b: pa.RecordBatch) -> np.ndarray:
        d = blank.offsets(packed_matrix(b.column("x"), np.int64, dim)).astype(float) / n
        return (d.T @ d).ravel()

    v = summed(rows.select("x"), products, dim * dim).reshape(dim, dim) / n
    v = (v + v.T) / 2
    values, vectors = principal(v, components)
    return Whitener(n, blank.sums, values, vectors, float(np.trace(v)))


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 64,
           shift: int = 1_000_000, components: int = 32) -> DataFrame:
    """Whitened coordinates of every vector on the first ``components`` principal axes.

    A component c enters as floor(``scale`` * c) + ``shift``. Rows whose vector is null, empty
    or holds a null, NaN or infinite component are left out, and so are those of another length
    than most vectors have (ties: the greater length). Repeated rows and null ids count as
    any row; other columns are not read. Axes along which the vectors do not vary (an
    eigenvalue below 1e-12 of the trace) have no whitened value and return no row, so equal
    vectors, a single one and an empty table return nothing. Components of 2^52 / ``scale``
    or more, or sums beyond 61 bits, are an error.

    Returns ``id_col``, component (from 1), n, deviation (decimal(38, 0): exact sum
    over dimensions of (n x - S)^2), whitened, explained (share of the
    trace), identity_error (largest absolute entry of the whitened covariance less the identity).
    """
    kept = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v")).where(
        finite_vector(F.col("v")) & (F.size("v") > 0))
    schema = T.StructType([vectors.select(F.col(id_col).alias("id")).schema["id"], T.StructField("dim", T.IntegerType()),
                           T.StructField("x", T.BinaryType())])

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            flat = np.floor(b.column("v").flatten().to_numpy(zero_copy_only=False) * scale)
            if flat.size and np.abs(flat).max() >= 2.0 ** 52:
                raise ValueError("a scaled component has 2^52 or more")
            flat = flat.astype(np.int64) + shift
            dims = b.column("v").value_lengths().to_numpy(zero_copy_only=False)
            packed = pa.array([r.tobytes() for r in np.split(flat, np.cumsum(dims)[:-1])] if len(dims) else [], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(dims, pa.int32()), packed], ["id", "dim", "x"])

    rows = written(kept.mapInArrow(store, schema), "whitening")
    most = rows.groupBy("dim").count().orderBy(F.desc("count"), F.desc("dim")).first()
    dim = most.dim if most else 1
    rows = rows.where(F.col("dim") == dim).select("id", "x")
    model = fit(rows, dim, components)
    m = len(model.values)

    def spread(b: pa.RecordBatch) -> np.ndarray:
        w = model.whiten(model.offsets(packed_matrix(b.column("x"), np.int64, dim)))
        return np.concatenate((w.sum(axis=0), (w.T @ w).ravel()))

    error = 0.0
    if m:
        total = summed(rows.select("x"), spread, m + m * m) / model.n
        error = float(np.abs(total[m:].reshape(m, m) - np.outer(total[:m], total[:m]) - np.eye(m)).max())
    explained = model.values / model.trace if m else model.values

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            offsets = model.offsets(packed_matrix(b.column("x"), np.int64, dim))
            size = pa.array(_sum_of_squares(offsets), pa.decimal128(38, 0))
            w = model.whiten(offsets)
            each = pa.array(np.repeat(np.arange(len(w)), m))
            yield pa.RecordBatch.from_arrays(
                [b.column("id").take(each), pa.array(np.tile(np.arange(1, m + 1, dtype=np.int32), len(w))), size.take(each),
                 pa.array(w.ravel()), pa.array(np.tile(explained, len(w)))], ["id", "component", "deviation", "whitened", "explained"])

    fields = [T.StructField("component", T.IntegerType()), T.StructField("deviation", T.DecimalType(38, 0)),
              T.StructField("whitened", T.DoubleType()), T.StructField("explained", T.DoubleType())]
    found = rows.mapInArrow(project, T.StructType([rows.schema["id"], *fields]))
    return found.select(F.col("id").alias(id_col), "component", F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
                        "explained", F.lit(error).alias("identity_error"))
