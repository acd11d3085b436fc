"""Whitening of embeddings by a pivoted Cholesky factor and one-sided Jacobi rotations (operator 12)."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from ..workspace import written
from .common import kept

#: Entries become whole numbers of this many to one, moved up by SHIFT.
SCALE, SHIFT = 64, 1_000_000
#: Components that are returned at most.
COMPONENTS = 16
#: A pivot below this share of the largest variance is taken for rounding, so what is left has no component.
RANK = 1e-13
#: Entries beyond this are cut to it, so that whole numbers hold them.
MOST = float(1 << 62)


def whole_numbers(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The entries of the valid rows of a list column as whole numbers, the end of each such row, and the valid rows.

    Valid is a list that is not null and whose entries are all finite.
    """
    sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    values = pc.cast(column.flatten(), pa.float64()).to_numpy(zero_copy_only=False)  # nulls are NaN now
    row = np.repeat(np.arange(len(column)), sizes)
    good = pc.is_valid(column).to_numpy(zero_copy_only=False) & (np.bincount(row, ~np.isfinite(values), len(column)) == 0)
    x = np.floor(np.clip(values[good[row]] * SCALE, -MOST, MOST)).astype(np.int64) + SHIFT
    return x, np.cumsum(sizes[good]), np.flatnonzero(good)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each distinct vector of a batch once, as bytes."""
    for batch in batches:
        x, ends, _ = whole_numbers(batch.column(0))
        data = x.astype("<i8").tobytes()
        found = {data[8 * a : 8 * b] for a, b in zip(np.append(0, ends[:-1]).tolist(), ends.tolist())} if len(ends) else set()
        yield pa.RecordBatch.from_arrays([pa.array(sorted(found), pa.binary())], names=["x"])


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<i8").reshape(-1, dim)


def _exact_products(y: np.ndarray) -> list[list[int]]:
    """y'y in whole numbers.  Floats are exact as long as every sum stays below 2^53; beyond that Python's numbers do it."""
    if len(y) * float(np.abs(y.astype(float)).max(initial=0)) ** 2 < 2**53:
        f = y.astype(np.float64)
        return [[int(v) for v in row] for row in f.T @ f]
    big = y.astype(object)
    return (big.T @ big).tolist()


def _sums(fit: DataFrame, dim: int) -> tuple[int, list[int]]:
    """How many vectors there are and their sum, exactly."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(dim, object)
        for batch in batches:
            x = _matrix(batch.column(0), dim)
            n += len(x)
            safe = len(x) * float(np.abs(x.astype(float)).max(initial=0)) < 2**62
            total = total + (x.sum(0).astype(object) if safe else x.astype(object).sum(0))
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([-1, *range(dim)], pa.int32()), pa.array([str(v) for v in (n, *total)])], names=["i", "v"])

    rows = _added(fit.mapInArrow(run, "i int, v string"), "i")
    found = {r.i: int(r.v) for r in rows}
    return found.get(-1, 0), [found.get(i, 0) for i in range(dim)]


def _added(partial: DataFrame, *by: str) -> list:
    """Totals of whole numbers over tasks.  One row for each key: as many as a vector or a matrix has entries."""
    return partial.groupBy(*by).agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v")).collect()


def _products(fit: DataFrame, dim: int, middle: list[int]) -> list[list[int]]:
    """The sum of (x - middle)(x - middle)' over all vectors, exactly."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if not batch.num_rows:
                continue
            y = _matrix(batch.column(0), dim) - np.array(middle, np.int64)
            part = np.array(_exact_products(y), object)
            total = part if total is None else total + part
        if total is not None:
            i, j = np.triu_indices(dim)
            yield pa.RecordBatch.from_arrays(
                [pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array([str(v) for v in total[i, j]])], names=["i", "j", "v"]
            )

    out = [[0] * dim for _ in range(dim)]
    for r in _added(fit.mapInArrow(run, "i int, j int, v string"), "i", "j"):
        out[r.i][r.j] = out[r.j][r.i] = int(r.v)
    return out


# ---- the factor and its rotation ---------------------------------------------------------


def pivoted_cholesky(a: np.ndarray, least: float = RANK) -> tuple[np.ndarray, np.ndarray]:
    """Lower trapezoidal ``l`` and an order ``p`` with a[p][:, p] = l l', largest pivot first; it ends where only rounding is left."""
    a = a.copy()
    d = len(a)
    p, l = np.arange(d), np.zeros((d, d), a.dtype)
    top = max(a.diagonal().max(initial=0), 0)
    for k in range(d):
        at = k + int(a.diagonal()[k:].argmax())
        if not a[at, at] > least * top:
            return l[:, :k], p
        for m in (a, l):
            m[[k, at]] = m[[at, k]]
        a[:, [k, at]] = a[:, [at, k]]
        p[[k, at]] = p[[at, k]]
        l[k, k] = np.sqrt(a[k, k])
        l[k + 1 :, k] = a[k + 1 :, k] / l[k, k]
        a[k + 1 :, k + 1 :] -= np.outer(l[k + 1 :, k], l[k + 1 :, k])
    return l, p


def one_sided_jacobi(l: np.ndarray, sweeps: int = 60) -> np.ndarray:
    """``l`` with its columns rotated until all are orthogonal.  Their norms are then its singular values."""
    u = l.copy()
    eps = np.finfo(u.dtype).eps * max(u.shape)
    for _ in range(sweeps):
        turned = False
        for i in range(u.shape[1] - 1):
            for j in range(i + 1, u.shape[1]):
                a, b = u[:, i], u[:, j]
                aa, bb, ab = a @ a, b @ b, a @ b
                if abs(ab) <= eps * np.sqrt(aa * bb):
                    continue
                turned = True
                zeta = (bb - aa) / (2 * ab)
                t = (1 if zeta >= 0 else -1) / (abs(zeta) + np.sqrt(1 + zeta * zeta))
                c = 1 / np.sqrt(1 + t * t)
                u[:, i], u[:, j] = c * a - c * t * b, c * t * a + c * b
        if not turned:
            return u
    raise RuntimeError(f"columns are not orthogonal after {sweeps} sweeps")


def eigen(scatter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues above rounding, falling, and their unit eigenvectors as columns, of a matrix without negative eigenvalues.

    Of each vector the entry of largest size is positive.
    """
    l, p = pivoted_cholesky(scatter)
    u = one_sided_jacobi(l)
    norms = np.sqrt((u * u).sum(0))
    by = np.argsort(-norms, kind="stable")
    vectors = np.zeros_like(u)
    vectors[p] = (u / norms)[:, by]
    signs = np.sign(vectors[np.abs(vectors).argmax(0), np.arange(vectors.shape[1])])
    return norms[by] ** 2, vectors * signs


# ---- the model ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Whitening:
    """What the fit gives: n vectors of ``dim`` entries with sums S; components as rows, each divided by the root of its eigenvalue."""

    dim: int
    n: int
    sums: tuple[int, ...]
    scaled: np.ndarray  # component x dim
    explained: np.ndarray
    error: float = 0.0

    @property
    def middle(self) -> np.ndarray:
        """Whole numbers next to the mean."""
        return np.array([s // self.n for s in self.sums], np.int64)

    @property
    def rest(self) -> np.ndarray:
        """What the mean has beyond ``middle``: 0 to 1."""
        return np.array([float(Fraction(s % self.n, self.n)) for s in self.sums])

    def project(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.middle) - self.rest) @ self.scaled.T

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """The sum over dimensions of (n x - S)^2, exactly; None beyond 64 bits."""
        y = x - self.middle
        rest = np.array([s % self.n for s in self.sums], np.int64)
        size = float(self.n) * (np.abs(y.astype(float)).max(initial=0) + 1)
        if size * size * max(1, self.dim) < 2**62:
            d = self.n * y - rest
            return (d * d).sum(1).tolist()
        d = self.n * y.astype(object) - rest.astype(object)
        return [v if v < 1 << 63 else None for v in (d * d).sum(1)]


def _error(fit: DataFrame, model: Whitening) -> float:
    """The largest entry by which the covariance of the whitened vectors differs from the identity, measured on all of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(model.scaled)
        first, second = np.zeros(k), np.zeros((k, k))
        for batch in batches:
            z = model.project(_matrix(batch.column(0), model.dim))
            first += z.sum(0)
            second += z.T @ z
        i, j = np.triu_indices(k)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(i, np.arange(k)).astype(np.int32)), pa.array(np.append(j, np.full(k, -1)).astype(np.int32)), pa.array(np.append(second[i, j], first))],
            names=["i", "j", "v"],
        )

    rows = fit.mapInArrow(run, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect()
    mean = {r.i: r.v / model.n for r in rows if r.j < 0}
    return max((abs(r.v / model.n - mean[r.i] * mean[r.j] - (r.i == r.j)) for r in rows if r.j >= 0), default=0.0)


def fit(df: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> Whitening | None:
    """The whitening of the distinct vectors of ``df``; None if there is none, or no two that differ.

    The vectors are whole numbers, so sums and centred products are exact, whatever tasks add them up and in which order; a matrix of
    dim x dim numbers is all that reaches the driver.  Vectors of another length than most distinct ones (ties: the longer)
    do not take part.
    """
    distinct = written(df.select(df[f"`{vector}`"].alias("v")).mapInArrow(_digests, "x binary").distinct(), "vectors")
    lengths = distinct.groupBy(F.octet_length("x").alias("bytes")).count().orderBy(F.desc("count"), F.desc("bytes")).head(1)
    if not lengths or not lengths[0]["bytes"]:
        return None
    dim = lengths[0]["bytes"] // 8
    same = distinct.where(F.octet_length("x") == 8 * dim)
    n, sums = _sums(same, dim)
    middle = [s // n for s in sums]
    rest = [s % n for s in sums]  # n times what the mean has beyond the middle
    products = _products(same, dim, middle)
    # sums of products of x - S/n: those of x - middle less n (S/n - middle)(S/n - middle)'
    scatter = np.array([[np.longdouble(int(n * products[i][j] - rest[i] * rest[j])) for j in range(dim)] for i in range(dim)]) / n
    values, vectors = eigen(scatter)
    if not len(values):
        return None
    k = min(components, len(values))
    scaled = (vectors[:, :k] / np.sqrt(values[:k] / n)).T.astype(np.float64)
    model = Whitening(dim, n, tuple(sums), scaled, (values[:k] / scatter.trace()).astype(np.float64))
    return Whitening(dim, n, tuple(sums), model.scaled, model.explained, _error(same, model))


def _rows(model: Whitening):
    k = len(model.scaled)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, ends, valid = whole_numbers(batch.column(1))
            sizes = np.diff(np.append(0, ends))
            fits = sizes == model.dim
            x = x[np.repeat(fits, sizes)].reshape(-1, model.dim)
            z = model.project(x)
            m = len(x)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(np.repeat(valid[fits], k))),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * k, model.n)),
                    pa.array(model.deviations(x), pa.int64()).take(pa.array(np.repeat(np.arange(m), k))),
                    pa.array(z.ravel()),
                    pa.array(np.tile(model.explained, m)),
                    pa.array(np.full(m * k, model.error)),
                ],
                names=["row", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return run


def whiten(df: DataFrame, vector: str = "embedding", keep: tuple[str, ...] | None = None, components: int = COMPONENTS) -> DataFrame:
    """A row for each row of ``df`` with a vector and each of up to ``components`` components, with the columns ``keep`` (all by default).

    Rows whose vector is null or has a null, infinite or NaN entry are dropped, and so are those of another length than most
    distinct vectors.  An entry c becomes the whole number floor(64 c) + 1,000,000 (entries beyond 2^62 / 64 are cut to that).  The fit takes
    each distinct vector once: ``n`` of them.  Components are unit eigenvectors of their covariance (divisor n), numbered by falling
    eigenvalue; those of eigenvalue 0 are left out, so without two vectors that differ there are no rows.  ``whitened`` is the
    centred vector on the component over the root of the eigenvalue, ``explained`` the eigenvalue's share of the trace,
    ``deviation`` the sum over dimensions of (n x - S)^2 (null if it needs more than 64 bits) and ``identity_error`` how far the covariance of the
    whitened vectors is from the identity.  Repeated rows stay, each with its rows.  Columns already called like these are replaced.
    """
    names = ("component", "n", "deviation", "whitened", "explained", "identity_error")
    keep = tuple(c for c in (df.columns if keep is None else keep) if c.lower() not in names)
    rows = df.select(kept(df, keep), df[f"`{vector}`"].alias("v"))
    schema = T.StructType(
        [rows.schema["row"], *T.StructType.fromDDL("component int, n long, deviation long, whitened double, explained double, identity_error double").fields]
    )
    model = fit(df, vector, components)
    if model is None:
        return df.sparkSession.createDataFrame([], schema).select("row.*", *names)
    return rows.mapInArrow(_rows(model), schema).select("row.*", *names)


def op12_whitening(spark, sf_dir: str) -> DataFrame:
    """Every embedding on the first 16 components of all of them, whitened."""
    return whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding"), keep=("vec_id",))
