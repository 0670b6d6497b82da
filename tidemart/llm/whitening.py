"""Whitening of embeddings on the principal components of their covariance.

Sums and covariances are added up by Spark, one small matrix per task. The covariance of
``d`` dimensions, ``d * d`` numbers whatever the number of rows, is split on the driver by
spectral divide and conquer: the polar factor U of the covariance less a shift gives the
projector (U + I) / 2 on the components above the shift; an orthonormal basis of its range and
one of the rest split the matrix into two smaller ones, and so on down to single components.
The polar factor comes from the QDWH iteration (dynamically weighted Halley steps by QR, and
by Cholesky once the matrix is well conditioned). The components then go to every task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.llm.common import stored

_EPS = np.finfo(np.float64).eps
_LONG = np.iinfo(np.int64)


# ---------------------------------------------------------------- spectral divide and conquer

def polar(a: np.ndarray) -> np.ndarray:
    """The orthogonal polar factor of a square matrix, by QDWH."""
    n = len(a)
    scale = np.linalg.norm(a)
    if not scale:
        return np.eye(n)
    x, eye = a / scale, np.eye(n)
    # a lower bound of the least singular value, from the triangular factor
    r = np.linalg.qr(x, mode="r")
    diagonal = np.abs(np.diag(r))
    low = _EPS
    if diagonal.min() > _EPS:
        low = min(1.0, max(_EPS, 1 / np.linalg.norm(np.linalg.inv(r))))
    for _ in range(40):
        d = (4 * (1 - low ** 2) / low ** 4) ** (1 / 3)
        wide = np.sqrt(1 + d)
        w = wide + np.sqrt(max(0.0, 8 - 4 * d + 8 * (2 - low ** 2) / (low ** 2 * wide))) / 2
        b = (w - 1) ** 2 / 4
        c = w + b - 1
        if c > 100:
            q, _ = np.linalg.qr(np.vstack([np.sqrt(c) * x, eye]))
            new = b / c * x + (w - b / c) / np.sqrt(c) * q[:n] @ q[n:].T
        else:
            chol = np.linalg.cholesky(eye + c * x.T @ x)
            half = np.linalg.solve(chol, x.T)
            new = b / c * x + (w - b / c) * np.linalg.solve(chol.T, half).T
        moved = np.linalg.norm(new - x)
        x = new
        low = min(1.0, low * (w + b * low ** 2) / (1 + c * low ** 2))
        if abs(low - 1) < 10 * _EPS and moved < _EPS ** (1 / 3):
            break
    return x


def _split(a: np.ndarray, shift: float) -> tuple[np.ndarray, np.ndarray] | None:
    """Orthonormal bases of the invariant subspaces above and below the shift, or None if
    one of them is empty or an eigenvalue lies too close to the shift."""
    n = len(a)
    projector = (polar(a - shift * np.eye(n)) + np.eye(n)) / 2
    projector = (projector + projector.T) / 2
    k = int(round(np.trace(projector)))
    if not 0 < k < n:
        return None
    # columns of the projector by falling remaining norm span its range
    work, chosen = projector.copy(), []
    for _ in range(k):
        j = int(np.argmax((work * work).sum(axis=0)))
        chosen.append(j)
        v = work[:, j] / np.linalg.norm(work[:, j])
        work -= np.outer(v, v @ work)
    base = np.linalg.qr(projector[:, chosen])[0]
    full = np.linalg.qr(projector @ base, mode="complete")[0]
    upper, lower = full[:, :k], full[:, k:]
    if np.linalg.norm(lower.T @ a @ upper) > 100 * n * _EPS * np.linalg.norm(a):
        return None
    return upper, lower


def eigen(a: np.ndarray, wanted: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns) of a symmetric matrix; only the
    ``wanted`` largest if given."""
    top = len(a) if wanted is None else min(wanted, len(a))
    floor = len(a) * _EPS * np.linalg.norm(a)
    vectors: list[np.ndarray] = []

    def divide(part: np.ndarray, basis: np.ndarray) -> None:
        if len(vectors) >= top:
            return
        n, spread = len(part), part - np.trace(part) / len(part) * np.eye(len(part))
        if n == 1 or np.linalg.norm(spread) <= floor:
            vectors.extend(basis.T)
            return
        middle, width = np.trace(part) / n, np.linalg.norm(spread) / np.sqrt(n)
        # some eigenvalues lie above the mean and some below; the median splits more evenly
        for shift in (float(np.median(np.diag(part))), middle, *(
                middle + t * width for t in (.1, -.1, .3, -.3, .5, -.5, .7, -.7, .9, -.9))):
            bases = _split(part, shift)
            if bases:
                for base in bases:
                    smaller = base.T @ part @ base
                    divide((smaller + smaller.T) / 2, basis @ base)
                return
        raise ArithmeticError("no shift splits the matrix")

    divide((a + a.T) / 2, np.eye(len(a)))
    v = np.array(vectors).T.reshape(len(a), -1)
    values = np.einsum("ij,ij->j", v, a @ v)
    order = np.argsort(-values, kind="stable")[:top]
    return values[order], v[:, order]


# ---------------------------------------------------------------- the vectors

def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches cut to about half a million entries each."""
    for batch in batches:
        entries = pc.sum(pc.list_value_length(batch.column(0))).as_py() or 0
        step = max(1, batch.num_rows * (1 << 19) // max(entries, 1))
        for at in range(0, batch.num_rows, step):
            yield batch.slice(at, step)


def _vectors(column: pa.Array, scale: int, offset: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and x-vectors of the usable rows, by length."""
    size = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    flat = np.asarray(pc.fill_null(column.flatten().cast(pa.float64()), np.nan))
    starts = np.cumsum(size) - size
    out = []
    for length in np.unique(size[size > 0]).tolist():
        rows = np.flatnonzero(size == length)
        with np.errstate(over="ignore", invalid="ignore"):
            x = np.floor(flat[starts[rows][:, None] + np.arange(length)] * scale)
        good = (np.abs(x) < 2.0 ** 62).all(axis=1)      # not so for NaN and infinity either
        if good.any():
            out.append((rows[good], x[good].astype(np.int64) + offset))
    return out


def _sums(rows: DataFrame, scale: int, offset: int) -> DataFrame:
    """``length, at, n, total`` (rows and sum of each dimension, as decimals) by vector length."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[int, np.ndarray]] = {}
        for batch in _pieces(batches):
            for _, x in _vectors(batch.column(0), scale, offset):
                n, total = held.get(x.shape[1], (0, 0))
                # two halves of 32 bits add up without overflow
                part = np.stack([(x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0)])
                held[x.shape[1]] = n + len(x), total + part
        for length, (n, total) in held.items():
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(length, length)), pa.array(np.arange(length)),
                pa.array(np.full(length, n)), pa.array(total[0]), pa.array(total[1])],
                names=["length", "at", "n", "high", "low"])

    found = rows.mapInArrow(run, "length long, at long, n long, high long, low long")
    wide = lambda c: F.sum(F.col(c).cast("decimal(28,0)"))
    return found.groupBy("length", "at").agg(
        F.sum("n").alias("n"), wide("high").alias("high"), wide("low").alias("low"))


def _products(rows: DataFrame, values, size: int) -> np.ndarray:
    """Sum over all rows of the outer product of ``values(batch)``, rows of ``size`` doubles."""
    upper = np.triu_indices(size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for batch in _pieces(batches):
            z = values(batch)
            total += z.T @ z
        yield pa.RecordBatch.from_arrays([
            pa.array(upper[0]), pa.array(upper[1]), pa.array(total[upper])],
            names=["i", "j", "total"])

    cells = rows.mapInArrow(run, "i long, j long, total double").groupBy("i", "j").agg(
        F.sum("total").alias("total")).collect()
    out = np.zeros((size, size))
    for r in cells:
        out[r["i"], r["j"]] = out[r["j"], r["i"]] = r["total"]
    return out


def whiten(rows: DataFrame, components: int = 8, key: str = "vec_id",
           vector: str = "embedding", scale: int = 1024, offset: int = 100_000) -> DataFrame:
    """``key, component, n, deviation, whitened, explained, identity_error``: a row for each
    usable vector and component, components by falling variance from 1.

    Entries become the integers ``x = floor(scale * c) + offset``. Not usable, and left out, are
    null vectors and those that hold null, NaN, infinite or (after scaling) 2^62 and larger
    entries, empty vectors, and vectors of another length than most have (of equally frequent
    lengths the longest counts). ``deviation`` is the exact squared distance of n * x from the
    sums, null where it does not fit a long. A component without variance cannot be whitened:
    there are no rows for it, so equal vectors, or a single one, give none, and neither does an
    empty table. Of components with equal variance any basis may come. Repeated rows and keys
    count as often as they come; keys may be null; extra columns are ignored.

    The table is read four times; tasks hold one batch and a matrix of ``d * d`` numbers,
    which are added up by cell before they reach the driver.
    """
    spark, schema = rows.sparkSession, T.StructType([
        rows.schema[key], T.StructField("component", T.IntegerType()),
        T.StructField("n", T.LongType()), T.StructField("deviation", T.LongType()),
        *(T.StructField(c, T.DoubleType()) for c in ("whitened", "explained", "identity_error"))])
    vectors = rows.select(vector)
    sums = stored(_sums(vectors, scale, offset), "sums")
    most = sums.where("at = 0").orderBy(F.desc("n"), F.desc("length")).limit(1)
    fit = sums.join(most.select("length"), "length", "left_semi").orderBy("at").collect()
    if not fit:
        return spark.createDataFrame([], schema)
    n, dims = fit[0]["n"], len(fit)
    total = [(int(r["high"]) << 32) + int(r["low"]) for r in fit]
    # x - S/n as (x - whole) - rest / n, which loses nothing where x and S are large
    whole = np.array([s // n for s in total], dtype=np.int64)
    rest = np.array([s % n for s in total], dtype=np.int64)

    def chosen(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        for at, x in _vectors(batch.column(0), scale, offset):
            if x.shape[1] == dims:
                return at, x
        return np.empty(0, dtype=np.int64), np.empty((0, dims), dtype=np.int64)

    def centred(batch: pa.RecordBatch) -> np.ndarray:
        return (chosen(batch)[1] - whole) - rest / n

    covariance = _products(vectors, centred, dims) / n
    trace = float(np.trace(covariance))
    values, found = eigen(covariance, components)
    real = values > dims * _EPS * trace
    values, found = values[real], found[:, real]
    if not len(values):
        return spark.createDataFrame([], schema)
    weights, explained = found / np.sqrt(values), values / trace
    again = _products(vectors, lambda batch: centred(batch) @ weights, len(values)) / n
    error = float(np.abs(again - np.eye(len(values))).max())
    names = schema.names

    def distances(x: np.ndarray) -> pa.Array:
        y = x - whole
        peak = int(np.abs(y).max(initial=0)) + 1
        if n * peak * n * peak * dims <= _LONG.max:
            z = n * y - rest
            return pa.array(np.einsum("ij,ij->i", z, z))
        exact = [sum((n * a - b) ** 2 for a, b in zip(row, rest.tolist())) for row in y.tolist()]
        return pa.array([d if d <= _LONG.max else None for d in exact], pa.int64())

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(values)
        for batch in _pieces(batches):
            at, x = chosen(batch)
            if not len(at):
                continue
            made = ((x - whole) - rest / n) @ weights
            each = np.repeat(np.arange(len(at)), k)
            yield pa.RecordBatch.from_arrays([
                batch.column(1).take(pa.array(at[each])),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(at))),
                pa.array(np.full(len(each), n, dtype=np.int64)),
                distances(x).take(pa.array(each)), pa.array(made.ravel()),
                pa.array(np.tile(explained, len(at))),
                pa.array(np.full(len(each), error))], names=names)

    return rows.select(vector, key).mapInArrow(project, schema)
