"""Embedding whitening: exact distributed covariance, eigenvectors refined in mixed precision.

Vectors become whole numbers, so that all sums over rows are exact and the same
on any partitioning: a first pass sums each dimension, a second one the products
of entries centred at the rounded means. What reaches the driver is one number
per pair of dimensions.

Eigenvectors come from single precision and are corrected by the iteration of
Ogita and Aishima, matrix products in extended precision that double the right
digits with every step. Eigenvalues too close for a step to tell apart form a
cluster; its vectors are turned by a sub-solve of the shifted matrix in the
subspace they span, where the differences are the leading digits.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtside.llm.vectors import decimals, exact_products, exact_squares, exact_sums, scaled
from courtside.session import ship_package

COMPONENTS = 8
SCALE = 1024
OFFSET = 100_000
# Whole numbers beyond this are taken as this, so that differences of them fit 64 bits.
LARGEST = 1 << 52
WIDE = np.longdouble
MAX_STEPS = 40
# Rows of a batch worked on at once.
ROWS = 8192
SCHEMA = (
    "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double, deviation_exact decimal(38,0)"
)


# --- eigenvectors ---


def _clusters(values: np.ndarray, close: float) -> list[np.ndarray]:
    """Places of eigenvalues that follow each other, in order of size, at no more than ``close``; those of two at least."""
    order = np.argsort(values)
    cuts = np.flatnonzero(np.diff(values[order]) > close) + 1
    return [c for c in np.split(order, cuts) if len(c) > 1]


def _lacking(x: np.ndarray) -> np.ndarray:
    """The identity less transpose(x) @ x."""
    r = np.eye(x.shape[1], dtype=x.dtype) - x.T @ x
    return (r + r.T) / 2


def _corrected(a: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, float, float]:
    """One Ogita-Aishima step: better vectors, the values, the distance below which values are not told apart, the size of the correction."""
    r = _lacking(x)
    s = x.T @ (a @ x)
    s = (s + s.T) / 2
    values = np.diag(s) / (1 - np.diag(r))
    off = s - np.diag(values)
    close = 2 * (np.sqrt((off * off).sum()) + np.sqrt((a * a).sum()) * np.sqrt((r * r).sum()))
    gap = values[None, :] - values[:, None]
    apart = np.abs(gap) > close
    # Half of r, and a part that is antisymmetric to the last digit and so keeps vectors orthogonal to first order.
    e = r / 2 + np.where(apart, (s + (values[None, :] + values[:, None]) / 2 * r) / np.where(apart, gap, 1), 0)
    return x + x @ e, values, close, float(np.abs(e).max())


def _sub_solved(a: np.ndarray, x: np.ndarray, cluster: np.ndarray, shift) -> np.ndarray:
    """The cluster's vectors turned to the eigenvectors of the matrix less ``shift`` in their subspace."""
    part = x[:, cluster]
    small = part.T @ (a @ part - shift * part)
    size = np.abs(small).max()
    if size == 0:
        return part
    turn = np.linalg.eigh(((small + small.T) / (2 * size)).astype(np.float64))[1]
    return part @ turn.astype(a.dtype)


def eigenvectors(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors in columns of a symmetric matrix of extended precision.

    The largest entry of each vector is positive. Vectors of equal eigenvalues
    are any orthonormal basis of their space.
    """
    size = np.abs(a).max(initial=0)
    if size == 0:
        return np.zeros(len(a), a.dtype), np.eye(len(a), dtype=a.dtype)
    unit = a / size
    x = np.linalg.eigh(unit.astype(np.float32))[1].astype(a.dtype)
    enough, last = 8 * np.finfo(a.dtype).eps, np.inf
    for step in range(MAX_STEPS):
        x, values, close, change = _corrected(unit, x)
        clusters = _clusters(values, close)
        for cluster in clusters:
            x[:, cluster] = _sub_solved(unit, x, cluster, values[cluster].mean())
        # Corrections have reached rounding: no cluster to turn, or none that turning still changes.
        if change < enough or (step > 4 and change >= last and change < 1e-16):
            break
        last = change
    # Corrections between close values leave second-order errors in angles; these go without turning anything.
    for _ in range(3):
        x = x + x @ (_lacking(x) / 2)
    values = (x * (unit @ x)).sum(0) / (x * x).sum(0)
    order = np.argsort(-values, kind="stable")
    values, x = values[order] * size, x[:, order]
    top = x[np.abs(x).argmax(0), np.arange(len(a))]
    return values, x * np.where(top < 0, -1, 1)


# --- passes over the rows ---


def _whole(vectors: pa.Array, scale: float, offset: int, dims: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    kept, values = scaled(vectors, scale, dims)
    return kept, np.clip(values, -LARGEST, LARGEST).astype(np.int64) + offset


def _pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            yield batch.slice(at, ROWS)


def _sums(vectors: DataFrame, scale: float) -> tuple[int, list[int]]:
    """Number of vectors that count, and the sum of each dimension without the offset."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, []
        for batch in _pieces(batches):
            _, x = _whole(batch.column(0), scale, 0)
            n += len(x)
            sums += [0] * (x.shape[1] - len(sums))
            for i, v in enumerate(exact_sums(x)):
                sums[i] += v
        yield pa.RecordBatch.from_pydict({"i": pa.array(range(-1, len(sums)), pa.int32()), "s": decimals([n, *sums])})

    found = vectors.mapInArrow(run, "i int, s decimal(38,0)").groupBy("i").agg(F.sum("s").alias("s"))
    told = {r["i"]: int(r["s"]) for r in found.collect()}  # one row per dimension
    n = told.pop(-1, 0)
    return n, [told[i] for i in sorted(told)]


def _covariance(vectors: DataFrame, scale: float, offset: int, n: int, sums: list[int]) -> np.ndarray:
    """The covariance with divisor ``n``; products are of entries less their rounded means and summed exactly."""
    dims = len(sums)
    centre = np.array([(2 * s + n) // (2 * n) for s in sums], np.int64)
    upper = np.triu_indices(dims)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dims, dims), object)
        for batch in _pieces(batches):
            _, x = _whole(batch.column(0), scale, offset, dims)
            total += exact_products(x - centre)
        yield pa.RecordBatch.from_pydict(
            {"i": pa.array(upper[0], pa.int32()), "j": pa.array(upper[1], pa.int32()), "s": decimals(total[upper].tolist())}
        )

    found = vectors.mapInArrow(run, "i int, j int, s decimal(38,0)").groupBy("i", "j").agg(F.sum("s").alias("s"))
    left = [s - n * int(c) for s, c in zip(sums, centre)]
    out = np.zeros((dims, dims), WIDE)
    for i, j, s in found.collect():  # one row per pair of dimensions
        out[i, j] = out[j, i] = WIDE(n * int(s) - left[i] * left[j]) / WIDE(n) / WIDE(n)
    return out


def _projected(x: np.ndarray, n: int, sums: list[int], turn: np.ndarray) -> tuple[list[int], np.ndarray]:
    """Sum of squares of n * x - S of each row, exact, and the whitened row."""
    top = max(int(np.abs(x).max(initial=0)) * n, max(map(abs, sums), default=0))
    kind = np.int64 if top < 1 << 62 else object
    away = x.astype(kind) * n - np.array(sums, kind)
    return exact_squares(away), (away / n).astype(np.float64) @ turn


def whiten(
    vectors: DataFrame, components: int = COMPONENTS, scale: float = SCALE, offset: int = OFFSET
) -> DataFrame:
    """Whitened coordinates of ``vectors`` (vec_id, embedding, any others): one row per vector and component.

    vec_id, component (from 1, by falling variance), n, deviation, whitened,
    explained, identity_error, deviation_exact. Entries become the whole number
    floor(``scale`` * entry) + ``offset``; beyond 2^52 in size they count as that.

    Rows whose vector is NULL or holds a NULL or non-finite entry give no rows.
    Shorter vectors are filled up with entries of 0; rows without vec_id, and
    rows that repeat, are rows of their own. There are as many components as
    dimensions at most. ``deviation`` is NULL where it does not fit 64 bits;
    ``deviation_exact`` has it always. Components without variance have NULL
    for ``whitened`` and do not count for ``identity_error``, which is told to
    twelve decimals; without any variance ``explained`` and ``identity_error``
    are NULL too. An empty table gives no rows.
    """
    spark = vectors.sparkSession
    ship_package(spark)
    only = vectors.select("embedding")
    n, sums = _sums(only, scale)
    sums = [s + n * offset for s in sums]
    dims = len(sums)
    if n == 0 or dims == 0:
        return spark.createDataFrame([], SCHEMA)
    covariance = _covariance(only, scale, offset, n, sums)
    values, basis = eigenvectors(covariance)
    trace = np.trace(covariance)
    count = min(components, dims)
    # What is below is rounding of a variance of 0.
    varies = values[:count] > trace * dims * np.finfo(np.float64).eps
    turn = (basis[:, :count] / np.sqrt(np.where(varies, values[:count], 1))).astype(np.float64)
    explained = [float(v / trace) if trace > 0 else None for v in values[:count]]
    error = _identity_error(only, scale, offset, n, sums, turn[:, varies])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _pieces(batches):
            kept, x = _whole(batch.column(1), scale, offset, dims)
            squares, z = _projected(x, n, sums, turn)
            ids = batch.column(0).filter(pa.array(kept))
            rows = np.repeat(np.arange(len(x)), count)
            exact = decimals(squares).take(pa.array(rows))
            fits = pa.array([s if s < 1 << 63 else None for s in squares], pa.int64()).take(pa.array(rows))
            again = lambda v, kind: pa.array(list(v) * len(x), kind)
            yield pa.RecordBatch.from_pydict(
                {
                    "vec_id": ids.take(pa.array(rows)).cast(pa.int64()),
                    "component": again(range(1, count + 1), pa.int32()),
                    "n": pa.array(np.full(len(rows), n), pa.int64()),
                    "deviation": fits,
                    "whitened": pa.array(z.ravel(), pa.float64(), mask=np.tile(~varies, len(x))),
                    "explained": again(explained, pa.float64()),
                    "identity_error": pa.array([error] * len(rows), pa.float64()),
                    "deviation_exact": exact,
                }
            )

    return vectors.select("vec_id", "embedding").mapInArrow(run, SCHEMA)


def _identity_error(vectors: DataFrame, scale: float, offset: int, n: int, sums: list[int], turn: np.ndarray) -> float | None:
    """Largest entry, in size, of the whitened rows' covariance less the identity; measured on all rows."""
    dims, count = turn.shape
    if count == 0:
        return None

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((count + 1, count))
        for batch in _pieces(batches):
            _, x = _whole(batch.column(0), scale, offset, dims)
            z = _projected(x, n, sums, turn)[1]
            total[:count] += z.T @ z
            total[count] += z.sum(0)
        i, j = np.indices(total.shape)
        yield pa.RecordBatch.from_pydict({"i": pa.array(i.ravel(), pa.int32()), "j": pa.array(j.ravel(), pa.int32()), "s": total.ravel()})

    found = vectors.mapInArrow(run, "i int, j int, s double").groupBy("i", "j").agg(F.sum("s").alias("s"))
    total = np.zeros((count + 1, count))
    for i, j, s in found.collect():  # one row per pair of components
        total[i, j] = s
    mean = total[count] / n
    return round(float(np.abs(total[:count] / n - np.outer(mean, mean) - np.eye(count)).max()), 12)
