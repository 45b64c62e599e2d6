"""Whitening of embeddings: principal components of the covariance, scaled to unit variance.

Vectors become whole numbers x = floor(1024 c) + 100000, whose sums are exact. The scatter is summed over all vectors, centred
before they are multiplied: each task returns one row of numbers for each dimension, and these rows are added up by dimension. Only
sums of d and d x d numbers reach the driver, d at most ``MAX_DIMENSIONS``. There a Cholesky factorisation with diagonal pivoting gives
a triangular factor L of the scatter, and one-sided Jacobi rotations make the columns of L orthogonal: their squared norms are the
eigenvalues of the scatter, the normalised columns its eigenvectors. Many disjoint pairs of columns turn at once, in rounds as of a
tournament. The pivots end at the rank, so components of no variance do not come up.

A second pass over the vectors projects them. Their covariance, computed by Spark from the whitened rows, gives the error.

Cases: a null vector, one with null or non-finite entries or without entries, and one with an entry of 2^51 or more (whose x no
long holds safely) is left out; so are vectors of another length than the most frequent one (of equally frequent ones the longest).
Null ids are ids like others; repeated rows each count and get results; other columns are ignored. Where there are fewer
components of some variance than asked for (equal vectors, a single one), so many come back; an empty table gives an empty result.
A deviation beyond 38 digits is null.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, FloatType, StructType

from .common import shared_folder, staged, table

SCALE = 1024
SHIFT = 100_000
COMPONENTS = 8
MAX_DIMENSIONS = 2048
"""Longest vectors: the driver holds a matrix of their length squared."""
LARGEST = 2.0**51
BATCH = 4096
"""Vectors multiplied at a time."""
MAX_SWEEPS = 60
_LONG = (1 << 63) - 1


# ---------------------------------------------------------------- numbers of vectors


def _entries(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Offsets, lengths (0: not usable) and all entries of a column of lists."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    offsets = column.offsets.to_numpy().astype(np.int64)
    values = column.values.cast(pa.float64()).to_numpy(zero_copy_only=False)
    with np.errstate(invalid="ignore"):
        bad = ~(np.abs(values) < LARGEST)
    before = np.concatenate([[0], np.cumsum(bad)])
    usable = column.is_valid().to_numpy(zero_copy_only=False) & (before[offsets[1:]] == before[offsets[:-1]])
    return offsets[:-1], np.where(usable, np.diff(offsets), 0), values


def _numbers(column: pa.Array, size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and x of the usable vectors of ``size`` entries, ``BATCH`` at a time."""
    begin, length, values = _entries(column)
    rows = np.flatnonzero(length == size)
    for k in range(0, len(rows), BATCH):
        some = rows[k : k + BATCH]
        yield some, np.floor(values[begin[some][:, None] + np.arange(size)] * SCALE).astype(np.int64) + SHIFT


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each length met in a task: number of vectors, and sums of x by dimension in two halves of 32 bits."""
    sums: dict[int, list] = {}
    for batch in batches:
        column = batch.column(0)
        for size in np.unique(_entries(column)[1]).tolist():
            if 0 < size <= MAX_DIMENSIONS:
                for rows, x in _numbers(column, size):
                    at = sums.setdefault(size, [0, np.zeros(size, np.int64), np.zeros(size, np.int64)])
                    at[0] += len(rows)
                    at[1] += (x >> 32).sum(axis=0)
                    at[2] += (x & 0xFFFFFFFF).sum(axis=0)
    for size, (n, high, low) in sums.items():
        yield pa.RecordBatch.from_pydict({"size": [size], "n": [n], "high": [high], "low": [low]})


@dataclass(frozen=True)
class Fit:
    """Count, exact sums S by dimension, trace and eigenvalues of the covariance, components as columns."""

    n: int
    sums: list[int]
    trace: float
    eigenvalues: np.ndarray
    components: np.ndarray

    @property
    def size(self) -> int:
        return len(self.sums)

    def centre(self) -> tuple[np.ndarray, np.ndarray]:
        """S / n as whole part and remainder."""
        return np.array([s // self.n for s in self.sums], np.int64), np.array([s % self.n for s in self.sums], np.int64)


def _scatter(vectors: DataFrame, n: int, sums: list[int]) -> np.ndarray:
    """The sum over all vectors of the products of their centred entries."""
    size = len(sums)
    whole = np.array([s // n for s in sums], np.int64)
    part = np.array([(s % n) / n for s in sums])

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for batch in batches:
            for _, x in _numbers(batch.column(0), size):
                y = (x - whole) - part
                total += y.T @ y
        for i in range(size):
            yield pa.RecordBatch.from_pydict({"dimension": [i], "products": [total[i, i:]]})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, products in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                totals[i] = totals.get(i, 0.0) + products.values.to_numpy()
        for i, products in totals.items():
            yield pa.RecordBatch.from_pydict({"dimension": [i], "products": [products]})

    schema = "dimension bigint, products array<double>"
    summed = vectors.mapInArrow(multiply, schema).repartition("dimension").mapInArrow(add, schema)
    upper = np.zeros((size, size))
    for i, products in summed.collect():  # MAX_DIMENSIONS rows at most
        upper[i, i:] = products
    return upper + np.triu(upper, 1).T


# ---------------------------------------------------------------- factors


def pivoted_cholesky(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the pivots, and L with matrix[order][:, order] = L L', lower trapezoidal, one column for each rank."""
    d = len(matrix)
    order, left = np.arange(d), matrix.diagonal().copy()
    least = d * np.finfo(float).eps * left.max(initial=0.0)
    factor = np.zeros((d, d))
    for k in range(d):
        p = k + int(np.argmax(left[order[k:]]))
        if left[order[p]] <= least:
            return order, factor[:, :k]
        order[[k, p]], factor[[k, p]] = order[[p, k]], factor[[p, k]]
        factor[k, k] = np.sqrt(left[order[k]])
        factor[k + 1 :, k] = (matrix[order[k + 1 :], order[k]] - factor[k + 1 :, :k] @ factor[k, :k]) / factor[k, k]
        left[order[k + 1 :]] -= factor[k + 1 :, k] ** 2
    return order, factor


def orthogonal_columns(factor: np.ndarray) -> np.ndarray:
    """The columns of ``factor`` rotated among each other until all pairs are orthogonal to double precision."""
    g = np.concatenate([factor, np.zeros((len(factor), factor.shape[1] % 2))], axis=1)
    m = g.shape[1]
    seats = np.arange(m)
    least = np.finfo(float).eps * max(1, len(factor)) ** 0.5
    for _ in range(MAX_SWEEPS):
        worst = 0.0
        for _ in range(m - 1):
            a, b = seats[: m // 2], seats[m // 2 :][::-1]
            p, q = g[:, a], g[:, b]
            alpha, beta, gamma = (p * p).sum(axis=0), (q * q).sum(axis=0), (p * q).sum(axis=0)
            angle = np.abs(gamma) / np.maximum(np.sqrt(alpha * beta), np.finfo(float).tiny)
            worst = max(worst, float(angle.max(initial=0.0)))
            turn = angle > least
            if turn.any():
                a, b, p, q = a[turn], b[turn], p[:, turn], q[:, turn]
                zeta = (beta[turn] - alpha[turn]) / (2 * gamma[turn])
                t = np.where(zeta < 0, -1.0, 1.0) / (np.abs(zeta) + np.hypot(1.0, zeta))
                c = 1 / np.hypot(1.0, t)
                g[:, a], g[:, b] = c * p - c * t * q, c * t * p + c * q
            seats = np.concatenate([seats[:1], seats[-1:], seats[1:-1]])
        if worst <= least:
            break
    return g[:, : factor.shape[1]]


def components_of(scatter: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The greatest eigenvalues of a scatter and their unit vectors as columns; the largest entry of each is positive."""
    order, factor = pivoted_cholesky(scatter)
    rotated = orthogonal_columns(factor)
    values = (rotated * rotated).sum(axis=0)
    picked = np.argsort(-values, kind="stable")[:wanted]
    picked = picked[values[picked] > len(scatter) * np.finfo(float).eps * values.max(initial=0.0)]
    vectors = np.zeros((len(scatter), len(picked)))
    vectors[order] = rotated[:, picked] / np.sqrt(values[picked])
    largest = np.abs(vectors).argmax(axis=0)
    return values[picked], vectors * np.where(vectors[largest, np.arange(len(picked))] < 0, -1.0, 1.0)


# ---------------------------------------------------------------- fit and projection


def _vector(rows: DataFrame, name: str) -> Column:
    kind = rows.schema[name].dataType
    plain = isinstance(kind, ArrayType) and isinstance(kind.elementType, FloatType | DoubleType)
    return (rows[name] if plain else rows[name].cast("array<double>")).alias("vector")


def fit(rows: DataFrame, vector_column: str = "embedding", components: int = COMPONENTS) -> Fit | None:
    """Sums, covariance and components of all usable vectors; None if there are none."""
    vectors = rows.select(_vector(rows, vector_column))
    moments = vectors.mapInArrow(_moments, "size bigint, n bigint, high array<bigint>, low array<bigint>")
    moments = staged(moments, shared_folder(rows.sparkSession), "moments")
    by_size = moments.groupBy("size").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), F.desc("size")).first()
    if by_size is None:
        return None
    halves = moments.where(F.col("size") == by_size["size"]).select(F.posexplode(F.arrays_zip("high", "low")).alias("dimension", "half"))
    whole = [F.sum(F.col(f"half.{h}").cast("decimal(38,0)")).alias(h) for h in ("high", "low")]
    summed = halves.groupBy("dimension").agg(*whole).orderBy("dimension").collect()  # MAX_DIMENSIONS rows at most
    sums = [(int(r["high"]) << 32) + int(r["low"]) for r in summed]
    scatter = _scatter(vectors, by_size["n"], sums)
    values, unit = components_of(scatter, components)
    return Fit(by_size["n"], sums, float(scatter.trace() / by_size["n"]), values / by_size["n"], unit)


def _deviations(x: np.ndarray, n: int, whole: np.ndarray, rest: np.ndarray) -> pa.Array:
    """The exact sums over the dimensions of (n x - S)^2."""
    y = x - whole
    peak = int(np.abs(y).max(initial=0)) + 1
    if y.shape[1] * (n * peak) ** 2 <= _LONG:
        t = n * y - rest
        return pa.array((t * t).sum(axis=1)).cast(pa.decimal128(38, 0))
    if y.shape[1] * peak * max(peak, n) > _LONG:
        y, rest = y.astype(object), rest.astype(object)
    constant = sum(int(r) ** 2 for r in rest)
    squares, mixed = (y * y).sum(axis=1).tolist(), (y * rest).sum(axis=1).tolist()
    exact = (n * n * int(a) - 2 * n * int(b) + constant for a, b in zip(squares, mixed, strict=True))
    return pa.array([v if v < 10**38 else None for v in exact], pa.decimal128(38, 0))


def whiten(rows: DataFrame, fitted: Fit, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """id, deviation (sum over dimensions of (n x - S)^2) and whitened (one entry for each component) of every usable vector."""
    whole, rest = fitted.centre()
    scaled = fitted.components / np.sqrt(fitted.eigenvalues)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, x in _numbers(batch.column(1), fitted.size):
                values = ((x - whole) - rest / fitted.n) @ scaled
                ends = np.arange(len(at) + 1, dtype=np.int32) * values.shape[1]
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(values.ravel()))
                ids = batch.column(0).take(pa.array(at))
                yield pa.RecordBatch.from_arrays([ids, _deviations(x, fitted.n, whole, rest), lists], [id_column, "deviation", "whitened"])

    schema = StructType([rows.schema[id_column]]).add("deviation", "decimal(38,0)").add("whitened", ArrayType(DoubleType()))
    vectors = rows.select(rows[id_column], _vector(rows, vector_column))
    return vectors.mapInArrow(project, schema)


def identity_error(whitened: DataFrame, components: int) -> float:
    """The largest absolute entry of the whitened rows' covariance less the identity."""
    if not components:
        return 0.0
    pairs = [(a, b) for a in range(components) for b in range(a, components)]
    entries = [F.covar_pop(F.col("whitened")[a], F.col("whitened")[b]) for a, b in pairs]
    row = whitened.agg(*entries).first()
    return max(abs(value - (a == b)) for value, (a, b) in zip(row, pairs, strict=True))


# ---------------------------------------------------------------- the query


def op11_cholesky_jacobi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whitened entries of every usable vector, one row for each component."""
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    schema = f"vec_id {rows.schema['vec_id'].dataType.simpleString()}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    fitted = fit(rows)
    if fitted is None:
        return spark.createDataFrame([], schema)
    done = staged(whiten(rows, fitted), shared_folder(spark), "whitened")
    error = identity_error(done, len(fitted.eigenvalues))
    entries = done.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    shares = F.array(*(F.lit(float(e / fitted.trace)) for e in fitted.eigenvalues)) if len(fitted.eigenvalues) else F.array().cast("array<double>")
    return entries.select(
        "vec_id", (F.col("at") + 1).cast("int").alias("component"), F.lit(fitted.n).cast("long").alias("n"),
        F.col("deviation").try_cast("long").alias("deviation"), "whitened", F.get(shares, F.col("at")).alias("explained"),
        F.lit(float(error)).alias("identity_error"),
    )
