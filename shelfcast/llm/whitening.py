"""Whitening of embeddings by their leading principal components.

Passes over the vectors, each narrow until its sums meet: exact sums, then products of centred entries, then the
projection. Only one number a dimension and one a pair of dimensions reach the driver, so what it holds
grows with the square of a vector's length and not with the rows. There the covariance is reduced to a tridiagonal
matrix by Householder reflections; bisection on Sturm counts finds its leading eigenvalues; inverse
iteration, with vectors of close eigenvalues made orthogonal again, finds the components, which are broadcast.

Entries become whole numbers, floor(1024 * c) + 100000, so sums and the distances from the mean are exact.

Defined results: rows whose vector is null, empty or holds a null or non-finite entry are dropped, and so are
vectors that are not as long as most (the shorter length wins a tie). Entries beyond +-2^30 count as
+-2^30. Directions with less than 1e-12 of the leading variance cannot be scaled and are no components, so a
table of equal vectors, of one vector or of none has no rows. A deviation beyond 64 bits is null. Repeated rows
count each; columns besides those named are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.llm import texts

COMPONENTS = 8
SCALE, SHIFT = 1024, 100_000
LIMIT = 2.0**30
#: Entries of a piece of rows that is worked on at once.
PIECE = 1 << 19
#: Directions with a smaller share of the leading variance are no components.
LEAST_SHARE = 1e-12
#: Eigenvalues nearer than this share of the matrix norm form a cluster.
CLUSTER = 1e-3


# Eigenvectors of a small symmetric matrix -----------------------------------------------------------


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, off-diagonal and Householder vectors of the tridiagonal matrix similar to ``matrix``."""
    a = matrix.astype(float).copy()
    n = len(a)
    off, reflectors = np.zeros(max(n - 1, 0)), []
    for k in range(n - 1):
        v = a[k + 1 :, k].copy()
        size = np.linalg.norm(v)
        if len(v) > 1 and np.abs(v[1:]).max() > 0:
            off[k] = -np.copysign(size, v[0])
            v[0] -= off[k]
            v /= np.linalg.norm(v)
            p = 2 * (a[k + 1 :, k + 1 :] @ v)
            w = p - (v @ p) * v
            a[k + 1 :, k + 1 :] -= np.outer(v, w) + np.outer(w, v)
        else:
            off[k] = v[0]
            v[:] = 0
        reflectors.append(v)
    return np.diag(a).copy(), off, reflectors


def sturm_count(diagonal: np.ndarray, off: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Eigenvalues below each value of ``at``: the negative pivots of the shifted matrix."""
    tiny = np.finfo(float).tiny * 1e16
    pivot = diagonal[0] - at
    below = (pivot < 0).astype(int)
    for d, square in zip(diagonal[1:], off**2, strict=True):
        pivot = np.where(np.abs(pivot) < tiny, -tiny, pivot)
        pivot = d - at - square / pivot
        below += pivot < 0
    return below


def leading_values(diagonal: np.ndarray, off: np.ndarray, count: int) -> np.ndarray:
    """The ``count`` largest eigenvalues, falling, each to the last bit that bisection can tell."""
    n = len(diagonal)
    reach = np.abs(np.r_[0, off]) + np.abs(np.r_[off, 0])
    rank = n - 1 - np.arange(min(count, n))
    low = np.full(len(rank), (diagonal - reach).min())
    high = np.full(len(rank), (diagonal + reach).max())
    high += np.abs(high) * 1e-15 + np.finfo(float).tiny
    while True:
        middle = low + (high - low) / 2
        if np.all((middle <= low) | (middle >= high)):
            return middle
        above = sturm_count(diagonal, off, middle) <= rank
        low, high = np.where(above, middle, low), np.where(above, high, middle)


def solve_shifted(diagonal: np.ndarray, off: np.ndarray, shift: float, right: np.ndarray) -> np.ndarray:
    """Solution of the shifted tridiagonal system by elimination with row exchanges."""
    n = len(diagonal)
    d, up, second = diagonal - shift, np.r_[off, 0.0], np.zeros(n)
    low, x = off.copy(), right.copy()
    least = np.finfo(float).eps * (np.abs(diagonal).max() + np.abs(off).max(initial=0.0)) or 1.0
    for i in range(n - 1):
        if abs(low[i]) > abs(d[i]):
            d[i], low[i] = low[i], d[i]
            up[i], d[i + 1] = d[i + 1], up[i]
            second[i], up[i + 1] = up[i + 1], 0.0
            x[i], x[i + 1] = x[i + 1], x[i]
        if d[i] == 0:
            d[i] = least
        factor = low[i] / d[i]
        d[i + 1] -= factor * up[i]
        up[i + 1] -= factor * second[i]
        x[i + 1] -= factor * x[i]
    if abs(d[-1]) < least:
        d[-1] = least
    for i in reversed(range(n)):
        if i + 1 < n:
            x[i] -= up[i] * x[i + 1]
        if i + 2 < n:
            x[i] -= second[i] * x[i + 2]
        x[i] /= d[i]
    return x


def leading_pairs(matrix: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues of a symmetric matrix, falling, and their unit vectors as columns."""
    size = float(np.abs(matrix).max(initial=0.0))
    if size == 0:
        return np.zeros(0), np.zeros((len(matrix), 0))
    diagonal, off, reflectors = tridiagonal(matrix / size)
    values = leading_values(diagonal, off, count)
    norm = (np.abs(diagonal) + np.abs(np.r_[0, off]) + np.abs(np.r_[off, 0])).max()
    random = np.random.default_rng(0)
    found: list[np.ndarray] = []
    start = 0
    for k, value in enumerate(values):
        if k and values[k - 1] - value > CLUSTER * norm:
            start = k
        z = random.standard_normal(len(diagonal))
        for _ in range(5):
            z = solve_shifted(diagonal, off, value, z / np.linalg.norm(z))
            z /= np.abs(z).max()
            for _ in range(2):
                for other in found[start:]:
                    z -= (other @ z) * other
        found.append(z / np.linalg.norm(z))
    columns = np.array(found).T
    for k in reversed(range(len(reflectors))):
        v = reflectors[k]
        columns[k + 1 :] -= 2 * np.outer(v, v @ columns[k + 1 :])
    return values * size, columns


# The distributed passes -----------------------------------------------------------------------------


@dataclass(frozen=True)
class Whitener:
    """Row count, exact sums, eigenvalues, components as columns and the whole variance of a fit list."""

    n: int
    sums: np.ndarray
    values: np.ndarray
    components: np.ndarray
    trace: float

    def gaps(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, exact."""
        return self.n * x - self.sums

    def whiten(self, gaps: np.ndarray) -> np.ndarray:
        return (gaps / self.n) @ self.components / np.sqrt(self.values)


def usable(df: DataFrame, keep: list[str], vector: str = "embedding") -> DataFrame:
    """Columns ``keep`` as k0, k1, ... and ``_vector``, without rows that hold no numbers."""
    def number(c):
        return c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))

    named = texts.with_id(df, **{f"k{i}": c for i, c in enumerate(keep)}, _vector=vector)
    whole = F.col("_vector").isNotNull() & F.coalesce(F.forall("_vector", number), F.lit(False))
    return named.where(whole & (F.size("_vector") > 0)).withColumn("_vector", F.col("_vector").cast("array<double>"))


def of_common_length(vectors: DataFrame) -> tuple[DataFrame, int]:
    """The vectors as long as most, and that length; 0 if there are none."""
    size = F.size("_vector")
    top = vectors.groupBy(size.alias("d")).count().orderBy(F.desc("count"), "d").first()
    return (vectors.where(size == top["d"]), top["d"]) if top else (vectors, 0)


def _whole_numbers(column: pa.Array, d: int) -> np.ndarray:
    entries = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
    return np.floor(SCALE * np.clip(entries, -LIMIT, LIMIT)).astype(np.int64) + SHIFT


def _pieces(batches: Iterator[pa.RecordBatch], d: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    rows = max(1, PIECE // d)
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            part = batch.slice(start, rows)
            yield part, _whole_numbers(part.column("_vector"), d)


def exact_sums(vectors: DataFrame, d: int) -> tuple[int, np.ndarray]:
    """Rows and the sum of every dimension."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, np.zeros(d, np.int64)
        for _, x in _pieces(batches, d):
            n, sums = n + len(x), sums + x.sum(0)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(d)), pa.array(np.full(d, n)), pa.array(sums)], ["i", "n", "s"])

    per_task = vectors.select("_vector").mapInArrow(run, "i long, n long, s long")
    rows = per_task.groupBy("i").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).orderBy("i").collect()
    return (rows[0]["n"], np.array([r["s"] for r in rows])) if rows else (0, np.zeros(d, np.int64))


def products(vectors: DataFrame, d: int, width: int, rows_of) -> np.ndarray:
    """The sum over all rows of the outer product of ``rows_of(x)``, ``width`` wide, with itself."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for _, x in _pieces(batches, d):
            y = rows_of(x)
            total += y.T @ y
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width)), pa.array(list(total))], ["i", "row"])

    def add(table: pa.Table) -> pa.Table:
        total = np.sum(np.stack(table.column("row").to_numpy()), axis=0)
        return pa.table({"i": table.column("i").slice(0, 1), "row": [total]})

    schema = "i long, row array<double>"
    rows = vectors.select("_vector").mapInArrow(run, schema).groupBy("i").applyInArrow(add, schema).collect()
    return np.array([r["row"] for r in sorted(rows)]) if rows else np.zeros((width, width))


def fit(df: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> tuple[Whitener, DataFrame]:
    """The whitener of all usable vectors, and those vectors."""
    vectors, d = of_common_length(usable(df, [], vector))
    return _fit(vectors, d, components), vectors


def _fit(vectors: DataFrame, d: int, components: int) -> Whitener:
    n, sums = exact_sums(vectors, d) if d else (0, np.zeros(0, np.int64))
    if not n:
        return Whitener(0, sums, np.zeros(0), np.zeros((d, 0)), 0.0)
    covariance = products(vectors, d, d, lambda x: (n * x - sums) / n) / n
    values, columns = leading_pairs((covariance + covariance.T) / 2, components)
    kept = values > LEAST_SHARE * (values[0] if len(values) else 0.0)
    return Whitener(n, sums, values[kept], columns[:, kept], float(np.trace(covariance)))


def identity_error(vectors: DataFrame, model: Whitener) -> float:
    """The largest absolute entry of the covariance of the whitened vectors minus the identity."""
    width = len(model.values)
    # A column of ones beside them gives the sums for the mean, which is 0 but for rounding.
    found = products(vectors, len(model.sums), width + 1, lambda x: np.c_[model.whiten(model.gaps(x)), np.ones(len(x))])
    mean = found[width, :width] / model.n
    return float(np.abs(found[:width, :width] / model.n - np.outer(mean, mean) - np.eye(width)).max())


def _squares(gaps: np.ndarray) -> list[int | None]:
    """Sums of squares of rows, exact; None beyond 64 bits."""
    about = (gaps.astype(float) ** 2).sum(1)
    exact = (gaps**2).sum(1).tolist()
    for k in np.flatnonzero(about > 2.0**62):
        total = sum(int(g) ** 2 for g in gaps[k])
        exact[k] = total if total < 1 << 63 else None
    return exact


def whitened(df: DataFrame, keep: list[str], vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """Columns ``keep``, component, n, deviation, whitened, explained and identity_error, by row and component."""
    vectors, d = of_common_length(usable(df, keep, vector))
    model = _fit(vectors, d, components)
    width = len(model.values)
    error = identity_error(vectors, model) if width else 0.0
    fields = [T.StructField("component", T.IntegerType()), T.StructField("n", T.LongType()), T.StructField("deviation", T.LongType()),
              T.StructField("whitened", T.DoubleType()), T.StructField("explained", T.DoubleType()),
              T.StructField("identity_error", T.DoubleType())]
    schema = T.StructType([*vectors.schema.fields[:-1], *fields])
    if not width:
        return df.sparkSession.createDataFrame([], schema).toDF(*keep, *[f.name for f in fields])
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        share = own.values / own.trace
        for part, x in _pieces(batches, d):
            gaps = own.gaps(x)
            size = len(x)
            each = pa.array(np.repeat(np.arange(size), width))
            yield pa.RecordBatch.from_arrays(
                [*[c.take(each) for c in part.columns[:-1]], pa.array(np.tile(np.arange(1, width + 1, dtype=np.int32), size)),
                 pa.array(np.full(size * width, own.n)), pa.array(_squares(gaps), pa.int64()).take(each),
                 pa.array(own.whiten(gaps).ravel()), pa.array(np.tile(share, size)), pa.array(np.full(size * width, error))],
                schema.names)

    return vectors.mapInArrow(run, schema).toDF(*keep, *[f.name for f in fields])
