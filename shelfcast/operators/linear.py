"""Ridge regression from merged moments: one scan gives the models of all folds, for any penalty.

Every task sums up its rows by step as count, means and centred products (``Moments``); two of these merge without
a loss of precision, whatever their means. The sums are merged in Spark by step and at most ``MERGED`` groups of tasks, so
the driver gets a bounded number of small matrices and solves the normal equations.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Functions of this module travel to the executors by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

MERGED = 32
#: A feature whose deviation is below this share of its mean is constant but for rounding.
CONSTANT = 1e-12
SUMS_SCHEMA = "part int, step int, n long, gaps long, data binary"


@dataclass(frozen=True)
class Moments:
    """Count, means and sums of products of deviations of some columns."""

    n: int
    mean: np.ndarray
    products: np.ndarray

    @staticmethod
    def of(x: np.ndarray) -> Moments:
        mean = x.mean(0) if len(x) else np.zeros(x.shape[1])
        return Moments(len(x), mean, (x - mean).T @ (x - mean))

    def __add__(self, other: Moments) -> Moments:
        n = self.n + other.n
        if not n:
            return self
        gap = other.mean - self.mean
        return Moments(n, self.mean + gap * (other.n / n),
                       self.products + other.products + np.outer(gap, gap) * (self.n * other.n / n))

    def packed(self) -> bytes:
        return np.concatenate([self.mean, self.products.ravel()]).tobytes()

    @staticmethod
    def unpacked(n: int, data: bytes, width: int) -> Moments:
        values = np.frombuffer(data)
        return Moments(n, values[:width], values[width:].reshape(width, width))


def step_moments(df: DataFrame, columns: Sequence[str], label: str, step: Column) -> dict[int, tuple[Moments, int]]:
    """Moments of the features and the label, in that order, by ``step``, and the rows that lack a feature.

    Rows without a label count for nothing; rows that lack a feature are in no moments.
    """
    width = len(columns) + 1
    named = [F.col(c).cast("double").alias(f"c{k}") for k, c in enumerate([*columns, label])]
    source = df.where(F.col(label).isNotNull()).select(step.cast("int").alias("step"), *named)

    def table(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
        arrays = [pa.array(list(c), kind) for c, kind in zip(zip(*rows, strict=True), kinds, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, ["part", "step", "n", "gaps", "data"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, tuple[Moments, int]] = {}
        for batch in batches:
            steps = batch.column(0).to_numpy(zero_copy_only=False)
            x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns[1:]]).astype(float)
            whole = ~np.isnan(x).any(1)
            for own in np.unique(steps):
                here = steps == own
                found, gaps = Moments.of(x[here & whole]), int(np.sum(here & ~whole))
                before = sums.get(int(own))
                sums[int(own)] = (before[0] + found, before[1] + gaps) if before else (found, gaps)
        if sums:
            part = TaskContext.get().partitionId()
            yield table([(part, own, m.n, gaps, m.packed()) for own, (m, gaps) in sums.items()])

    def merged(rows: list[dict]) -> tuple[Moments, int]:
        # In the order of the tasks, so that a fit repeats to the last bit.
        rows = sorted(rows, key=lambda r: r["part"])
        return reduce(Moments.__add__, [Moments.unpacked(r["n"], r["data"], width) for r in rows]), sum(r["gaps"] for r in rows)

    def merge(key, found):
        own, group = (k.as_py() for k in key)
        total, gaps = merged(found.to_pylist())
        return pa.Table.from_batches([table([(group, own, total.n, gaps, total.packed())])])

    sums = source.mapInArrow(add, SUMS_SCHEMA).groupBy("step", F.pmod("part", F.lit(MERGED)).alias("group")).applyInArrow(merge, SUMS_SCHEMA)
    by_step: dict[int, list[dict]] = {}
    for row in sums.toArrow().to_pylist():
        by_step.setdefault(row["step"], []).append(row)
    return {own: merged(rows) for own, rows in sorted(by_step.items())}


@dataclass(frozen=True)
class LinearModel:
    """Weights of the features as they are; ``mean`` and ``scale`` are those of training, a constant feature's scale is 0."""

    columns: tuple[str, ...]
    intercept: float
    weights: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    kind: str = "ridge"

    def transform(self, df: DataFrame) -> DataFrame:
        """Add ``prediction``, a plain column expression; null where a feature is missing."""
        parts = [F.col(c).cast("double") * F.lit(float(w)) for c, w in zip(self.columns, self.weights, strict=True)]
        return df.withColumn("prediction", reduce(Column.__add__, parts, F.lit(float(self.intercept))))

    def save(self, spark: SparkSession, path: str) -> None:
        """As a table of one row a feature."""
        rows = pa.table({
            "place": pa.array(range(len(self.columns)), pa.int32()), "column": pa.array(self.columns),
            "weight": pa.array(self.weights), "mean": pa.array(self.mean), "scale": pa.array(self.scale),
            "intercept": pa.array([float(self.intercept)] * len(self.columns))})
        spark.createDataFrame(rows).coalesce(1).write.mode("overwrite").parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> LinearModel:
        table = spark.read.parquet(path).orderBy("place").toArrow()
        weights, mean, scale, intercept = (table.column(c).to_numpy() for c in ("weight", "mean", "scale", "intercept"))
        return LinearModel(tuple(table.column("column").to_pylist()), float(intercept[0]), weights, mean, scale)


def solve(moments: Moments, columns: Sequence[str], alpha: float, scaled: bool = True) -> LinearModel:
    """Least squares with penalty ``alpha`` on features scaled by the population deviation, or as they are."""
    mean, products = moments.mean[:-1], moments.products
    scale = np.sqrt(np.diag(products)[:-1] / moments.n)
    varied = scale > CONSTANT * np.abs(mean)
    unit = np.where(varied, scale if scaled else 1.0, 1.0)
    gram = products[:-1, :-1] / np.outer(unit, unit)
    slope = products[:-1, -1] / unit
    weights = np.zeros(len(columns))
    inner = gram[np.ix_(varied, varied)] + alpha * np.eye(int(varied.sum()))
    # Without a penalty, features that follow from each other share the least weights.
    found = np.linalg.solve(inner, slope[varied]) if alpha > 0 else np.linalg.lstsq(inner, slope[varied])[0]
    weights[varied] = found / unit[varied]
    return LinearModel(tuple(columns), float(moments.mean[-1] - mean @ weights), weights, mean, np.where(varied, scale, 0.0))


def fit_ridge(df: DataFrame, columns: Sequence[str], label: str, alpha: float = 1.0, scaled: bool = True,
              step: Column | None = None, steps: Sequence[int] = (0,)) -> list[LinearModel]:
    """One model for every entry k of ``steps``, learned from rows whose ``step`` is at most k, all from one scan.

    Rows that lack a feature raise, also where only the largest entry would learn from them.
    """
    sums = step_moments(df, columns, label, F.lit(0) if step is None else step)
    gaps = sum(g for own, (_, g) in sums.items() if own <= max(steps))
    if gaps:
        raise ValueError(f"{gaps} training rows lack a feature")
    found = []
    for k in steps:
        used = [m for own, (m, _) in sums.items() if own <= k and m.n]
        if not used:
            raise ValueError(f"No rows to learn from up to step {k}")
        found.append(solve(reduce(Moments.__add__, used), columns, alpha, scaled))
    return found
