"""Histogram trees: boosting with early stopping and bagged forests, many members grown in one scan a level.

Features are cut once into byte bins and written as packed blocks. A level of all members is one Spark job:
tasks route their rows down the unfinished trees and add up gradients and counts by node and bin, a shuffle by
member and group of nodes merges the sums, and the reducers return one best split a node. The driver gets these splits; sums only
as far as all those of a fit fit into ``DIRECT_BYTES``. The number of tasks follows the cluster, not the rows, and so do the
sums. Predictions of earlier rounds are kept with the blocks in a
written table that is renewed every few rounds, so a lost executor costs only its running tasks.

A member is one model of a validation fold (it learns from rows whose step is not after its own) or one tree of a forest
(it counts rows by a Poisson draw from the row's hash and its own number). Rows are not copied for either.

A node's depth-first tree is grown to full depth and cut back to the best ``leaves`` leaves; since a node's
gain does not depend on the order, that equals growing best-first. Missing values take the side with more gain; without
any in training, the side with more rows.
"""

from __future__ import annotations

import heapq
import math
import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.functions.workspace import materialize, replace

# Functions of this module travel to the executors by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK_ROWS = 32_768
RENEW = 2
HELD_PART = 10
PATIENCE, TOLERANCE = 10, 1e-7
#: Rows from which a tenth is held out to stop early.
STOPPING_ROWS = 10_000
MISSING = 255
#: Sums of a whole fit that the driver merges itself at most, in equal parts by level.
DIRECT_BYTES = 16 << 20
#: Sums of all tasks that meet in one group at most, unless those of a single node are more.
GROUP_BYTES = 16 << 20
#: Tasks that add up a level at most, or four a core if those are more.
SUM_TASKS = 64
BLOCK_SCHEMA = "n int, bins binary, target binary, step binary, hash binary"
SPLIT_SCHEMA = (
    "member int, feature int, node int, gain double, split int, missing_left boolean, "
    "gl double, nl double, g double, n double"
)


@dataclass(frozen=True)
class Growth:
    """How trees grow; ``rows`` is the least count of a leaf, ``l2`` the penalty on leaf values."""

    depth: int = 6
    leaves: int | None = 31
    rows: int = 20
    l2: float = 1.0
    bins: int = 255


BOOSTED = Growth()
BAGGED = Growth(depth=10, leaves=None, rows=5, l2=0.0, bins=32)


@dataclass
class Tree:
    """Flat arrays; a leaf leads to itself."""

    feature: list[int] = field(default_factory=lambda: [0])
    split: list[int] = field(default_factory=lambda: [0])
    missing_left: list[bool] = field(default_factory=lambda: [False])
    left: list[int] = field(default_factory=lambda: [0])
    right: list[int] = field(default_factory=lambda: [0])
    gain: list[float] = field(default_factory=lambda: [0.0])
    g: list[float] = field(default_factory=lambda: [0.0])
    n: list[float] = field(default_factory=lambda: [0.0])

    def leaf(self, g: float, n: float) -> int:
        for name, value in (("feature", 0), ("split", 0), ("missing_left", False), ("gain", 0.0), ("g", g), ("n", n)):
            getattr(self, name).append(value)
        self.left.append(len(self.left))
        self.right.append(len(self.right))
        return len(self.left) - 1

    def divide(self, node: int, best) -> list[int]:
        self.feature[node], self.split[node] = best["feature"], best["split"]
        self.missing_left[node], self.gain[node] = best["missing_left"], best["gain"]
        self.left[node] = self.leaf(best["gl"], best["nl"])
        self.right[node] = self.leaf(best["g"] - best["gl"], best["n"] - best["nl"])
        return [self.left[node], self.right[node]]

    def best_first(self, leaves: int) -> Tree:
        """The tree that taking the best gain first reaches with so many leaves."""
        out = Tree(g=self.g[:1], n=self.n[:1])
        heap = [(-self.gain[0], 0, 0)] if self.left[0] != 0 else []
        count = 1
        while heap and count < leaves:
            _, old, new = heapq.heappop(heap)
            child, other = self.left[old], self.right[old]
            made = out.divide(new, {
                "feature": self.feature[old], "split": self.split[old], "missing_left": self.missing_left[old],
                "gain": self.gain[old], "gl": self.g[child], "nl": self.n[child], "g": self.g[old], "n": self.n[old]})
            count += 1
            for a, b in zip((child, other), made, strict=True):
                if self.left[a] != a:
                    heapq.heappush(heap, (-self.gain[a], a, b))
        return out

    def arrays(self) -> dict[str, np.ndarray]:
        return {
            "feature": np.array(self.feature), "split": np.array(self.split), "missing_left": np.array(self.missing_left),
            "left": np.array(self.left), "right": np.array(self.right),
        }

    def values(self, l2: float, rate: float) -> np.ndarray:
        g, n = np.array(self.g), np.array(self.n)
        return -rate * g / np.maximum(n + l2, 1e-300)


def route(tree: dict[str, np.ndarray], bins: np.ndarray, depth: int) -> np.ndarray:
    """The node that every column of ``bins`` ends in after ``depth`` steps."""
    n = bins.shape[1]
    flat, rows = bins.ravel(), np.arange(n)
    node = np.zeros(n, np.int64)
    for _ in range(min(depth, len(tree["left"]) - 1)):
        found = flat.take(tree["feature"].take(node) * n + rows)
        left = found <= tree["split"].take(node)
        gone = found == MISSING
        if gone.any():
            left = np.where(gone, tree["missing_left"].take(node), left)
        node = np.where(left, tree["left"].take(node), tree["right"].take(node))
    return node


# Packed blocks --------------------------------------------------------------------------------------


def bin_edges(df: DataFrame, columns: Sequence[str], bins: int = 255) -> list[np.ndarray]:
    """Upper bounds of the bins of every column, its least value and quantiles of all rows; the last bin has none."""
    shares = F.array(*[F.lit(k / (bins - 1)) for k in range(1, bins - 1)])
    values = [F.percentile_approx(F.nullif(F.col(c).cast("double"), F.lit(float("nan"))), shares, F.lit(10 * bins)).alias(f"e{k}")
              for k, c in enumerate(columns)]
    least = [F.min(F.nullif(F.col(c).cast("double"), F.lit(float("nan")))).alias(f"m{k}") for k, c in enumerate(columns)]
    row = df.agg(*values, *least).first()
    return [np.unique([row[f"m{k}"], *(row[f"e{k}"] or [])]) if row[f"m{k}"] is not None else np.zeros(0) for k in range(len(columns))]


def _cut(values: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    """Bins, one row a column; a value is in the bin of the first edge that it does not exceed."""
    out = np.empty((len(edges), len(values)), np.uint8)
    for k, edge in enumerate(edges):
        out[k] = np.searchsorted(edge, values[:, k])
        out[k][np.isnan(values[:, k])] = MISSING
    return out


def blocks(df: DataFrame, columns: Sequence[str], label: str, edges: list[np.ndarray], step: Column) -> DataFrame:
    """The table as packed blocks, written once: bins, target, step and a hash of every row."""
    named = [F.col(c).cast("double").alias(f"f{k}") for k, c in enumerate(columns)]
    hashed = F.xxhash64(*[F.col(c) for c in columns], F.col(label))
    source = df.where(F.col(label).isNotNull()).select(
        F.col(label).cast("double").alias("y"), step.cast("int").alias("s"), hashed.alias("h"), *named)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0

        def packed() -> pa.RecordBatch:
            table = pa.Table.from_batches(held)
            x = np.stack([c.to_numpy() for c in table.columns[3:]], axis=1).astype(float)
            y, s, h = (table.column(k).to_numpy() for k in range(3))
            data = [_cut(x, edges).tobytes(), y.astype("<f8").tobytes(), s.astype(np.int8).tobytes(), h.astype("<i8").tobytes()]
            return pa.RecordBatch.from_arrays([pa.array([len(y)], pa.int32()), *[pa.array([d], pa.binary()) for d in data]],
                                              ["n", "bins", "target", "step", "hash"])

        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK_ROWS):
                held.append(batch.slice(start, BLOCK_ROWS))
                size += held[-1].num_rows
                if size >= BLOCK_ROWS:
                    yield packed()
                    held, size = [], 0
        if size:
            yield packed()

    return materialize(source.mapInArrow(run, BLOCK_SCHEMA), "tree-blocks")


# One level of all members ---------------------------------------------------------------------------


@dataclass
class Member:
    """One model or tree in growth: what it learns from, its state and its unfinished tree."""

    number: int
    step: int
    bagged: bool = False
    stopping: bool = False
    base: float = 0.0
    done: list[tuple[dict[str, np.ndarray], np.ndarray]] = field(default_factory=list)
    tree: dict[str, np.ndarray] | None = None
    frontier: list[int] = field(default_factory=list)


def _poisson(h: np.ndarray, number: int) -> np.ndarray:
    """How often a tree counts each row: a Poisson draw of mean 1 from the row's hash."""
    x = h.view(np.uint64) + np.uint64((number + 1) * 0x9E3779B97F4A7C15 % 2**64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    draw = (x ^ (x >> np.uint64(31))) / 2.0**64
    steps = np.exp(-1) * np.cumsum(1 / np.cumprod(np.r_[1.0, np.arange(1, 16)]))
    return np.searchsorted(steps, draw, side="right").astype(float)


def _block(row: dict, features: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    bins = np.frombuffer(row["bins"], np.uint8).reshape(features, row["n"])
    return bins, np.frombuffer(row["target"], "<f8"), np.frombuffer(row["step"], np.int8), np.frombuffer(row["hash"], "<i8")


def _held(h: np.ndarray) -> np.ndarray:
    return h % HELD_PART == 0


def _predictions(member: Member, place: int, row: dict, bins: np.ndarray, depth: int) -> np.ndarray:
    """What the member predicts so far: the written state and the trees since."""
    n = row["n"]
    state = np.frombuffer(row["state"], "<f8").reshape(-1, n)[place] if row.get("state") is not None else np.full(n, member.base)
    for tree, values in member.done:
        state = state + values[route(tree, bins, depth)]
    return state


def _level(table: DataFrame, members: list[Member], growth: Growth, features: int, level: int, tasks: int, direct: int) -> list[dict]:
    """Rows of SPLIT_SCHEMA: the best split of every frontier node; at level 0, feature -1 has the
    member's root sums in g and n and its held-out squared errors and rows in gl and nl.

    Sums of all ``tasks`` that fit into ``direct`` bytes are merged on the driver, which saves a stage; beyond that
    they are shuffled by member and group of nodes. Both merge in the same way.
    """
    width = growth.bins + 1
    size = max(1, GROUP_BYTES // (tasks * 16 * width * features))
    shared = table.sparkSession.sparkContext.broadcast(members)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        counts: dict[int, np.ndarray] = {}
        for batch in batches:
            for row in batch.to_pylist():
                bins, y, step, h = _block(row, features)
                for place, m in enumerate(shared.value):
                    if not m.frontier:
                        continue
                    weight = _poisson(h, m.number) if m.bagged else (step <= m.step).astype(float)
                    predicted = 0.0 if m.bagged else _predictions(m, place, row, bins, growth.depth)
                    gap = predicted - y
                    if m.stopping:
                        out = weight * _held(h)
                        weight = weight - out
                    if level == 0:
                        lost = (np.sum(out * gap**2), np.sum(out)) if m.stopping else (0.0, 0.0)
                        counts[place] = counts.get(place, 0) + np.array([*lost, np.sum(weight * gap), np.sum(weight)])
                    node = route(m.tree, bins, level)
                    order = np.full(len(m.tree["left"]), -1)
                    order[m.frontier] = np.arange(len(m.frontier))
                    at = order[node]
                    used = np.flatnonzero((at >= 0) & (weight > 0))
                    at, w = at[used] * width, weight[used]
                    wg = w * gap[used]
                    cells = len(m.frontier) * width
                    if place not in sums:
                        sums[place] = np.zeros((features, 2, cells))
                    own = sums[place]
                    for k in range(features):
                        found = bins[k][used].astype(np.int64)
                        found[found == MISSING] = growth.bins
                        found += at
                        own[k, 0] += np.bincount(found, wg, cells)
                        own[k, 1] += np.bincount(found, w, cells)
        for place, own in sums.items():
            keys = list(range(0, own.shape[2] // width, size))
            data = [own[:, :, k * width:(k + size) * width].tobytes() for k in keys]
            if level == 0:
                keys.append(-1)
                data.append(counts[place].tobytes())
            yield pa.RecordBatch.from_arrays(
                [*[pa.array([k] * len(keys), pa.int32()) for k in (TaskContext.get().partitionId(), place)],
                 pa.array(keys, pa.int32()), pa.array(data, pa.binary())], ["part", "member", "start", "data"])

    frontiers = [m.frontier for m in members]

    def best(member: int, start: int, total: np.ndarray) -> pa.Table:
        if start < 0:
            return _split_table(member, *[np.array([v]) for v in (-1, -1, 0.0, 0, False, *total)])
        g, n = np.moveaxis(total.reshape(features, 2, -1, width), 1, 0)
        splits = [np.stack(found) for found in zip(*[_best_splits(g[k], n[k], growth) for k in range(features)], strict=True)]
        # The first of the features with the most gain.
        feature, place = splits[0].argmax(0), np.arange(g.shape[1])
        splits = [s[feature, place] for s in splits]
        kept = splits[0] > 0
        return _split_table(member, feature[kept], np.array(frontiers[member])[start + place[kept]], *[s[kept] for s in splits])

    def merge(key, found):
        # In the order of the partitions, so that a fit repeats to the last bit.
        return best(*[k.as_py() for k in key], sum(np.frombuffer(d.as_py(), "<f8") for d in found.sort_by("part").column("data")))

    partial = table.mapInArrow(add, "part int, member int, start int, data binary")
    if tasks * 16 * width * features * sum(map(len, frontiers)) <= direct:
        totals: dict[tuple[int, int], np.ndarray] = {}
        for row in sorted(partial.toArrow().to_pylist(), key=lambda r: r["part"]):
            key = (row["member"], row["start"])
            totals[key] = totals.get(key, 0) + np.frombuffer(row["data"], "<f8")
        found = [r for key, total in totals.items() for r in best(*key, total).to_pylist()]
    else:
        found = partial.groupBy("member", "start").applyInArrow(merge, SPLIT_SCHEMA).toArrow().to_pylist()
    shared.destroy()
    return found


def _split_table(member: int, feature, node, gain, split, missing_left, gl, nl, g, n) -> pa.Table:
    return pa.table({
        "member": pa.array([member] * len(node), pa.int32()), "feature": pa.array(feature, pa.int32()),
        "node": pa.array(node, pa.int32()), "gain": pa.array(gain, pa.float64()), "split": pa.array(split, pa.int32()),
        "missing_left": pa.array(missing_left, pa.bool_()), "gl": pa.array(gl, pa.float64()), "nl": pa.array(nl, pa.float64()),
        "g": pa.array(g, pa.float64()), "n": pa.array(n, pa.float64())})


def _best_splits(g: np.ndarray, n: np.ndarray, growth: Growth) -> list[np.ndarray]:
    """gain, split, missing_left, gl, nl, g and n of the best split of every node (row); the last bin is for missing values."""
    all_g, all_n = g.sum(1), n.sum(1)
    gl, nl = np.cumsum(g[:, :-1], axis=1), np.cumsum(n[:, :-1], axis=1)
    gl = np.stack([gl, gl + g[:, -1:]])
    nl = np.stack([nl, nl + n[:, -1:]])
    gr, nr = all_g[:, None] - gl, all_n[:, None] - nl

    def score(a, b):
        return a * a / np.maximum(b + growth.l2, 1e-300)

    gain = score(gl, nl) + score(gr, nr) - score(all_g, all_n)[:, None]
    gain[(nl < growth.rows) | (nr < growth.rows)] = 0.0
    flat = np.moveaxis(gain, 1, 0).reshape(len(g), -1)
    # Rounding must not turn a node of equal targets into a split.
    top = flat.argmax(1)
    side, split = np.divmod(top, gain.shape[2])
    rows = np.arange(len(g))
    value = flat[rows, top]
    value = np.where(value > 1e-12 * np.abs(score(all_g, all_n)) , value, 0.0)
    left_g, left_n = gl[side, rows, split], nl[side, rows, split]
    without = n[:, -1] == 0
    missing_left = np.where(without, left_n > all_n - left_n, side == 1)
    return [value, split, missing_left, left_g, left_n, all_g, all_n]


def _summed(table: DataFrame) -> tuple[DataFrame, int]:
    """The blocks in as many tasks as add up a level, and their number."""
    tasks = table.rdd.getNumPartitions()
    most = max(SUM_TASKS, 4 * table.sparkSession.sparkContext.defaultParallelism)
    return (table.coalesce(most), most) if tasks > most else (table, tasks)


def grow(table: DataFrame, members: list[Member], growth: Growth, features: int, direct: int, on_root=None) -> list[Tree]:
    """One tree a member, all members level by level. ``on_root`` sees the sums of the first level and may end members.

    The driver merges at most ``direct`` bytes of sums a level.
    """
    table, tasks = _summed(table)
    trees = [Tree() for _ in members]
    for m, tree in zip(members, trees, strict=True):
        m.tree, m.frontier = tree.arrays(), [0]
    for level in range(growth.depth):
        found = _level(table, members, growth, features, level, tasks, direct)
        best: dict[tuple[int, int], dict] = {}
        for row in found:
            if row["feature"] < 0:
                trees[row["member"]].g[0], trees[row["member"]].n[0] = row["g"], row["n"]
                if on_root:
                    on_root(row["member"], row["gl"], row["nl"])
            else:
                best[row["member"], row["node"]] = row
        open_ = False
        for place, (m, tree) in enumerate(zip(members, trees, strict=True)):
            made = []
            for node in m.frontier:
                if (place, node) in best:
                    made += tree.divide(node, best[place, node])
            least = max(2 * growth.rows, 2)
            m.frontier = [k for k in made if tree.n[k] >= least]
            m.tree = tree.arrays()
            open_ |= bool(m.frontier)
        if not open_:
            break
    return [t.best_first(growth.leaves) if growth.leaves else t for t in trees]


# Models ---------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Ensemble:
    """Trees as flat arrays, all in one: a node's children are places, a leaf leads to itself."""

    kind: str
    columns: tuple[str, ...]
    base: float
    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    missing_left: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    gain: np.ndarray
    depth: int

    def tree_values(self, x: np.ndarray, tree: int) -> np.ndarray:
        """The values of one tree for rows of features."""
        node = np.full(len(x), self.roots[tree])
        rows = np.arange(len(x))
        for _ in range(self.depth):
            found = x[rows, self.feature[node]]
            left = np.where(np.isnan(found), self.missing_left[node], found <= self.threshold[node])
            node = np.where(left, self.left[node], self.right[node])
        return self.value[node]

    def predict(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        for tree in range(len(self.roots)):
            total += self.tree_values(x, tree)
        return total

    def transform(self, df: DataFrame) -> DataFrame:
        """Add ``prediction``; rows are scored in Arrow batches, a missing value takes its learned side."""
        shared = df.sparkSession.sparkContext.broadcast(self)

        @F.pandas_udf("double")
        def score(*columns: pd.Series) -> pd.Series:
            own = shared.value
            x = np.column_stack([c.to_numpy(float) for c in columns])
            return pd.Series(own.predict(x))

        return df.withColumn("prediction", score(*[F.col(c).cast("double") for c in self.columns]))

    def importances(self) -> dict[str, float]:
        """Share of every feature in the gain of all splits."""
        total = np.bincount(self.feature, self.gain, len(self.columns))
        return dict(zip(self.columns, (total / (total.sum() or 1.0)).tolist(), strict=True))

    def save(self, spark: SparkSession, path: str) -> None:
        """As a table of nodes, and one row with node -1 for what all trees share."""
        tree = np.searchsorted(self.roots, np.arange(len(self.feature)), side="right") - 1
        rows = pa.table({
            "node": pa.array(np.arange(-1, len(self.feature))), "tree": pa.array(np.r_[-1, tree]),
            "feature": pa.array(np.r_[-1, self.feature]), "threshold": pa.array(np.r_[self.base, self.threshold]),
            "missing_left": pa.array(np.r_[False, self.missing_left]), "left": pa.array(np.r_[self.depth, self.left]),
            "right": pa.array(np.r_[-1, self.right]), "value": pa.array(np.r_[0.0, self.value]), "gain": pa.array(np.r_[0.0, self.gain])})
        shared = F.lit("\n".join([self.kind, *self.columns]))
        spark.createDataFrame(rows).withColumn("columns", F.when(F.col("node") < 0, shared)).coalesce(1).write.mode("overwrite").parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> Ensemble:
        table = spark.read.parquet(path).orderBy("node").toArrow()
        column = {c: table.column(c).to_numpy() for c in table.column_names if c != "columns"}
        kind, *columns = table.column("columns")[0].as_py().split("\n")
        tree = column["tree"][1:]
        roots = np.flatnonzero(np.r_[True, tree[1:] != tree[:-1]]) if len(tree) else np.zeros(0, int)
        arrays = {c: column[c][1:] for c in ("feature", "threshold", "missing_left", "left", "right", "value", "gain")}
        return Ensemble(kind, tuple(columns), float(column["threshold"][0]), roots, depth=int(column["left"][0]), **arrays)


def compiled(kind: str, columns: Sequence[str], base: float, trees: list[tuple[Tree, np.ndarray]], edges: list[np.ndarray], depth: int) -> Ensemble:
    """The trees, with the bounds of bins as thresholds; beyond the last bound everything goes left."""
    parts: dict[str, list] = {c: [] for c in ("feature", "threshold", "missing_left", "left", "right", "value", "gain")}
    roots, at = [], 0
    for tree, values in trees:
        roots.append(at)
        parts["feature"] += tree.feature
        parts["threshold"] += [edges[f][s] if s < len(edges[f]) else np.inf for f, s in zip(tree.feature, tree.split, strict=True)]
        parts["missing_left"] += tree.missing_left
        parts["left"] += [at + k for k in tree.left]
        parts["right"] += [at + k for k in tree.right]
        parts["value"] += values.tolist()
        parts["gain"] += tree.gain
        at += len(tree.left)
    kinds = {"feature": int, "missing_left": bool, "left": int, "right": int}
    return Ensemble(kind, tuple(columns), base, np.array(roots, int), depth=depth,
                    **{c: np.array(v, kinds.get(c, float)) for c, v in parts.items()})


def fit_boosting(df: DataFrame, columns: Sequence[str], label: str, step: Column | None = None, steps: Sequence[int] = (0,),
                 rounds: int = 400, rate: float = 0.05, growth: Growth = BOOSTED, stopping: bool | None = None) -> list[Ensemble]:
    """One boosted model for every entry k of ``steps``, learned from rows whose ``step`` is at most k, all in the same scans.

    With more than ``STOPPING_ROWS`` rows a member holds out a tenth, drawn by the row's hash, and ends when ten rounds
    have not lowered the held-out loss.
    """
    edges = bin_edges(df, columns, growth.bins)
    table = blocks(df, columns, label, edges, F.lit(0) if step is None else step)
    sums = _target_sums(table)
    members = []
    for k in steps:
        rows = sum(n for (s, _), (n, _) in sums.items() if s <= k)
        early = rows > STOPPING_ROWS if stopping is None else stopping
        used = [v for (s, held), v in sums.items() if s <= k and not (early and held)]
        n, total = sum(u[0] for u in used), sum(u[1] for u in used)
        if not n:
            raise ValueError(f"No rows to learn from up to step {k}")
        members.append(Member(len(members), k, stopping=early, base=total / n))
    direct = DIRECT_BYTES // max(1, rounds * growth.depth)
    trees: list[list[tuple[Tree, np.ndarray]]] = [[] for _ in members]
    losses: list[list[float]] = [[] for _ in members]
    live, state = list(members), table
    for done in range(rounds):
        ended: set[int] = set()

        def on_root(place: int, lost: float, n: float) -> None:
            number = live[place].number
            losses[number].append(lost / n if n else 0.0)
            past = losses[number]
            if live[place].stopping and len(past) > PATIENCE and min(past[-PATIENCE:]) > past[-PATIENCE - 1] - TOLERANCE:
                ended.add(number)

        grown = grow(state, live, growth, len(columns), direct, on_root)
        for m, tree in zip(live, grown, strict=True):
            if m.number not in ended:
                values = tree.values(growth.l2, rate)
                trees[m.number].append((tree, values))
                m.done.append((tree.arrays(), values))
        staying = [k for k, m in enumerate(live) if m.number not in ended]
        if not staying:
            break
        if done + 1 < rounds and (len(staying) < len(live) or (done + 1) % RENEW == 0):
            state = _renewed(state, table, live, staying, growth.depth, len(columns))
            live = [live[k] for k in staying]
    return [compiled("boosting", columns, m.base, t, edges, growth.depth) for m, t in zip(members, trees, strict=True)]


def _target_sums(table: DataFrame) -> dict[tuple[int, bool], tuple[int, float]]:
    """Rows and sum of targets by step and whether held out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                y, step, h = np.frombuffer(row["target"], "<f8"), np.frombuffer(row["step"], np.int8), np.frombuffer(row["hash"], "<i8")
                frame = pd.DataFrame({"step": step.astype(np.int32), "held": _held(h), "y": y})
                found = frame.groupby(["step", "held"])["y"].agg(["count", "sum"]).reset_index()
                yield pa.RecordBatch.from_pandas(found, preserve_index=False)

    rows = table.select("target", "step", "hash").mapInArrow(run, "step int, held boolean, count long, sum double").groupBy("step", "held").agg(
        F.sum("count").alias("n"), F.sum("sum").alias("total")).collect()
    return {(r["step"], r["held"]): (r["n"], r["total"]) for r in rows}


def _renewed(state: DataFrame, table: DataFrame, live: list[Member], staying: list[int], depth: int, features: int) -> DataFrame:
    """The blocks with the predictions so far of the members that stay, written; their trees are in it from now on."""
    shared = table.sparkSession.sparkContext.broadcast(live)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                bins = _block(row, features)[0]
                found = [_predictions(shared.value[k], k, row, bins, depth) for k in staying]
                row["state"] = np.stack(found).astype("<f8").tobytes()
                yield pa.RecordBatch.from_pylist([row], pa.schema([
                    ("n", pa.int32()), *[(c, pa.binary()) for c in ("bins", "target", "step", "hash", "state")]]))

    made = state.mapInArrow(run, f"{BLOCK_SCHEMA}, state binary")
    written = materialize(made, "tree-state") if state is table else replace(state, made, "tree-state")
    shared.destroy()
    for k in staying:
        live[k].done.clear()
    return written


def fit_forest(df: DataFrame, columns: Sequence[str], label: str, trees: int = 300, growth: Growth = BAGGED, together: int = 16) -> Ensemble:
    """A forest of ``trees`` trees, ``together`` of them grown in the same scans."""
    edges = bin_edges(df, columns, growth.bins)
    table = blocks(df, columns, label, edges, F.lit(0))
    direct = DIRECT_BYTES // max(1, math.ceil(trees / together) * growth.depth)
    found: list[tuple[Tree, np.ndarray]] = []
    for start in range(0, trees, together):
        members = [Member(k, 0, bagged=True) for k in range(start, min(trees, start + together))]
        found += [(t, t.values(growth.l2, 1 / trees)) for t in grow(table, members, growth, len(columns), direct)]
    return compiled("forest", columns, 0.0, found, edges, growth.depth)
