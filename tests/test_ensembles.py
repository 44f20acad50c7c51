"""Histogram trees against plain loops over rows and bins."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfcast.functions.workspace import new_folder
from shelfcast.operators import ensembles as E

SMALL = E.Growth(depth=3, leaves=5, rows=4, l2=1.0, bins=6)


def rows_of(n: int, seed: int = 0, step: int = 0):
    random = np.random.default_rng(seed)
    x = np.round(random.standard_normal((n, 3)) * 4)
    y = np.round(x[:, 0] * 2 + np.abs(x[:, 1]) + random.standard_normal(n), 3)
    gaps = random.random(n) < 0.2
    return [(float("nan") if g else float(a), None if g and k % 2 else float(b), float(c), float(t), int(step or k * 3 // n + 1))
            for k, (a, b, c, t, g) in enumerate(zip(*x.T, y, gaps, strict=True))]


SCHEMA = "a double, b double, c double, y double, step int"


def plain_tree(bins, target, weight, growth):
    """Best-first growth, one node after the other, each by trying every split of every feature."""
    def score(g, n):
        return g * g / (n + growth.l2) if n + growth.l2 else 0.0

    def search(rows):
        best = (0.0, None)
        g, n = (target[rows] * weight[rows]).sum(), weight[rows].sum()
        for f in range(bins.shape[0]):
            for side in (False, True):
                for s in range(growth.bins):
                    b = bins[f][rows]
                    left = rows[np.where(b == E.MISSING, side, b <= s)]
                    nl = weight[left].sum()
                    if nl < growth.rows or n - nl < growth.rows:
                        continue
                    gl = (target[left] * weight[left]).sum()
                    gain = score(gl, nl) + score(g - gl, n - nl) - score(g, n)
                    if gain > best[0] + 1e-9:
                        best = (gain, left)
        return best

    leaves = [(np.arange(bins.shape[1]), 0)]
    found = [(*search(leaves[0][0]), 0, leaves[0])]
    while found and (growth.leaves is None or len(leaves) < growth.leaves):
        gain, left, depth, (rows, _) = max(found, key=lambda k: k[0])
        found = [k for k in found if k[3][0] is not rows]
        if gain <= 1e-9:
            break
        parts = [(left, depth + 1), (np.setdiff1d(rows, left), depth + 1)]
        leaves = [k for k in leaves if k[0] is not rows] + parts
        found += [(*search(p[0]), depth + 1, p) for p in parts if depth + 1 < growth.depth]
    value = np.zeros(bins.shape[1])
    for rows, _ in leaves:
        value[rows] = (target[rows] * weight[rows]).sum() / max(weight[rows].sum() + growth.l2, 1e-300)
    return value


def matrix(rows):
    return np.array([[np.nan if v is None else v for v in r[:3]] for r in rows], float)


def test_boosting_equals_plain_rounds(spark):
    rows = rows_of(160)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    model = E.fit_boosting(df, "abc", "y", rounds=3, rate=0.5, growth=SMALL, stopping=False)[0]
    x, y = matrix(rows), np.array([r[3] for r in rows])
    bins = E._cut(x, E.bin_edges(df, "abc", SMALL.bins))
    predicted = np.full(len(y), y.mean())
    for _ in range(3):
        predicted = predicted + 0.5 * plain_tree(bins, y - predicted, np.ones(len(y)), SMALL)
    assert np.allclose(model.predict(x), predicted)
    assert model.base == pytest.approx(y.mean()) and sum(model.importances().values()) == pytest.approx(1)


def test_forest_equals_plain_trees(spark):
    rows = rows_of(120, 1)
    df = spark.createDataFrame(rows, SCHEMA).repartition(2)
    growth = E.Growth(depth=3, leaves=None, rows=3, l2=0.0, bins=6)
    model = E.fit_forest(df, "abc", "y", trees=5, growth=growth, together=2)
    hashes = df.select("a", "b", "c", "y", F.xxhash64("a", "b", "c", "y").alias("h")).collect()
    again = [tuple(r) for r in hashes]
    x, y = matrix(again), np.array([r[3] for r in again])
    h = np.array([r[4] for r in again], dtype=np.int64)
    bins = E._cut(x, E.bin_edges(df, "abc", growth.bins))
    expected = np.mean([plain_tree(bins, y, E._poisson(h, k), growth) for k in range(5)], axis=0)
    assert np.allclose(model.predict(x), expected)
    draws = np.concatenate([E._poisson(np.arange(20_000), k) for k in range(3)])
    assert draws.mean() == pytest.approx(1, abs=0.02) and (draws == 0).mean() == pytest.approx(np.exp(-1), abs=0.02)


def test_folds_in_one_pass_equal_separate_fits(spark):
    rows = rows_of(240, 2)
    df = spark.createDataFrame(rows, SCHEMA)
    edges = E.bin_edges(df, "abc", SMALL.bins)
    original, E.bin_edges = E.bin_edges, lambda *_: edges
    try:
        together = E.fit_boosting(df, "abc", "y", F.col("step"), (1, 2, 3), 5, 0.3, SMALL, stopping=False)
        alone = [E.fit_boosting(df.where(F.col("step") <= k), "abc", "y", rounds=5, rate=0.3, growth=SMALL, stopping=False)[0] for k in (1, 2, 3)]
    finally:
        E.bin_edges = original
    x = matrix(rows)
    for a, b in zip(together, alone, strict=True):
        assert np.allclose(a.predict(x), b.predict(x))
    assert not np.allclose(together[0].predict(x), together[2].predict(x))


def test_shuffled_sums_give_the_same_trees(spark, monkeypatch):
    df = spark.createDataFrame(rows_of(200, 3), SCHEMA).repartition(4)
    first = E.fit_boosting(df, "abc", "y", rounds=2, growth=SMALL)[0]
    monkeypatch.setattr(E, "DIRECT_BYTES", 0)
    second = E.fit_boosting(df, "abc", "y", rounds=2, growth=SMALL)[0]
    assert np.array_equal(first.threshold, second.threshold) and np.allclose(first.value, second.value)


def fetched(df, monkeypatch):
    """Bytes of every table that reaches the driver from now on."""
    sizes, kind = [], type(df)
    original = kind.toArrow
    def counted(own):
        found = original(own)
        sizes.append(found.nbytes)
        return found
    monkeypatch.setattr(kind, "toArrow", counted)
    return sizes


@pytest.mark.parametrize("parts", [2, 6])
def test_the_driver_gets_splits_and_few_sums(spark, monkeypatch, parts):
    df = spark.createDataFrame(rows_of(600, 6), SCHEMA).repartition(parts)
    monkeypatch.setattr(E, "DIRECT_BYTES", 200_000)
    sizes = fetched(df, monkeypatch)
    # One split a node of 49 bytes: at most 63 a tree of boosting, 1,023 of a forest.
    E.fit_boosting(df, "abc", "y", F.col("step"), (1, 2, 3), rounds=4, stopping=False)
    assert len(sizes) > 4 and sum(sizes) < 200_000 + 4 * 3 * (63 + 1) * 60
    sizes.clear()
    E.fit_forest(df, "abc", "y", trees=4, together=2)
    assert len(sizes) > 4 and sum(sizes) < 200_000 + 4 * 1024 * 60


def test_fewer_tasks_and_groups_of_one_node_give_the_same_trees(spark, monkeypatch):
    df = spark.createDataFrame(rows_of(400, 7), SCHEMA).repartition(5)
    growth = E.Growth(depth=4, leaves=None, rows=3, l2=0.0, bins=16)

    def fits():
        return [*E.fit_boosting(df, "abc", "y", F.col("step"), (1, 3), rounds=2, growth=SMALL), E.fit_forest(df, "abc", "y", trees=3, growth=growth)]

    first = fits()
    monkeypatch.setattr(E, "DIRECT_BYTES", 0)
    monkeypatch.setattr(E, "GROUP_BYTES", 0)
    second = fits()
    monkeypatch.setattr(E, "_summed", lambda table: (table.coalesce(2), 2))
    third = fits()
    for one, other in (*zip(first, second, strict=True), *zip(first, third, strict=True)):
        assert np.array_equal(one.feature, other.feature) and np.array_equal(one.threshold, other.threshold)
        assert np.allclose(one.value, other.value)


def test_tasks_that_add_up_follow_the_cluster(spark, monkeypatch):
    monkeypatch.setattr(E, "SUM_TASKS", 2)
    most = 4 * spark.sparkContext.defaultParallelism
    table, tasks = E._summed(spark.range(0, 100, 1, most + 5))
    assert tasks == most and table.rdd.getNumPartitions() == most and table.count() == 100
    assert E._summed(spark.range(0, 9, 1, 3))[1] == 3


def test_stopping_ends_when_nothing_is_left_to_learn(spark):
    random = np.random.default_rng(5)
    rows = [(float(a), None, 1.0, float(a > 0), 1) for a in random.integers(-2, 3, 600)]
    model = E.fit_boosting(spark.createDataFrame(rows, SCHEMA), "abc", "y", rounds=60, rate=0.9, growth=SMALL, stopping=True)[0]
    assert 1 < len(model.roots) < 40
    assert np.abs(model.predict(matrix(rows)) - [r[3] for r in rows]).max() < 0.05


def test_scoring_equals_walking_and_survives_saving(spark):
    rows = rows_of(150, 4)
    df = spark.createDataFrame(rows, SCHEMA)
    model = E.fit_boosting(df, "abc", "y", rounds=4, growth=SMALL)[0]

    def walk(row):
        total = model.base
        for root in model.roots:
            node = root
            while model.left[node] != node:
                v = row[model.feature[node]]
                left = model.missing_left[node] if np.isnan(v) else v <= model.threshold[node]
                node = model.left[node] if left else model.right[node]
            total += model.value[node]
        return total

    x = matrix(rows)
    assert model.predict(x).tolist() == [walk(r) for r in x]
    scored = [r.prediction for r in model.transform(df.coalesce(1)).collect()]
    assert scored == model.predict(x).tolist()
    path = new_folder(spark, "ensemble")
    model.save(spark, path)
    loaded = E.Ensemble.load(spark, path)
    assert loaded.predict(x).tolist() == scored and loaded.columns == model.columns and loaded.kind == "boosting"


def test_odd_tables(spark):
    same = spark.createDataFrame([(1.0, None, 2.0, 5.0, 1)] * 30, SCHEMA)
    model = E.fit_boosting(same, "abc", "y", rounds=2, growth=SMALL)[0]
    assert model.predict(np.array([[9.0, np.nan, 1.0]])).tolist() == [5.0]
    with pytest.raises(ValueError, match="No rows"):
        E.fit_boosting(same.limit(0), "abc", "y", rounds=2)
    assert len(E.fit_forest(same, "abc", "y", trees=2).roots) == 2
