from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfcast.functions.workspace import new_folder
from shelfcast.operators import linear, models

COLUMNS = ["a", "b", "same"]


def sample(rows: int = 400) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rng = np.random.default_rng(5)
    x = np.column_stack([rng.normal(1e6, 3.0, rows), rng.normal(-2.0, 0.5, rows), np.full(rows, 0.1)])
    return x, x[:, 0] * 2 - x[:, 1] * 5 + rng.normal(size=rows), rng.integers(1, 5, rows)


def closed_form(x: np.ndarray, y: np.ndarray, alpha: float) -> np.ndarray:
    """Predictions for the training rows of a text-book ridge on standardised varied features."""
    z = (x[:, :2] - x[:, :2].mean(0)) / x[:, :2].std(0)
    return z @ np.linalg.solve(z.T @ z + alpha * np.eye(2), z.T @ (y - y.mean())) + y.mean()


@pytest.fixture(scope="module")
def table(spark):
    x, y, step = sample()
    rows = [(*map(float, r), float(t), int(s)) for r, t, s in zip(x, y, step, strict=True)]
    return spark.createDataFrame(rows, "a double, b double, same double, y double, step int").repartition(7)


def test_moments_merge_like_one_table():
    x, y, _ = sample()
    whole = linear.Moments.of(np.column_stack([x, y]))
    parts = [linear.Moments.of(p) for p in np.array_split(np.column_stack([x, y]), [0, 1, 90])]
    merged = sum(parts[1:], parts[0])
    assert merged.n == whole.n and np.allclose(merged.mean, whole.mean, rtol=1e-12)
    assert np.allclose(merged.products, whole.products, rtol=1e-9, atol=1e-9)


def test_one_scan_gives_the_models_of_all_folds(table):
    x, y, step = sample()
    found = models.ridge_fitter(10.0, COLUMNS, "y").fit_steps(table, F.col("step"), range(1, 5))
    for k, model in zip(range(1, 5), found, strict=True):
        used = step <= k
        alone = models.ridge_fitter(10.0, COLUMNS, "y")(table.where(F.col("step") <= k))
        assert np.allclose(model.weights, alone.weights, rtol=1e-9) and model.weights[2] == 0.0 == model.scale[2]
        assert np.allclose(x[used] @ model.weights + model.intercept, closed_form(x[used], y[used], 10.0), rtol=1e-9)


def test_prediction_is_a_column_expression(table):
    model = models.ridge_fitter(1.0, COLUMNS, "y")(table)
    scored = model.transform(table.withColumn("b", F.when(F.col("step") > 1, F.col("b"))))
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert scored.where("(prediction IS NULL) <> (step = 1)").count() == 0


def test_saved_weights_predict_the_same(spark, table):
    model = models.ridge_fitter(1.0, COLUMNS, "y")(table)
    loaded = models.load_model(spark, models.save_model(spark, model, new_folder(spark, "test-ridge")))
    assert loaded.columns == model.columns and loaded.intercept == model.intercept
    assert all(np.array_equal(getattr(loaded, c), getattr(model, c)) for c in ("weights", "mean", "scale"))
    info = models.model_info(spark, loaded).first()
    assert (info.model_type, info.feature_count) == ("ridge", 3)


def test_rows_without_a_label_or_a_feature(table):
    fitter = models.ridge_fitter(1.0, COLUMNS, "y")
    extra = table.limit(3).withColumn("y", F.lit(None).cast("double"))
    assert np.allclose(fitter(table.unionByName(extra)).weights, fitter(table).weights, rtol=1e-9)
    late = table.withColumn("a", F.when(F.col("step") < 4, F.col("a")))
    assert len(fitter.fit_steps(late, F.col("step"), [1, 2, 3])) == 3
    with pytest.raises(ValueError, match="lack a feature"):
        fitter.fit_steps(late, F.col("step"), [1, 4])
    with pytest.raises(ValueError, match="No rows"):
        fitter(table.where("step > 9"))


def test_without_a_penalty_equal_features_share_their_weight(table):
    twice = table.withColumn("c", F.col("b"))
    model = models.ridge_fitter(0.0, ["b", "c"], "y", scaled=False)(twice)
    assert np.isclose(*model.weights) and np.isfinite(model.intercept)
