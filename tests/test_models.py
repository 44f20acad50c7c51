from __future__ import annotations

import datetime as dt
import importlib.util
import inspect

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from shelfcast.functions.metrics import mae
from shelfcast.functions.workspace import materialize, new_folder
from shelfcast.operators import benchmark, models, panel, splits
from shelfcast.plans import inputs
from shelfcast.streaming import scoring

START = dt.date(2024, 1, 1)


@pytest.fixture(scope="module")
def seasonal(spark):
    """Two products with a weekly pattern, a trend and a promotion effect, for 420 days."""
    day = F.datediff("date", F.lit(START))
    promotion = F.when((day * 7) % 11 < 2, 1).otherwise(0)
    noise = F.pmod(F.xxhash64("product_id", "date"), F.lit(5))
    quantity = (
        20 + 10 * F.sin(2 * 3.141592653589793 * day / 7) + day / 40 + 15 * promotion + noise
    )
    sales = (
        spark.range(840)
        .select(
            F.concat(F.lit("P"), F.col("id") % 2).alias("product_id"),
            F.lit("C").alias("category"),
            F.date_add(F.lit(START), (F.col("id") / 2).cast("int")).alias("date"),
        )
        .withColumns(
            {
                "quantity": F.round(quantity).cast("bigint"),
                "price": F.lit(10.0) + F.col("product_id").substr(2, 1).cast("int"),
                "promotion": promotion,
                "discount": promotion * 0.1,
                "holiday": F.lit(0),
            }
        )
    )
    return materialize(panel.model_features(sales), "seasonal")


def test_naive_takes_the_value_of_a_week_before(spark):
    rows = [("P1", START + dt.timedelta(days=i), 10.0 + i) for i in range(14)]
    rows += [("P2", START + dt.timedelta(days=i), 100.0 + i) for i in range(8)]
    df = spark.createDataFrame(rows, "product_id string, date date, quantity double")
    found = {
        (r.product_id, (r.date - START).days): r.prediction
        for r in models.seasonal_naive(df).collect()
    }
    assert found["P1", 7] == 10 and found["P1", 13] == 16
    assert found["P1", 6] is None and found["P2", 6] is None
    assert found["P2", 7] == 100


def test_ridge_matches_the_closed_form(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(40, 2)) * [3.0, 0.5] + [1.0, 4.0]
    y = x @ [2.0, -5.0] + 3 + rng.normal(size=40)
    train = spark.createDataFrame([(*map(float, r), float(t)) for r, t in zip(x, y)], "a double, b double, y double")
    alpha = 10.0
    model = models.ridge_fitter(alpha, ["a", "b"], "y")(train)
    z = (x - x.mean(0)) / x.std(0)
    weights = np.linalg.solve(z.T @ z + alpha * np.eye(2), z.T @ (y - y.mean()))
    predicted = [r.prediction for r in model.transform(train).orderBy("a").collect()]
    assert np.allclose(predicted, (z @ weights + y.mean())[np.argsort(x[:, 0])], rtol=1e-6)
    plain = models.ridge_fitter(alpha, ["a", "b"], "y", scaled=False)(train)
    centred = x - x.mean(0)
    raw = np.linalg.solve(centred.T @ centred + alpha * np.eye(2), centred.T @ (y - y.mean()))
    assert np.allclose(plain.weights, raw, rtol=1e-6)


def test_models_beat_the_naive_one_and_never_go_below_zero(seasonal):
    fitters = models.build_models(trees=15, rounds=40)
    predictions = models.holdout_predictions(seasonal, fitters)
    found = {r.model: r.mae for r in models.compare_models(predictions).collect()}
    assert set(found) == {models.NAIVE, models.RIDGE, models.FOREST, models.BOOSTING}
    assert all(found[name] < found[models.NAIVE] for name in fitters)
    assert predictions.where("prediction < 0 OR prediction IS NULL").count() == 0
    wide = models.predictions_side_by_side(predictions, list(found))
    assert wide.count() == 120 and wide.where("pred_random_forest IS NULL").count() == 0


def test_boosting_is_deterministic_and_survives_saving(spark, seasonal):
    path = new_folder(spark, "test-model")
    model = models.train_production(seasonal, path, rounds=5)
    again = models.train_production(seasonal, rounds=5)
    loaded = models.load_model(spark, path)

    def scores(m):
        ordered = models.predict_demand(seasonal, m).orderBy("product_id", "date")
        return [r.prediction for r in ordered.collect()]

    assert scores(model) == scores(again) == scores(loaded)
    info = models.model_info(spark, loaded).first()
    assert info.feature_count == 18 and info.features == panel.FEATURE_COLUMNS
    with pytest.raises(FileNotFoundError):
        models.load_model(spark, path + "-none")
    with pytest.raises(ValueError, match="lag_7"):
        models.predict_demand(seasonal.drop("lag_7"), model)


def test_cross_validation_rows_and_summary(spark, seasonal):
    development, holdout = splits.holdout_frames(seasonal, 30)
    predictions = materialize(
        models.cross_validate(development, {models.RIDGE: models.ridge_fitter()}, 3, 30), "cv"
    )
    assert predictions.count() == 2 * 2 * 3 * 30
    last = predictions.agg(F.max("date")).first()[0]
    assert last < holdout.agg(F.min("date")).first()[0]
    oof = models.oof_predictions(predictions, models.RIDGE)
    assert oof.where(F.abs(F.col("error") - (F.col("quantity") - F.col("prediction"))) > 0).count() == 0
    summary = models.cv_summary(models.cv_results(predictions))
    assert models.best_model(summary).first().model == models.RIDGE


def test_cv_summary_of_published_fold_results(spark):
    # Published metrics of two models over four folds, and their published summary.
    rows = [
        (1, "Seasonal Naive", 15.565, 24.482, 29.6), (2, "Seasonal Naive", 20.823, 32.55, 32.06),
        (3, "Seasonal Naive", 23.515, 37.513, 28.54), (4, "Seasonal Naive", 24.053, 35.231, 27.87),
        (1, "Gradient Boosting", 10.512, 16.267, 21.44), (2, "Gradient Boosting", 13.245, 20.44, 20.93),
        (3, "Gradient Boosting", 15.489, 23.477, 19.37), (4, "Gradient Boosting", 16.796, 24.164, 19.64),
    ]
    df = spark.createDataFrame(rows, "fold int, model string, mae double, rmse double, smape_pct double")
    best, naive = models.cv_summary(df).collect()
    assert best.model == "Gradient Boosting" and naive.model == "Seasonal Naive"
    assert best.mae_mean == pytest.approx(14.0105) and best.mae_std == pytest.approx(2.7550233653934004)
    assert naive.rmse_mean == pytest.approx(32.444) and naive.smape_pct_std == pytest.approx(1.8385567522499614)


def test_final_test_signs(seasonal):
    fitter = models.boosting_fitter(3)
    plain = models.final_test(seasonal, fitter).agg(F.sum("error")).first()[0]
    turned = models.final_test(seasonal, fitter, signed="prediction_minus_actual")
    assert turned.agg(F.sum("error")).first()[0] == pytest.approx(-plain)
    metrics = models.final_test_metrics(turned).first()
    assert metrics.test_rows == 120 and (metrics.test_end - metrics.test_start).days == 59


def test_permutation_importance_finds_the_used_feature(seasonal):
    _, holdout = splits.holdout_frames(seasonal)
    development, _ = splits.holdout_frames(seasonal)
    model = models.ridge_fitter()(development)
    ranked = models.permutation_importance(holdout, model, repeats=2, groups=2).collect()
    assert len(ranked) == 18
    weights = {r.feature: r.importance for r in ranked}
    assert weights["promotion"] > 0.5
    assert abs(weights["holiday"]) < 1e-9  # constant, so shuffling changes nothing


def test_shuffled_values_are_a_permutation(spark, seasonal):
    """With a model that returns the feature itself, the shuffled mean must not move."""
    _, holdout = splits.holdout_frames(seasonal)
    model = models.ridge_fitter()(seasonal)
    base = models.predict_demand(holdout, model).agg(mae("quantity", "prediction")).first()[0]
    found = models.permutation_importance(holdout, model, repeats=1, groups=1)
    assert base >= 0 and found.where("importance IS NULL").count() == 0


def request(**changes):
    row = {name: 1.0 for name in panel.FEATURE_COLUMNS}
    row |= {"day_of_week": 2, "month": 6, "week_of_year": 25, "is_weekend": 0}
    return {"request_id": "r", "product_id": "P1", "category": "C", **row, **changes}


@pytest.mark.parametrize(
    ("changes", "failed"),
    [
        ({}, []),
        ({"promotion": 2.0}, ["promotion above 1"]),
        ({"month": 13}, ["month above 12"]),
        ({"lag_7": None}, ["lag_7 missing"]),
        ({"price": -1.0, "is_weekend": -1}, ["price below 0", "is_weekend below 0"]),
        ({"promotion": 0.5}, ["promotion not whole"]),
        ({"week_of_year": 54, "day_of_week": 7}, ["day_of_week above 6", "week_of_year above 53"]),
        ({"product_id": None}, ["product_id missing"]),
    ],
)
def test_request_rules(spark, changes, failed):
    df = spark.createDataFrame([request(**changes)], scoring.REQUEST_SCHEMA)
    checked = models.validate_requests(df)
    assert checked.first().failed_rules == failed
    assert models.accepted(checked).count() == (not failed)
    assert models.rejected(checked).count() == bool(failed)


def test_stream_scores_like_the_batch(spark, seasonal):
    model = models.train_production(seasonal, rounds=3)
    base = new_folder(spark, "test-stream")
    requests = seasonal.select(
        F.concat_ws("|", "product_id", "date").alias("request_id"),
        "product_id",
        "category",
        *[
            (F.when(F.dayofmonth("date") == 3, -1.0).otherwise(F.col(c)) if c == "price" else F.col(c))
            .cast(scoring.REQUEST_SCHEMA[c].dataType)
            .alias(c)
            for c in panel.FEATURE_COLUMNS
        ],
    )
    requests.repartition(3).write.parquet(f"{base}/in")
    for query in scoring.score_requests_stream(
        scoring.read_requests(spark, f"{base}/in", 1), model, f"{base}/ok", f"{base}/no", f"{base}/state"
    ):
        query.awaitTermination()
    batch = models.score_requests(requests, model)
    streamed = spark.read.parquet(f"{base}/ok")
    assert batch.count() == streamed.count() > 0
    assert batch.exceptAll(streamed.select(*batch.columns)).isEmpty()
    refused = spark.read.parquet(f"{base}/no")
    assert refused.count() == requests.where("price < 0").count()
    assert streamed.count() + refused.count() == requests.count()


def daily_series(spark, days=90, series=3):
    rows = []
    for s in range(series):
        for i in range(days):
            date = START + dt.timedelta(days=i)
            rows.append(
                (
                    f"S{s}", f"I{s % 2}", f"D{s % 2}", "C", f"T{s}", "CA", date, float((i * (s + 3)) % 13),
                    date.month, i % 7 + 1, int(i % 7 in (0, 6)), int(i % 10 == 0), 0, int(i % 4 == 0),
                )
            )
    names = [*benchmark.SERIES_COLUMNS, "date", "demand", *benchmark.CALENDAR_FEATURES]
    return benchmark.benchmark_features(
        spark.createDataFrame(rows, ", ".join(
            f"{n} {t}" for n, t in zip(names, ["string"] * 6 + ["date", "double"] + ["int"] * 6)
        ))
    )


def test_recursion_matches_a_plain_loop(spark):
    encoded = materialize(benchmark.encode_categories(daily_series(spark)), "test-encoded")
    end = START + dt.timedelta(days=89)
    fold = splits.Fold(1, end - dt.timedelta(days=10), end - dt.timedelta(days=9), end)
    train = benchmark.training_rows(encoded, fold.train_end)
    assembler = models._assembler(benchmark.FEATURES, "keep")
    model = Pipeline(stages=[assembler, LinearRegression(labelCol="demand", regParam=0.1)]).fit(train)
    found = {
        (r.id, r.date): r.prediction
        for r in benchmark.recursive_forecast(model, encoded, fold, cut_every=4).collect()
    }
    weights = model.stages[-1].coefficients.toArray()
    intercept = model.stages[-1].intercept
    table = encoded.orderBy("id", "date").collect()
    assert len(found) == 30
    for series in ("S0", "S1", "S2"):
        rows = [r for r in table if r.id == series]
        history = [r.demand for r in rows if r.date <= fold.train_end]
        for row in rows[-10:]:
            recent = {n: np.array(history[-n:]) for n in (7, 14, 28)}
            features = [
                *[history[-n] for n in (1, 7, 14, 28)],
                *[recent[n].mean() for n in (7, 14, 28)],
                *[recent[n].std(ddof=1) for n in (7, 28)],
                *[row[c] for c in benchmark.CALENDAR_FEATURES],
                *[row[c] for c in benchmark.CODES],
            ]
            expected = max(0.0, float(np.dot(weights, features) + intercept))
            assert found[series, row.date] == pytest.approx(expected, abs=1e-8)
            history.append(expected)


def test_naive_steps_repeat_the_last_week(spark):
    daily = daily_series(spark)
    end = START + dt.timedelta(days=89)
    fold = splits.Fold(1, end - dt.timedelta(days=10), end - dt.timedelta(days=9), end)
    demand = {(r.id, r.date): r.demand for r in daily.collect()}
    rows = benchmark.naive_multistep(daily, fold).collect()
    assert len(rows) == 30
    for r in rows:
        steps = (r.date - fold.train_end).days
        source = fold.train_end - dt.timedelta(days=6) + dt.timedelta(days=(steps - 1) % 7)
        assert r.prediction == demand[r.id, source]


def test_short_history_stops_the_forecast(spark):
    daily = daily_series(spark, days=30)
    end = START + dt.timedelta(days=29)
    fold = splits.Fold(1, end - dt.timedelta(days=5), end - dt.timedelta(days=4), end)
    with pytest.raises(Exception, match="Too little history"):
        benchmark.naive_multistep(daily, fold).collect()


def test_codes_follow_sorted_order_and_mark_missing(spark):
    rows = [("a", "x"), ("b", "z"), ("c", None), ("d", "y"), ("e", "x")]
    df = spark.createDataFrame(rows, "id string, item_id string")
    found = {r.id: r.item_code for r in benchmark.encode_categories(df, ["item_id"]).collect()}
    assert found == {"a": 0, "b": 2, "c": -1, "d": 1, "e": 0}


def test_a_missing_feature_does_not_fail_the_batch(spark, seasonal):
    gap = seasonal.withColumn("lag_7", F.when(F.col("date") != F.lit("2025-01-05").cast("date"), F.col("lag_7")))
    n = gap.where("lag_7 IS NULL").count()
    assert n
    boosted = models.predict_demand(gap, models.boosting_fitter(2)(seasonal))
    assert boosted.where("prediction IS NULL OR prediction < 0").count() == 0
    scored = models.predict_demand(gap, models.ridge_fitter()(seasonal))
    assert scored.where("prediction IS NULL").count() == n == scored.where("lag_7 IS NULL AND prediction IS NULL").count()
    with pytest.raises(ValueError, match="lack a feature"):
        models.ridge_fitter()(gap)


def test_importance_groups_follow_the_rows(spark, seasonal, monkeypatch):
    model = models.boosting_fitter(2)(seasonal)
    monkeypatch.setattr(models, "IMPORTANCE_ROWS", 100)
    found = models.permutation_importance(seasonal, model, repeats=1)
    values = {r.feature: r.importance for r in found.collect()}
    assert values["lag_7"] >= 0 and values["holiday"] == pytest.approx(0)


def test_library_defaults_are_the_sizes_of_the_models():
    default = lambda make, name: inspect.signature(make).parameters[name].default
    for make in (models.train_production, models.build_models, models.boosting_fitter, benchmark.benchmark_cv, benchmark.fit_windows):
        assert default(make, "rounds") == 400
    assert default(models.build_models, "trees") == 300
    assert default(models.boosting_fitter, "rate") == default(benchmark.fit_windows, "rate") == 0.05


def test_registered_cross_validation_fits_models_of_full_size(spark, seasonal, monkeypatch):
    # A module of its own: the other tests have fewer rounds and trees.
    spec = importlib.util.spec_from_file_location("whole_inputs", inputs.__file__)
    whole = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(whole)
    development, _ = splits.holdout_frames(seasonal)
    monkeypatch.setattr(whole, "development", lambda *_: development)
    sizes = []
    boosting, forest = models.fit_boosting, models.fit_forest

    def boosted(df, columns, label, step, steps, rounds, rate):
        sizes.append((rounds, rate, len(steps)))
        return boosting(df, columns, label, step, steps, 2, rate)

    def grown(df, columns, label, trees):
        sizes.append(trees)
        return forest(df, columns, label, 2)

    monkeypatch.setattr(models, "fit_boosting", boosted)
    monkeypatch.setattr(models, "fit_forest", grown)
    found = whole.cv_predictions(spark, "made").groupBy("model", "fold").count().collect()
    assert sizes == [(400, 0.05, 4), 300, 300, 300, 300]
    assert len(found) == 16 and {r["count"] for r in found} == {2 * 60}
