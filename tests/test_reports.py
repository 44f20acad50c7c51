from __future__ import annotations

import datetime as dt

import numpy as np
import pytest

from shelfcast.functions import metrics
from shelfcast.operators import benchmark, errors, intervals, monitoring

DAY = dt.date(2025, 5, 2)


@pytest.fixture()
def predictions(spark):
    rows = [
        (DAY + dt.timedelta(days=i), p, c, float(q), float(f), float(i % 2), 0.0, int(i >= 5))
        for p, c, pairs in (
            ("P1", "A", [(10, 12), (0, 0), (7, 3), (4, 4), (9, 1), (3, 8)]),
            ("P2", "B", [(100, 90), (80, 85), (0, 5), (60, 60), (70, 100), (30, 20)]),
        )
        for i, (q, f) in enumerate(pairs)
    ]
    return spark.createDataFrame(
        rows, "date date, product_id string, category string, quantity double, prediction double, "
        "promotion double, holiday double, is_weekend int"
    )


def arrays(predictions):
    rows = predictions.collect()
    return np.array([r.quantity for r in rows]), np.array([r.prediction for r in rows])


def test_metrics(predictions):
    y, p = arrays(predictions)
    gap = np.abs(y - p)
    found = metrics.evaluate(predictions, rounded=False).first()
    assert found.mae == pytest.approx(gap.mean())
    assert found.rmse == pytest.approx(np.sqrt((gap**2).mean()))
    assert found.smape_pct == pytest.approx((2 * gap / (y + p + 1)).mean() * 100)
    other = metrics.evaluate_benchmark(predictions, actual="quantity").first()
    with np.errstate(invalid="ignore"):
        assert other.smape_pct == pytest.approx(np.nan_to_num(2 * gap / (y + p)).mean() * 100)
    assert other.wape_pct == pytest.approx(gap.sum() / y.sum() * 100)


def test_wape_without_demand_is_null(spark):
    df = spark.createDataFrame([(0.0, 1.0)], "demand double, prediction double")
    row = metrics.evaluate_benchmark(df).first()
    assert row.wape_pct is None and row.smape_pct == 200.0


def test_error_tables(predictions):
    features = predictions.drop("prediction")
    frame = errors.error_frame(features, predictions)
    assert frame.count() == 12 and {"y_true", "y_pred", "error", "quantity"} <= set(frame.columns)
    y, p = arrays(predictions.where("product_id = 'P2'"))
    for table, key, value in (
        (errors.error_by_product(frame), "product_id", "P2"),
        (errors.error_by_category(frame), "category", "B"),
    ):
        row = {r[key]: r for r in table.collect()}[value]
        assert row.observations == 6 and row.bias == pytest.approx((y - p).mean())
        assert row.p90_absolute_error == pytest.approx(np.percentile(np.abs(y - p), 90))
        assert row.p95_absolute_error == pytest.approx(np.percentile(np.abs(y - p), 95))
    conditions = errors.error_by_condition(frame).collect()
    assert {(r.condition, r.condition_value) for r in conditions} == {
        ("promotion", "0.0"), ("promotion", "1.0"), ("holiday", "0.0"),
        ("is_weekend", "0"), ("is_weekend", "1"),
    }
    assert errors.error_by_condition(frame.drop("holiday")).count() == 4
    assert errors.error_by_condition(frame.drop(*errors.CONDITIONS)).isEmpty()
    with pytest.raises(ValueError, match="prediction"):
        errors.error_frame(features, predictions.drop("prediction"))


def test_drivers(predictions):
    found = {r.variable: r for r in errors.driver_correlations(predictions).collect()}
    assert set(found) == {"promotion", "holiday", "is_weekend"}
    assert found["holiday"].pearson_correlation_with_demand is None  # constant
    y, _ = arrays(predictions)
    flags = np.array([r.promotion for r in predictions.collect()])
    assert found["promotion"].pearson_correlation_with_demand == pytest.approx(np.corrcoef(y, flags)[0, 1])
    segments = {(r.segment, r.segment_value): r.total_units for r in errors.driver_segments(predictions).collect()}
    assert segments["category", "A"] == 33.0 and segments["holiday", "0.0"] == y.sum()


def test_slices(predictions):
    terciles = {r.demand_tercile for r in errors.metrics_by_tercile(predictions).collect()}
    assert terciles == {"low", "medium", "high"}
    assert errors.metrics_by_weekday(predictions).first().weekday == "Monday"
    names = {r.promotion for r in errors.metrics_by_promotion(predictions).collect()}
    assert names == {"no promotion", "promotion active"}


# Published validation RMSE per fold, and the published interval widths.
CV = [
    ("Seasonal Naive", 1.151258800355865), ("Gradient Boosting", 0.868232716246375),
    ("Seasonal Naive", 1.1801936887041646), ("Gradient Boosting", 0.9256496322598927),
    ("Seasonal Naive", 1.9008143618184383), ("Gradient Boosting", 0.9718197484848374),
    ("Seasonal Naive", 1.807995908830882), ("Gradient Boosting", 1.2540443211819075),
]


def test_published_interval_widths(spark):
    found = intervals.interval_width(spark.createDataFrame(CV, "model string, rmse double"))
    widths = {r.model: r.interval_width for r in found.collect()}
    assert widths == pytest.approx({"Seasonal Naive": 1.9008143618184383, "Gradient Boosting": 1.2540443211819077})


def test_intervals(spark):
    df = spark.createDataFrame(
        [("m", 0.0, 1.0), ("m", 5.0, 2.0), ("m", 4.0, 2.0)], "model string, demand double, prediction double"
    )
    widths = spark.createDataFrame([("m", 2.0)], "model string, interval_width double")
    rows = intervals.prediction_intervals(df, widths).collect()
    assert sorted((r.prediction_lower, r.prediction_upper, r.interval_covered) for r in rows) == [
        (0.0, 3.0, True), (0.0, 4.0, False), (0.0, 4.0, True)
    ]
    m = intervals.interval_metrics(intervals.prediction_intervals(df, widths)).first()
    assert m.coverage_pct == pytest.approx(200 / 3) and m.mean_interval_width == pytest.approx(11 / 3)
    with pytest.raises(ValueError):
        intervals.require_widths(df, widths.where("model = 'other'"))
    with pytest.raises(Exception, match="No interval width for model"):
        intervals.prediction_intervals(df, widths.where("model = 'other'")).collect()


def test_residual_quantile(spark):
    values = [1.0, -5.0, 2.0, float("nan"), float("inf"), None]
    df = spark.createDataFrame([(v,) for v in values], "error double")
    assert intervals.residual_quantile(df).first()[0] == pytest.approx(np.quantile([1, 5, 2], 0.9))
    with pytest.raises(ValueError):
        intervals.residual_quantile(df.where("error IS NULL"))


def test_monitoring(spark):
    rows = [("a", DAY, d, p, f) for d, p, f in [(1.0, 2.0, 0), (3.0, 2.0, 0), (9.0, None, 1), (-7.0, 4.0, 1)]]
    table = spark.createDataFrame(rows, "id string, date date, demand double, price double, is_final_test int")
    shift = {r.metric: r.standardized_mean_shift for r in monitoring.distribution_shift(table).collect()}
    assert shift["demand"] == pytest.approx(1 / 2**0.5) and shift["price"] == 0.0  # constant before
    onesided = monitoring.distribution_shift(table.where("is_final_test = 0")).collect()
    assert all(r.standardized_mean_shift is None for r in onesided)
    predictions = table.selectExpr("id", "date", "demand", "demand - 1 AS prediction", "'m' AS model")
    report = monitoring.monitoring_report(table, predictions).collect()
    assert len(report) == 5
    kinds = {(r.check_type, r.metric): r for r in report}
    assert kinds["data_quality", "demand"].negative_count == 1
    assert kinds["distribution_shift", "price"].missing_count == 1
    assert kinds["model_performance", "m"].mae == 1.0
    assert kinds["data_quality", "price"].mae is None
    text = monitoring.monitoring_summary_text(monitoring.monitoring_summary(table, predictions))
    assert "Final-test rows: 2" in {r.value for r in text.collect()}
    with pytest.raises(ValueError):
        monitoring.monitoring_report(table, predictions.drop("model"))


def test_benchmark_preparation_checks(spark):
    wide = spark.createDataFrame([("a", 1, 2), ("b", 3, 4)], "id string, d_1 int, d_2 int")
    series = spark.createDataFrame(
        [("a", "i", "d", "c", "s", "CA"), ("b", "i", "d", "c", "s", "NY")],
        ", ".join(f"{c} string" for c in benchmark.SERIES_COLUMNS),
    )
    calendar = spark.createDataFrame(
        [
            (DAY + dt.timedelta(days=i), f"d_{i + 1}", 1, "x", i + 1, 5, 2025, None, None, None, "T" if i else None, 1, 0, 0)
            for i in range(3)
        ],
        "date date, d string, wm_yr_wk int, weekday string, wday int, month int, year int, "
        "event_name_1 string, event_type_1 string, event_name_2 string, event_type_2 string, "
        "snap_CA int, snap_TX int, snap_WI int",
    )
    table = benchmark.prepare_benchmark(wide, series, calendar)
    rows = {(r.id, r.d): r for r in table.collect()}
    assert table.columns == benchmark.OUTPUT_COLUMNS and len(rows) == 4
    assert rows["a", "d_1"].snap == 1 and rows["b", "d_1"].snap == 0
    assert rows["a", "d_1"].is_weekend == 1 and rows["a", "d_2"].is_weekend == 0
    assert rows["a", "d_2"].event_type_present == 1 and rows["a", "d_2"].has_event == 0
    assert rows["b", "d_2"].lag_1 == 3.0 and rows["b", "d_2"].demand == 4.0
    with pytest.raises(ValueError, match="not found"):
        benchmark.prepare_benchmark(wide.where("id = 'a'"), series, calendar)
    with pytest.raises(ValueError, match="Duplicate"):
        benchmark.prepare_benchmark(wide, series.union(series), calendar)
    with pytest.raises(ValueError, match="observed days"):
        benchmark.prepare_benchmark(wide, series, calendar.where("d <> 'd_2'"))
    with pytest.raises(ValueError, match="negative_demand"):
        benchmark.prepare_benchmark(wide.selectExpr("id", "-d_1 AS d_1", "d_2"), series, calendar)
