from __future__ import annotations

import datetime as dt

import pandas as pd
import pytest
from pyspark.sql import functions as F

from shelfcast.operators import eda, panel, sales_queries, splits

START = dt.date(2025, 1, 1)
SALES = (
    "date date, product_id string, category string, quantity bigint, price double, "
    "promotion int, discount double, holiday int"
)


def frame(spark, rows):
    """Rows of (day offset, product, quantity[, price])."""
    full = [
        (START + dt.timedelta(days=r[0]), r[1], "C", r[2], r[3] if len(r) > 3 else 10.0, 0, 0.0, 0)
        for r in rows
    ]
    return spark.createDataFrame(full, SALES)


def by_day(df):
    return {(r.product_id, (r.date - START).days): r for r in df.collect()}


def test_grid_has_every_product_and_day(spark):
    sales = frame(spark, [(0, "P1", 5), (2, "P1", 7), (0, "P2", 1), (2, "P2", 2)])
    rows = by_day(panel.build_panel(sales))
    assert len(rows) == 6 and {d for _, d in rows} == {0, 1, 2}
    assert rows["P1", 1].quantity == 0 and rows["P1", 1].category == "C"


def test_days_before_the_first_sale_have_no_category_or_price(spark):
    sales = frame(spark, [(0, "P1", 5), (4, "P1", 7), (2, "P2", 3, 30.0)])
    rows = by_day(panel.build_panel(sales))
    assert len(rows) == 10
    assert rows["P2", 0].category is None and rows["P2", 1].price is None
    assert rows["P2", 0].quantity == 0
    assert rows["P2", 4].price == 30.0 and rows["P2", 4].category == "C"


def test_price_is_carried_forward_only(spark):
    sales = frame(spark, [(0, "P1", 1, 100.0), (1, "P1", 1, None), (2, "P1", 1, 300.0)])
    rows = by_day(panel.build_panel(sales))
    assert [rows["P1", d].price for d in range(3)] == [100.0, 100.0, 300.0]


def test_several_sales_of_a_day_are_combined(spark):
    rows = by_day(panel.build_panel(frame(spark, [(0, "P1", 2, 10.0), (0, "P1", 3, 20.0)])))
    assert rows["P1", 0].quantity == 5 and rows["P1", 0].price == 15.0


def test_two_categories_on_one_day_stop_the_job(spark):
    sales = frame(spark, [(0, "P1", 1), (1, "P1", 1)])
    other = sales.withColumn("category", F.lit("D"))
    with pytest.raises(Exception, match="Two rows for product P1"):
        panel.build_panel(sales.union(other)).collect()


def test_lags_and_rolling_values_of_a_ramp(spark):
    sales = frame(spark, [(i, "P1", i + 1) for i in range(35)])
    rows = by_day(panel.add_features(panel.build_panel(sales)))
    row = rows["P1", 28]
    assert (row.lag_1, row.lag_7, row.lag_14, row.lag_28) == (28, 22, 15, 1)
    assert row.rolling_mean_7 == 25.0
    assert row.rolling_std_7 == pytest.approx(pd.Series(range(22, 29)).std())
    assert rows["P1", 27].lag_28 is None and rows["P1", 27].rolling_mean_28 is None
    assert rows["P1", 6].rolling_mean_7 is None and rows["P1", 7].rolling_mean_7 == 4.0


def test_a_change_today_does_not_reach_todays_features(spark):
    base = [(i, "P1", i % 5 + 1) for i in range(40)]
    changed = base[:35] + [(35, "P1", 999)] + base[36:]
    names = [c for c in panel.FEATURE_COLUMNS if c.startswith(("lag", "rolling"))]
    left = by_day(panel.add_features(panel.build_panel(frame(spark, base))))
    right = by_day(panel.add_features(panel.build_panel(frame(spark, changed))))
    for day in range(36):
        assert [left["P1", day][c] for c in names] == [right["P1", day][c] for c in names]
    assert right["P1", 36].lag_1 == 999


def test_features_match_pandas_with_gaps(spark):
    rows = [(i, p, (i * k) % 17 + 1) for p, k in (("P1", 3), ("P2", 5)) for i in range(60) if i % k]
    found = panel.add_features(panel.build_panel(frame(spark, rows))).toPandas()
    for _, group in found.groupby("product_id"):
        group = group.sort_values("date")
        past = group.quantity.shift(1)
        for n in panel.WINDOWS:
            for name, expected in (
                (f"rolling_mean_{n}", past.rolling(n).mean()),
                (f"rolling_std_{n}", past.rolling(n).std()),
            ):
                pd.testing.assert_series_equal(
                    group[name].astype(float), expected, check_names=False, atol=1e-9
                )
    check = panel.leakage_check(panel.add_features(panel.build_panel(frame(spark, rows)))).first()
    assert check.mismatches == 0 and check.rows_checked > 0


def test_calendar_features(spark):
    rows = by_day(panel.calendar_features(panel.build_panel(frame(spark, [(0, "P", 1), (4, "P", 1)]))))
    assert (rows["P", 0].day_of_week, rows["P", 0].month, rows["P", 0].week_of_year) == (2, 1, 1)
    assert rows["P", 2].is_weekend == 0 and rows["P", 3].is_weekend == 1


def dates(spark, n, first=dt.date(2024, 1, 1)):
    return spark.range(n).select(F.date_add(F.lit(first), F.col("id").cast("int")).alias("date"))


def test_folds_are_ordered_disjoint_and_growing(spark):
    df = dates(spark, 487)  # to 2025-05-01
    folds = splits.time_series_folds(df)
    assert [f.fold for f in folds] == [1, 2, 3, 4]
    assert folds[-1].test_end == dt.date(2025, 5, 1)
    for before, after in zip(folds, folds[1:]):
        assert before.test_end < after.test_start and before.train_end < after.train_end
    for fold in folds:
        assert (fold.test_end - fold.test_start).days == 59
        assert (fold.test_start - fold.train_end).days == 1
        assert fold.train(df).join(fold.test(df), "date").isEmpty()
    table = [tuple(r) for r in splits.fold_table(df).orderBy("fold").collect()]
    assert table == [(f.fold, f.train_end, f.test_start, f.test_end) for f in folds]
    assigned = {r.fold: (r.a, r.b) for r in splits.assign_folds(df).groupBy("fold").agg(
        F.min("date").alias("a"), F.max("date").alias("b")).collect()}
    assert assigned == {f.fold: (f.test_start, f.test_end) for f in folds}


def test_too_few_dates_raise(spark):
    with pytest.raises(ValueError, match="Not enough dates"):
        splits.time_series_folds(dates(spark, 299))
    assert len(splits.time_series_folds(dates(spark, 300))) == 4


def test_holdout_is_the_end_of_the_table(spark):
    development, holdout = splits.holdout_frames(dates(spark, 100), 60)
    assert development.count() == 40 and holdout.count() == 60
    with pytest.raises(ValueError, match="development"):
        splits.holdout_frames(dates(spark, 60), 60)
    with pytest.raises(ValueError, match="no dates"):
        splits.holdout_frames(dates(spark, 0), 60)
    split = splits.holdout_split(dates(spark, 100), 60).groupBy("split").count().collect()
    assert {r.split: r["count"] for r in split} == {"development": 40, "test": 60}


def test_benchmark_windows_walk_back(spark):
    folds = splits.benchmark_folds(dates(spark, 400))
    assert [f.fold for f in folds] == [1, 2, 3, 4]
    assert all(a.train_end == b.test_end for a, b in zip(folds, folds[1:]))


def test_empty_weeks_and_months_count_zero(spark):
    sales = frame(spark, [(0, "P1", 5), (20, "P1", 7), (100, "P1", 1)])
    weeks = {r.week_end: r.quantity for r in eda.weekly_total(sales).collect()}
    series = pd.Series([5, 7, 1], index=pd.to_datetime([START + dt.timedelta(days=d) for d in (0, 20, 100)]))
    assert weeks == {k.date(): v for k, v in series.resample("W").sum().items()}
    months = {r.month_start: r.quantity for r in eda.monthly_total(sales).collect()}
    assert months == {k.date(): v for k, v in series.resample("MS").sum().items()}


def test_outliers_need_the_window_before_the_day(spark):
    rows = [(i, "P1", 10 + i % 3) for i in range(30)]
    rows[20] = (20, "P1", 500)
    sales = frame(spark, rows)
    assert eda.rolling_outliers(sales).isEmpty()  # bounded by 6 / sqrt(7)
    found = eda.rolling_outliers(sales, include_current=False).collect()
    assert [(r.date - START).days for r in found] == [20]


def test_declining_products_window_edges(spark):
    rows = [(d, "P1", 10 if d < 90 else 5) for d in range(181)] + [(180, "P2", 1)]
    loose = sales_queries.declining_products(frame(spark, rows)).collect()
    assert [r.product_id for r in loose] == ["P1"]  # P2 has no prior window
    # 91 recent days (90..180) and 90 prior days (0..89)
    assert loose[0].avg_daily_recent_90d == 5.0 and loose[0].avg_daily_prior_90d == 10.0
    strict = sales_queries.declining_products(frame(spark, rows), strict=True).first()
    assert strict.avg_daily_prior_90d == pytest.approx((89 * 10 + 5) / 90, abs=0.01)


def test_rank_shares_places_and_skips_after_ties(spark):
    rows = [(0, "P1", 5), (0, "P2", 9), (0, "P3", 9), (0, "P4", 1)]
    ranks = {r.product_id: r.category_rank for r in sales_queries.category_rank(frame(spark, rows)).collect()}
    assert ranks == {"P2": 1, "P3": 1, "P1": 3, "P4": 4}
