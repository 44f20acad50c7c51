"""The public benchmark: wide sales to a daily table, and recursive multi-step forecasts."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.functions.contracts import assert_unique_key, duplicate_keys, require_columns
from shelfcast.functions.metrics import evaluate_benchmark
from shelfcast.functions.ordered import ranked_values
from shelfcast.functions.workspace import materialize, replace
from shelfcast.operators.ensembles import Ensemble
from shelfcast.operators.models import BOOSTING, NAIVE, BoostingFitter, Model, boosting_fitter, fold_step
from shelfcast.operators.panel import lag_columns, rolling_columns
from shelfcast.operators.splits import BENCHMARK_HORIZON, Fold, benchmark_folds, final_flag

# Columns of the benchmark files, coded categories and model features.
SERIES_COLUMNS = ("id", "item_id", "dept_id", "cat_id", "store_id", "state_id")
CODED = ("item_id", "store_id", "dept_id", "cat_id", "state_id")
CODES = tuple(name.removesuffix("_id") + "_code" for name in CODED)
HISTORY = 28
HISTORY_FEATURES = [
    "lag_1", "lag_7", "lag_14", "lag_28",
    "rolling_mean_7", "rolling_mean_14", "rolling_mean_28",
    "rolling_std_7", "rolling_std_28",
]
CALENDAR_FEATURES = ["month", "wday", "is_weekend", "has_event", "event_type_present", "snap"]
FEATURES = [*HISTORY_FEATURES, *CALENDAR_FEATURES, *CODES]
# Columns of the prepared table.
OUTPUT_COLUMNS = [
    *SERIES_COLUMNS, "date", "d", "demand", "weekday", "wday", "month", "year", "wm_yr_wk",
    "is_weekend", "has_event", "event_type_present", "snap", *HISTORY_FEATURES, "is_final_test",
]


def select_series(wide: DataFrame, selected: DataFrame, check: bool = True) -> DataFrame:
    """Keep the selected series; with ``check``, raise if a selected one is repeated or absent."""
    if check:
        assert_unique_key(selected, ["id"], "selected series")
        absent = selected.select("id").join(wide.select("id"), "id", "left_anti")
        if not absent.isEmpty():
            raise ValueError(f"Selected series not found: {absent.first()['id']}")
    return wide.join(selected.select("id"), "id", "left_semi")


def melt_days(wide: DataFrame, day_columns: Sequence[str] | None = None) -> DataFrame:
    """One row per series and day column."""
    days = list(day_columns or [c for c in wide.columns if c.startswith("d_")])
    return wide.unpivot(["id"], days, "d", "demand")


def join_metadata(daily: DataFrame, metadata: DataFrame, check: bool = True) -> DataFrame:
    """Add item, department, category, store and state of each series."""
    require_columns(metadata, SERIES_COLUMNS, "selection columns")
    if check:
        assert_unique_key(metadata, ["id"], "series metadata")
    return daily.join(metadata.select(*SERIES_COLUMNS), "id", "left")


def observed_calendar(calendar: DataFrame, day_columns: Sequence[str]) -> DataFrame:
    """The calendar rows of the observed day columns."""
    return calendar.where(F.col("d").isin(*day_columns))


def calendar_coverage(calendar: DataFrame, day_columns: Sequence[str]) -> DataFrame:
    """Calendar rows found for the observed days, against the days there are."""
    return observed_calendar(calendar, day_columns).agg(
        F.count("*").alias("calendar_rows"),
        F.count_distinct("d").alias("calendar_days"),
        F.lit(len(day_columns)).cast("bigint").alias("expected_days"),
    )


def require_calendar_coverage(calendar: DataFrame, day_columns: Sequence[str]) -> DataFrame:
    found = calendar_coverage(calendar, day_columns).first()
    if found["calendar_rows"] != len(day_columns) or found["calendar_days"] != len(day_columns):
        raise ValueError(
            f"The calendar has {found['calendar_rows']} rows for {len(day_columns)} observed days"
        )
    return calendar


def join_calendar(daily: DataFrame, calendar: DataFrame, day_columns: Sequence[str]) -> DataFrame:
    """Add the calendar row of each day; the calendar is cut to the observed days first."""
    return daily.join(observed_calendar(calendar, day_columns), "d", "left")


def event_flags(daily: DataFrame, weekend: Sequence[int] = (1, 7)) -> DataFrame:
    """Weekend and event marks; demand as a number, null where it is not one."""

    def mark(condition: Column) -> Column:
        return F.when(condition, 1).otherwise(0)

    return daily.withColumns(
        {
            "demand": F.col("demand").try_cast("double"),
            "is_weekend": mark(F.col("wday").isin(*weekend)),
            "has_event": mark(
                F.col("event_name_1").isNotNull() | F.col("event_name_2").isNotNull()
            ),
            "event_type_present": mark(
                F.col("event_type_1").isNotNull() | F.col("event_type_2").isNotNull()
            ),
        }
    )


def state_snap(daily: DataFrame, states: Sequence[str] = ("CA", "TX", "WI")) -> DataFrame:
    """The benefit-day mark of the series' own state, 0 for other states."""
    snap = F.lit(0)
    for state in states:
        snap = F.when(F.col("state_id") == state, F.col(f"snap_{state}")).otherwise(snap)
    return daily.withColumn("snap", snap)


def quality_gate(daily: DataFrame) -> DataFrame:
    """Counts that must hold before features are built, in one row."""
    per_day = daily.groupBy("id", "date").agg(
        F.count("*").alias("n"),
        F.count_if(F.col("demand").isNull()).alias("null_demand"),
        F.count_if(F.col("demand") < 0).alias("negative_demand"),
    )
    per_series = per_day.groupBy("id").agg(
        F.sum("n").alias("n"),
        F.sum("null_demand").alias("null_demand"),
        F.sum("negative_demand").alias("negative_demand"),
        F.sum(F.when(F.col("date").isNull(), F.col("n")).otherwise(0)).alias("null_dates"),
        F.sum(F.col("n") - 1).alias("duplicates"),
    )
    return per_series.agg(
        F.sum("n").alias("n_rows"),
        F.count("*").alias("n_series"),
        *[
            F.sum(c).alias(c)
            for c in ("null_dates", "null_demand", "negative_demand", "duplicates")
        ],
    )


def require_quality(daily: DataFrame, n_series: int, n_days: int) -> DataFrame:
    """Return ``daily`` unchanged, or raise naming every count that does not hold."""
    _raise_for_quality(quality_gate(daily).first().asDict(), n_series, n_days)
    return daily


def _raise_for_quality(found: dict[str, int], n_series: int, n_days: int) -> None:
    expected = {
        "n_rows": n_series * n_days, "n_series": n_series, "null_dates": 0, "null_demand": 0,
        "negative_demand": 0, "duplicates": 0,
    }
    wrong = [f"{k}: {found[k]}; expected {v}" for k, v in expected.items() if found[k] != v]
    if wrong:
        raise ValueError("Benchmark panel failed: " + ", ".join(wrong))


def benchmark_features(daily: DataFrame) -> DataFrame:
    """Lags and full-window rolling statistics per series."""
    days = Window.partitionBy("id").orderBy("date")
    return daily.withColumns(
        {
            **lag_columns("demand", days),
            **rolling_columns("demand", days, means=(7, 14, 28), stds=(7, 28)),
        }
    )


def prepare_benchmark(
    wide: DataFrame,
    selected: DataFrame,
    calendar: DataFrame,
    horizon: int = BENCHMARK_HORIZON,
    weekend: Sequence[int] = (1, 7),
    check: bool = True,
) -> DataFrame:
    """The daily benchmark table with features and the holdout mark; one query makes all checks."""
    days = [c for c in wide.columns if c.startswith("d_")]
    long = melt_days(select_series(wide, selected, check=False), days)
    daily = join_calendar(join_metadata(long, selected, check=False), calendar, days)
    daily = state_snap(event_flags(daily, weekend))
    if check:
        _check_inputs(wide, selected, calendar, days, daily)
    last = observed_calendar(calendar, days).agg(F.max("date")).scalar()
    return final_flag(benchmark_features(daily), horizon, last=last).select(*OUTPUT_COLUMNS)


def _check_inputs(
    wide: DataFrame, selected: DataFrame, calendar: DataFrame, days: Sequence[str], daily: DataFrame
) -> None:
    """Raise for repeated or absent series and days, and for a panel with gaps or bad numbers."""
    repeated = F.struct(F.count("*").alias("n"), F.min("key").alias("key"))
    lone = selected.select("id").join(wide.select("id"), "id", "left_anti").withColumnRenamed("id", "key")
    found = wide.sparkSession.range(1).select(
        *[
            duplicate_keys(df, [key]).withColumnRenamed(key, "key").agg(repeated).scalar().alias(name)
            for name, df, key in (("days", calendar, "d"), ("series", selected, "id"))
        ],
        lone.agg(repeated).scalar().alias("absent"),
        calendar_coverage(calendar, days).select(F.struct("calendar_rows", "calendar_days")).scalar().alias("calendar"),
        quality_gate(daily).select(F.struct("*")).scalar().alias("gate"),
        selected.agg(F.struct(F.count("*").alias("n"))).scalar().alias("selected"),
    ).first()
    for name, key, what in (("days", "d", "calendar"), ("series", "id", "selected series")):
        if found[name]["n"]:
            raise ValueError(f"Duplicate {(key,)} in {what}: {found[name]['key']}")
    if found["absent"]["n"]:
        raise ValueError(f"Selected series not found: {found['absent']['key']}")
    if set(found["calendar"]) != {len(days)}:
        raise ValueError(f"The calendar has {found['calendar']['calendar_rows']} rows for {len(days)} observed days")
    _raise_for_quality(found["gate"].asDict(), found["selected"]["n"], len(days))


def category_codes(series: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value, code): the place of each value among the sorted values of its column."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in columns]))
    values = series.select(pairs.alias("pair")).select("pair.*").distinct()
    return ranked_values(values, ["column"], "value").select("column", "value", F.col("n_before").alias("code"))


def encode_categories(daily: DataFrame, columns: Sequence[str] = CODED) -> DataFrame:
    """Add one code column per category column, -1 where the value is missing.

    Codes are found on one row per series, in one ranking and one join for all columns; the daily table
    meets them in one join by series.
    """
    series = daily.select("id", *columns).distinct()
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in columns]))
    found = series.select("id", pairs.alias("pair")).select("id", "pair.*").join(
        category_codes(series, columns), ["column", "value"], "left"
    )
    codes = found.groupBy("id").agg(
        *[
            F.coalesce(F.max(F.when(F.col("column") == c, F.col("code"))), F.lit(-1))
            .cast("int")
            .alias(c.removesuffix("_id") + "_code")
            for c in columns
        ]
    )
    return daily.join(codes, "id", "left")


def training_rows(encoded: DataFrame, train_end: object) -> DataFrame:
    """Rows up to ``train_end`` on which every lag and rolling feature is known."""
    return encoded.where(F.col("date") <= F.lit(train_end)).dropna(subset=HISTORY_FEATURES)


def recent_history(daily: DataFrame, train_end: object, days: int = HISTORY) -> DataFrame:
    """The last ``days`` demands of each series as an array, oldest first.

    The date filter bounds each array; a series with fewer days stops the job.
    """
    end = F.lit(train_end).cast("date")
    recent = daily.where(F.col("date").between(F.date_sub(end, days - 1), end))
    values = F.transform(
        F.array_sort(F.collect_list(F.struct("date", F.col("demand").cast("double").alias("v")))),
        lambda s: s["v"],
    )
    return recent.groupBy("id").agg(values.alias("history")).select(
        "id",
        F.when(F.size("history") == days, F.col("history"))
        .otherwise(
            F.raise_error(F.concat(F.lit("Too little history for series "), "id")).cast("array<double>")
        )
        .alias("history"),
    )


def future_days(daily: DataFrame, fold: Fold) -> DataFrame:
    """The validation days of each series as one ordered array, as long as the horizon."""
    day = F.struct("date", F.col("demand").cast("double").alias("demand"), *CALENDAR_FEATURES)
    return (
        fold.test(daily)
        .groupBy("id")
        .agg(
            F.array_sort(F.collect_list(day)).alias("future"),
            *[F.first(c).alias(c) for c in CODES if c in daily.columns],
        )
    )


def naive_multistep(daily: DataFrame, fold: Fold, season: int = 7) -> DataFrame:
    """Repeat the last ``season`` demands over the validation days, never below 0."""
    history = recent_history(daily, fold.train_end)
    step = F.col("position") % season + 1
    last = F.slice("history", HISTORY - season + 1, season)
    return (
        future_days(daily, fold)
        .join(history, "id")
        .select("id", last.alias("last"), F.posexplode("future").alias("position", "day"))
        .select(
            "id",
            "day.date",
            "day.demand",
            F.greatest(F.element_at("last", step.cast("int")), F.lit(0.0)).alias("prediction"),
        )
    )


def recursive_feature_columns(history: str, day: Column) -> dict[str, Column]:
    """Features of the next day from the last 28 demands and the day's calendar values."""

    def recent(n: int) -> Column:
        return F.slice(history, HISTORY - n + 1, n)

    def total(values: Column) -> Column:
        return F.aggregate(values, F.lit(0.0), lambda s, v: s + v)

    def mean(n: int) -> Column:
        return total(recent(n)) / n

    def deviation(n: int) -> Column:
        squares = F.transform(
            F.array(mean(n)),
            lambda m: total(F.transform(recent(n), lambda v: (v - m) * (v - m))),
        )[0]
        return F.sqrt(squares / (n - 1))

    columns = {f"lag_{n}": F.element_at(history, -n) for n in (1, 7, 14, 28)}
    columns |= {f"rolling_mean_{n}": mean(n) for n in (7, 14, 28)}
    columns |= {f"rolling_std_{n}": deviation(n) for n in (7, 28)}
    columns |= {name: day[name] for name in CALENDAR_FEATURES}
    return columns


def recursive_feature_row(daily: DataFrame, fold: Fold) -> DataFrame:
    """The features of the first validation day of each series."""
    state = future_days(daily, fold).join(recent_history(daily, fold.train_end), "id")
    first = F.get("future", F.lit(0))
    return state.select(
        "id",
        first["date"].alias("date"),
        *[c.alias(n) for n, c in recursive_feature_columns("history", first).items()],
        *[c for c in CODES if c in daily.columns],
    )


def recursive_forecast(
    model: Model, encoded: DataFrame, fold: Fold, cut_every: int = 7
) -> DataFrame:
    """Forecast the validation days one after the other, feeding each prediction back.

    An ensemble forecasts the whole horizon in one narrow stage. For other models, one row per series carries the last 28 demands, so a step scores all series in one distributed
    transform without a shuffle. The history and the predictions, not the days to come, are written
    every ``cut_every`` steps, which keeps the plan short; what they replace is deleted.
    """
    if isinstance(model, Ensemble):
        return _horizon(model, encoded, fold)
    days = materialize(future_days(encoded, fold), "recursion-days")
    start = recent_history(encoded, fold.train_end).join(days.select("id"), "id")
    written = materialize(start.withColumn("predictions", F.array().cast("array<double>")), "recursion")
    horizon = days.agg(F.max(F.size("future"))).first()[0] or 0
    state = written.join(days, "id")
    kept = [c for c in ("id", "future", *CODES) if c in state.columns]
    for step in range(horizon):
        day = F.get("future", F.lit(step))
        scored = model.transform(state.withColumns(recursive_feature_columns("history", day)))
        value = F.greatest("prediction", F.lit(0.0))
        state = scored.withColumn("_value", value).select(
            *kept,
            F.concat(F.slice("history", 2, HISTORY - 1), F.array("_value")).alias("history"),
            F.concat("predictions", F.array("_value")).alias("predictions"),
        )
        if (step + 1) % cut_every == 0 or step + 1 == horizon:
            written = replace(written, state.select("id", "history", "predictions"), "recursion")
            state = written.join(days, "id")
    return state.select(
        "id", "predictions", F.posexplode("future").alias("position", "day")
    ).select(
        "id",
        "day.date",
        "day.demand",
        F.get("predictions", F.col("position")).alias("prediction"),
    )


def _horizon(model: Ensemble, encoded: DataFrame, fold: Fold) -> DataFrame:
    """All days of all series of a batch, day by day on arrays; series meet their history in one join, nothing is written."""
    codes = [c for c in CODES if c in encoded.columns]
    state = future_days(encoded, fold).join(recent_history(encoded, fold.train_end), "id")
    future = F.col("future")
    plain = state.select(
        "id", future.getField("date").alias("dates"), future.getField("demand").alias("demands"), "history", *codes,
        *[future.getField(c).cast("array<double>").alias(c) for c in CALENDAR_FEATURES])
    shared = encoded.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(c) for c in ("id", "dates", "demands")], _steps(own, batch, codes)],
                    ["id", "dates", "demands", "predictions"])

    fields = [plain.schema[c] for c in ("id", "dates", "demands")]
    forecast = plain.mapInArrow(run, T.StructType([*fields, T.StructField("predictions", T.ArrayType(T.DoubleType()))]))
    day = F.explode(F.arrays_zip("dates", "demands", "predictions")).alias("d")
    return forecast.select("id", day).select(
        "id", F.col("d.dates").alias("date"), F.col("d.demands").alias("demand"), F.col("d.predictions").alias("prediction"))


def _steps(model: Ensemble, batch: pa.RecordBatch, codes: Sequence[str]) -> pa.Array:
    """Predictions of every series, each array as long as its future; null demands of the past are missing values."""
    past = batch.column("history").flatten().to_numpy(zero_copy_only=False).reshape(-1, HISTORY).astype(float)
    lengths = np.diff(batch.column("dates").offsets.to_numpy())
    starts = np.cumsum(lengths) - lengths
    calendar = {c: batch.column(c).flatten().to_numpy(zero_copy_only=False).astype(float) for c in CALENDAR_FEATURES}
    fixed = {c: batch.column(c).to_numpy(zero_copy_only=False).astype(float) for c in codes}
    found = np.full(int(lengths.sum()), np.nan)
    for step in range(int(lengths.max(initial=0))):
        on = np.flatnonzero(lengths > step)
        recent = past[on]
        known = {f"lag_{n}": recent[:, -n] for n in (1, 7, 14, 28)}
        known |= {f"rolling_mean_{n}": recent[:, -n:].mean(1) for n in (7, 14, 28)}
        known |= {f"rolling_std_{n}": recent[:, -n:].std(1, ddof=1) for n in (7, 28)}
        known |= {c: v[starts[on] + step] for c, v in calendar.items()} | {c: v[on] for c, v in fixed.items()}
        value = np.maximum(model.predict(np.column_stack([known[c] for c in model.columns])), 0.0)
        found[starts[on] + step] = value
        past[on] = np.column_stack([recent[:, 1:], value])
    return pa.ListArray.from_arrays(pa.array(np.r_[starts, lengths.sum()], pa.int32()), pa.array(found))


def benchmark_fitter(rounds: int = 400, rate: float = 0.05) -> BoostingFitter:
    return boosting_fitter(rounds, FEATURES, "demand", rate)


def fit_windows(encoded: DataFrame, folds: Sequence[Fold], rounds: int = 400, rate: float = 0.05) -> dict[object, Ensemble]:
    """The boosted model of every window by the end of its training, all fitted in the same scans."""
    ordered = sorted(folds, key=lambda f: f.train_end)
    rows = training_rows(encoded, ordered[-1].train_end)
    fitted = benchmark_fitter(rounds, rate).fit_steps(rows, fold_step(ordered), range(1, len(ordered) + 1))
    return {fold.train_end: model for fold, model in zip(ordered, fitted, strict=True)}


def evaluate_window(
    encoded: DataFrame, fold: Fold, model_name: str, rounds: int = 400, fitted: Model | None = None
) -> DataFrame:
    """Predictions of one model, ``fitted`` or to be fitted, for one window; metrics come from ``evaluate_benchmark``."""
    if model_name == NAIVE:
        return naive_multistep(encoded, fold)
    if model_name != BOOSTING:
        raise ValueError(f"Unknown benchmark model: {model_name}")
    if fitted is None:
        fitted = benchmark_fitter(rounds)(training_rows(encoded, fold.train_end))
    return recursive_forecast(fitted, encoded, fold)


def benchmark_cv(
    encoded: DataFrame,
    folds: Sequence[Fold] | None = None,
    models: Sequence[str] = (NAIVE, BOOSTING),
    rounds: int = 400,
    fitted: dict[object, Model] | None = None,
) -> DataFrame:
    """Metrics per fold and model; ``encoded`` should be a written table.

    ``fitted`` holds boosted models by the end of their training; without it those of all folds are fitted together.
    """
    windows = benchmark_folds(encoded) if folds is None else folds
    if fitted is None:
        fitted = fit_windows(encoded, windows, rounds) if BOOSTING in models else {}
    frames = [
        evaluate_window(encoded, fold, name, rounds, fitted.get(fold.train_end)).select(
            F.lit(fold.fold).alias("fold"),
            F.lit(fold.train_end).alias("train_end"),
            F.lit(fold.test_start).alias("validation_start"),
            F.lit(fold.test_end).alias("validation_end"),
            F.lit(name).alias("model"),
            "demand",
            "prediction",
        )
        for fold in windows
        for name in models
    ]
    return evaluate_benchmark(
        reduce(DataFrame.unionByName, frames),
        ["fold", "train_end", "validation_start", "validation_end", "model"],
    )


def benchmark_cv_summary(results: DataFrame) -> DataFrame:
    """Mean of each metric over the folds, best MAE first."""
    return (
        results.groupBy("model")
        .agg(*[F.avg(m).alias(m) for m in ("mae", "rmse", "smape_pct", "wape_pct")])
        .orderBy("mae", "model")
    )


def final_fold(encoded: DataFrame) -> Fold:
    """The holdout marked in the table, as a window."""
    marked = encoded.where(F.col("is_final_test") == 1)
    span = marked.agg(
        F.min("date").alias("a"), F.max("date").alias("b"), F.date_sub(F.min("date"), 1).alias("t")
    ).first()
    return Fold(0, span["t"], span["a"], span["b"])


def benchmark_final(
    encoded: DataFrame, models: Sequence[str] = (NAIVE, BOOSTING), rounds: int = 400, fitted: Model | None = None
) -> DataFrame:
    """Holdout predictions of every model, stacked with a model column; ``fitted`` is the boosted one if there is one."""
    fold = final_fold(encoded)
    frames = [
        evaluate_window(encoded, fold, name, rounds, fitted).withColumn("model", F.lit(name))
        for name in models
    ]
    return reduce(DataFrame.unionByName, frames)
