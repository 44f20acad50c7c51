"""Shared inputs of the registered queries, derived from the driver tables.

Tables that several stages read, such as the model features, are written once per application and
read back, the way a scheduled job hands its result to the next one.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.functions.workspace import materialize
from shelfcast.operators import benchmark, ensembles, models, panel, splits
from shelfcast.sources import standin

# Sizes of the cross-validation: the library's, which take longer than other queries may (README).
QUERY_ROUNDS = 400
QUERY_RATE = 0.05
QUERY_TREES = 300
# Sizes of the other registered queries. Twenty rounds at 0.3 shrink the first error about as far.
SHORT_ROUNDS = 20
SHORT_RATE = 0.3
SHORT_TREES = 16
_KEPT: dict[tuple[str, str, str], object] = {}


def _keep(spark: SparkSession, folder: str, label: str, make):
    key = (spark.sparkContext.applicationId, folder, label)
    if key not in _KEPT:
        _KEPT[key] = make()
    return _KEPT[key]


def features(spark: SparkSession, folder: str) -> DataFrame:
    """The model feature table, written once."""
    return _keep(
        spark, folder, "features",
        lambda: materialize(panel.model_features(standin.sales(spark, folder)), "features"),
    )


def full_features(spark: SparkSession, folder: str) -> DataFrame:
    """Features including the warm-up rows."""
    return panel.add_features(panel.build_panel(standin.sales(spark, folder)))


def cutoff(spark: SparkSession, folder: str) -> str:
    """The last date of the sales, fetched once; a raw row dated later is wrong."""
    return _keep(
        spark, folder, "last_day",
        lambda: str(standin.sales(spark, folder).agg(F.max("date")).first()[0]),
    )


def last_day(spark: SparkSession, folder: str) -> Column:
    """The same date as a literal for filters."""
    return F.lit(cutoff(spark, folder)).cast("date")


def naive_holdout(spark: SparkSession, folder: str) -> DataFrame:
    """Holdout rows predicted by the value of a week before."""
    start = F.date_sub(last_day(spark, folder), splits.HOLDOUT_DAYS - 1)
    holdout = features(spark, folder).where(F.col("date") >= start)
    return holdout.withColumn("prediction", F.col("lag_7"))


def naive_oof(spark: SparkSession, folder: str) -> DataFrame:
    """Out-of-fold rows of the development period, predicted the same way."""
    last = F.date_sub(last_day(spark, folder), splits.HOLDOUT_DAYS)
    development = features(spark, folder).where(F.col("date") <= last)
    folds = splits.assign_folds(development, last=last)
    error = F.col("quantity") - F.col("lag_7")
    return folds.select(
        "product_id", "category", "date", "quantity", F.col("lag_7").alias("prediction"),
        error.alias("error"), F.abs(error).alias("abs_error"), "fold",
    )


def policy_test(spark: SparkSession, folder: str) -> DataFrame:
    return naive_holdout(spark, folder).select(
        "product_id", "date", F.col("quantity").alias("actual_demand"),
        F.col("prediction").alias("forecast"),
    )


def monitored(spark: SparkSession, folder: str) -> DataFrame:
    """The panel under the names the monitoring checks use, with the 28-day holdout marked."""

    def build() -> DataFrame:
        table = full_features(spark, folder).select(
            F.col("product_id").alias("id"), "date", F.col("quantity").alias("demand"),
            "price", "discount", "promotion", "holiday", "lag_1", "lag_7", "lag_14", "lag_28",
        )
        flagged = splits.final_flag(table, last=last_day(spark, folder))
        return materialize(flagged, "monitored")

    return _keep(spark, folder, "monitored", build)


def benchmark_daily(spark: SparkSession, folder: str) -> DataFrame:
    """The sales panel as a benchmark table: every product is one series."""

    def build() -> DataFrame:
        daily = panel.build_panel(standin.sales(spark, folder))
        product = F.col("product_id")
        brand = F.split(product, "/")[0]
        number = F.split(product, "#")[1]
        number = F.split(number, "/")[0].cast("int")
        states = F.array(F.lit("CA"), F.lit("TX"), F.lit("WI"), F.lit("NY"))
        named = daily.select(
            product.alias("id"),
            product.alias("item_id"),
            brand.alias("dept_id"),
            F.split(product, "/")[1].alias("cat_id"),
            F.concat(F.lit("STORE_"), (number % 10).cast("string")).alias("store_id"),
            F.element_at(states, number % 4 + 1).alias("state_id"),
            "date",
            F.concat(F.lit("d_"), (F.datediff("date", F.lit("1995-01-01")) + 1).cast("string"))
            .alias("d"),
            F.col("quantity").alias("demand"),
        )
        days = named.withColumns(standin.calendar_columns(F.col("date")))
        flagged = benchmark.state_snap(benchmark.event_flags(days))
        table = splits.final_flag(
            benchmark.benchmark_features(flagged), last=last_day(spark, folder)
        )
        return materialize(table.select(*benchmark.OUTPUT_COLUMNS), "benchmark")

    return _keep(spark, folder, "benchmark", build)


def benchmark_encoded(spark: SparkSession, folder: str) -> DataFrame:
    return _keep(
        spark, folder, "encoded",
        lambda: materialize(
            benchmark.encode_categories(benchmark_daily(spark, folder)), "encoded"
        ),
    )


def event_benchmark(spark: SparkSession, folder: str) -> dict[str, DataFrame | list[str]]:
    wide = standin.wide_demand(spark, folder)
    return {
        "wide": wide,
        "metadata": standin.series_metadata(spark, folder),
        "calendar": standin.calendar(spark, folder, extra_days=5),
        "days": [c for c in wide.columns if c.startswith("d_")],
    }


def event_daily(spark: SparkSession, folder: str) -> DataFrame:
    """Long daily events with metadata, calendar, flags and snap; checks are separate queries."""
    parts = event_benchmark(spark, folder)
    long = benchmark.melt_days(parts["wide"], parts["days"])
    named = benchmark.join_metadata(long, parts["metadata"], check=False)
    dated = benchmark.join_calendar(named, parts["calendar"], parts["days"])
    return benchmark.state_snap(benchmark.event_flags(dated))


def development(spark: SparkSession, folder: str) -> DataFrame:
    """The feature rows before the holdout, whose first day follows from the last date of the sales."""
    start = F.date_sub(last_day(spark, folder), splits.HOLDOUT_DAYS - 1)
    return features(spark, folder).where(F.col("date") < start)


def holdout(spark: SparkSession, folder: str) -> DataFrame:
    start = F.date_sub(last_day(spark, folder), splits.HOLDOUT_DAYS - 1)
    return features(spark, folder).where(F.col("date") >= start)


def production_model(spark: SparkSession, folder: str) -> ensembles.Ensemble:
    """The boosted model of all development rows."""
    fitter = models.boosting_fitter(SHORT_ROUNDS, rate=SHORT_RATE)
    return _keep(spark, folder, "production", lambda: fitter(development(spark, folder)))


def cv_predictions(spark: SparkSession, folder: str) -> DataFrame:
    """Out-of-fold predictions of models of full size, fitted for every fold."""

    def build() -> DataFrame:
        fitters = models.build_models(QUERY_TREES) | {models.BOOSTING: models.boosting_fitter(QUERY_ROUNDS, rate=QUERY_RATE)}
        return materialize(models.cross_validate(development(spark, folder), fitters), "cv")

    return _keep(spark, folder, "cv", build)


def fitted_model(spark: SparkSession, folder: str, name: str) -> models.Model:
    """One model of all development rows; fits that one only."""
    if name == models.BOOSTING:
        return production_model(spark, folder)
    fitter = {models.RIDGE: models.ridge_fitter(), models.FOREST: models.forest_fitter(SHORT_TREES)}[name]
    return _keep(spark, folder, f"fit-{name}", lambda: fitter(development(spark, folder)))


def predictions_of(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """Holdout predictions of one model."""
    if name == models.NAIVE:
        predicted = naive_holdout(spark, folder)
    else:
        predicted = models.predict_demand(holdout(spark, folder), fitted_model(spark, folder, name))
    return predicted.select(*models.ROW_KEY, panel.TARGET, "prediction", F.lit(name).alias("model"))


def model_predictions(spark: SparkSession, folder: str) -> DataFrame:
    """Holdout predictions of the naive and every trained model."""

    def build() -> DataFrame:
        names = (models.NAIVE, models.RIDGE, models.FOREST, models.BOOSTING)
        return materialize(reduce(DataFrame.unionByName, [predictions_of(spark, folder, n) for n in names]), "holdout")

    return _keep(spark, folder, "holdout", build)


def benchmark_models(spark: SparkSession, folder: str) -> dict[object, ensembles.Ensemble]:
    """The boosted models of the four windows and of the holdout by the end of their training, fitted in the same scans."""

    def build() -> dict[object, ensembles.Ensemble]:
        encoded = benchmark_encoded(spark, folder)
        folds = [*benchmark.benchmark_folds(encoded), benchmark.final_fold(encoded)]
        return benchmark.fit_windows(encoded, folds, SHORT_ROUNDS, SHORT_RATE)

    return _keep(spark, folder, "benchmark_models", build)


def benchmark_cv(spark: SparkSession, folder: str) -> DataFrame:
    return _keep(
        spark, folder, "benchmark_cv",
        lambda: materialize(
            benchmark.benchmark_cv(benchmark_encoded(spark, folder), fitted=benchmark_models(spark, folder)), "bcv"
        ),
    )


def benchmark_cv_naive(spark: SparkSession, folder: str) -> DataFrame:
    """The validation of the naive forecast alone, which trains nothing."""
    return benchmark.benchmark_cv(benchmark_encoded(spark, folder), models=[models.NAIVE])


def benchmark_final(spark: SparkSession, folder: str) -> DataFrame:
    def build() -> DataFrame:
        encoded = benchmark_encoded(spark, folder)
        model = benchmark_models(spark, folder)[benchmark.final_fold(encoded).train_end]
        return materialize(benchmark.benchmark_final(encoded, fitted=model), "final")

    return _keep(spark, folder, "benchmark_final", build)


def benchmark_final_naive(spark: SparkSession, folder: str) -> DataFrame:
    return benchmark.benchmark_final(benchmark_encoded(spark, folder), models=[models.NAIVE])


def requests(spark: SparkSession, folder: str) -> DataFrame:
    """Scoring requests made from the feature rows; some days break a rule."""
    table = features(spark, folder)
    day = F.dayofyear("date")
    return table.select(
        F.concat_ws("|", "product_id", F.col("date").cast("string")).alias("request_id"),
        "product_id",
        "category",
        *[
            {
                "promotion": F.when(day % 50 == 1, F.lit(2.0)).otherwise(F.col("promotion")),
                "month": F.when(day % 50 == 2, F.lit(13)).otherwise(F.col("month")),
                "lag_7": F.when(day % 50 == 3, F.lit(None)).otherwise(F.col("lag_7")),
                "price": F.when(day % 50 == 4, -F.col("price")).otherwise(F.col("price")),
            }.get(name, F.col(name)).alias(name)
            for name in panel.FEATURE_COLUMNS
        ],
    )
