"""Forecasting models, scoring, cross-validation and model comparison."""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfcast.functions.contracts import require_columns
from shelfcast.functions.metrics import evaluate, mae
from shelfcast.functions.numeric import fixed
from shelfcast.operators.ensembles import Ensemble, fit_boosting, fit_forest
from shelfcast.operators.errors import error_columns
from shelfcast.operators.linear import LinearModel, fit_ridge
from shelfcast.operators.panel import FEATURE_COLUMNS, TARGET
from shelfcast.operators.splits import Fold, holdout_frames, time_series_folds

SEED = 42
IMPORTANCE_ROWS = 5000
NAIVE = "Seasonal Naive"
RIDGE = "Ridge Regression"
FOREST = "Random Forest"
BOOSTING = "Gradient Boosting"
ROW_KEY = ("product_id", "category", "date")

Model = PipelineModel | Ensemble | LinearModel
Fitter = Callable[[DataFrame], Model]


def seasonal_naive(
    df: DataFrame,
    target: str = TARGET,
    group: str = "product_id",
    season: int = 7,
    order: str = "date",
) -> DataFrame:
    """Predict the value ``season`` rows earlier in the same group."""
    days = Window.partitionBy(group).orderBy(order)
    return df.withColumn("prediction", F.lag(target, season).over(days))


def _assembler(columns: Sequence[str], invalid: str = "error") -> VectorAssembler:
    return VectorAssembler(inputCols=list(columns), outputCol="features", handleInvalid=invalid)


@dataclass(frozen=True)
class RidgeFitter:
    """Fits one ridge model, or with ``fit_steps`` the models of all folds from one scan."""

    alpha: float = 1.0
    columns: Sequence[str] = tuple(FEATURE_COLUMNS)
    label: str = TARGET
    scaled: bool = True

    def __call__(self, train: DataFrame) -> LinearModel:
        return fit_ridge(train, self.columns, self.label, self.alpha, self.scaled)[0]

    def fit_steps(self, df: DataFrame, step: Column, steps: Sequence[int]) -> list[LinearModel]:
        """For every entry k of ``steps`` a model of the rows whose ``step`` is at most k."""
        return fit_ridge(df, self.columns, self.label, self.alpha, self.scaled, step, steps)


def ridge_fitter(
    alpha: float = 1.0, columns: Sequence[str] = FEATURE_COLUMNS, label: str = TARGET,
    scaled: bool = True,
) -> RidgeFitter:
    """Least squares with penalty ``alpha``, on standardised features unless ``scaled`` is off."""
    return RidgeFitter(alpha, tuple(columns), label, scaled)


def forest_fitter(
    trees: int = 300, columns: Sequence[str] = FEATURE_COLUMNS, label: str = TARGET
) -> Fitter:
    """Bagged trees of depth 10 with at least five rows a leaf."""
    return lambda train: fit_forest(train, columns, label, trees)


@dataclass(frozen=True)
class BoostingFitter:
    """Fits one boosted model, or with ``fit_steps`` the models of all folds in the same scans."""

    rounds: int = 400
    columns: Sequence[str] = tuple(FEATURE_COLUMNS)
    label: str = TARGET
    rate: float = 0.05

    def __call__(self, train: DataFrame) -> Ensemble:
        return fit_boosting(train, self.columns, self.label, rounds=self.rounds, rate=self.rate)[0]

    def fit_steps(self, df: DataFrame, step: Column, steps: Sequence[int]) -> list[Ensemble]:
        """For every entry k of ``steps`` a model of the rows whose ``step`` is at most k."""
        return fit_boosting(df, self.columns, self.label, step, steps, self.rounds, self.rate)


def boosting_fitter(
    rounds: int = 400, columns: Sequence[str] = FEATURE_COLUMNS, label: str = TARGET, rate: float = 0.05
) -> BoostingFitter:
    return BoostingFitter(rounds, tuple(columns), label, rate)


def build_models(trees: int = 300, rounds: int = 400) -> dict[str, Fitter]:
    """The three trained models by name."""
    return {
        RIDGE: ridge_fitter(),
        FOREST: forest_fitter(trees),
        BOOSTING: boosting_fitter(rounds),
    }


def predict_demand(df: DataFrame, model: Model) -> DataFrame:
    """Add ``prediction``, never below 0.

    A missing feature column raises. A missing value is scored by tree models; ridge has no prediction
    for it, which is null then.
    """
    require_columns(df, FEATURE_COLUMNS, "features")
    demand = F.when(F.col("prediction").isNotNull() & ~F.isnan("prediction"), F.greatest("prediction", F.lit(0.0)))
    return model.transform(df).withColumn("prediction", demand).select(
        *df.columns, "prediction"
    )


def train_production(
    features: DataFrame, path: str | None = None, days: int = 60, rounds: int = 400
) -> Ensemble:
    """Fit the boosting model on the rows before the holdout, and save it when a path is given."""
    development, _ = holdout_frames(features, days)
    model = boosting_fitter(rounds)(development)
    if path:
        save_model(features.sparkSession, model, path)
    return model


def save_model(spark: SparkSession, model: Model, path: str) -> str:
    """Trees become a table of nodes, a ridge model one of weights, a pipeline its own folder."""
    if isinstance(model, Ensemble | LinearModel):
        model.save(spark, path)
    else:
        model.write().overwrite().save(path)
    return path


def load_model(spark: SparkSession, path: str) -> Model:
    """Load a saved model; ``FileNotFoundError`` if there is none."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(target):
        raise FileNotFoundError(f"No saved model at {path}")
    stages = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/stages")
    if files.exists(stages):
        return PipelineModel.load(path)
    return (LinearModel if "weight" in spark.read.parquet(path).columns else Ensemble).load(spark, path)


def model_info(spark: SparkSession, model: Model) -> DataFrame:
    """Type, feature count and feature names of a fitted model, in one row."""
    own = isinstance(model, Ensemble | LinearModel)
    names = model.columns if own else model.stages[0].getInputCols()
    return spark.range(1).select(
        F.lit(model.kind if own else type(model.stages[-1]).__name__).alias("model_type"),
        F.lit(len(names)).alias("feature_count"),
        F.array(*[F.lit(n) for n in names]).alias("features"),
    )


def batch_score(features: DataFrame, model: Model) -> DataFrame:
    """Predictions for every row, with error = actual - prediction."""
    errors = error_columns(TARGET, "prediction")
    return predict_demand(features, model).select(
        "date",
        "product_id",
        "category",
        TARGET,
        "prediction",
        errors["error"].alias("error"),
        errors["absolute_error"].alias("absolute_error"),
    )


def batch_score_summary(scored: DataFrame) -> DataFrame:
    """Rows, products, date range and prediction range; products are combined before counting."""
    per_product = scored.groupBy("product_id").agg(
        F.count("*").alias("n"),
        F.min("date").alias("first"),
        F.max("date").alias("last"),
        F.min("prediction").alias("low"),
        F.max("prediction").alias("high"),
        F.sum("prediction").alias("total"),
        F.count_if(F.col("prediction") < 0).alias("negative"),
    )
    return per_product.agg(
        F.sum("n").alias("n_rows"),
        F.count("product_id").alias("products"),
        F.min("first").alias("min_date"),
        F.max("last").alias("max_date"),
        F.min("low").alias("prediction_min"),
        F.max("high").alias("prediction_max"),
        F.try_divide(F.sum("total"), F.sum("n")).alias("prediction_mean"),
        F.sum("negative").alias("negative_predictions"),
    )


def _in_parallel(spark: SparkSession, tasks: Sequence[Callable], parallelism: int) -> list:
    """Run driver-side steps that each start Spark jobs, a few at a time, keeping their order."""
    if parallelism <= 1 or len(tasks) <= 1:
        return [task() for task in tasks]
    with ThreadPool(min(parallelism, len(tasks))) as pool:
        return pool.map(lambda task: inheritable_thread_target(spark)(task)(), tasks)


def cross_validate(
    development: DataFrame,
    models: Mapping[str, Fitter] | None = None,
    n_folds: int = 4,
    days: int = 60,
    parallelism: int = 4,
) -> DataFrame:
    """Out-of-fold predictions of the naive and every trained model, in long form.

    ``development`` must exclude the holdout. It is read once per fit, so give it as a written
    table. Only the fold bounds and the fitted models reach the driver; scoring stays lazy. A fitter with
    ``fit_steps`` fits the models of all folds in the same scans.
    """
    folds = time_series_folds(development, n_folds, days)
    fitters = dict(build_models() if models is None else models)
    together = {
        name: dict(zip(folds, fitter.fit_steps(development, fold_step(folds), range(1, n_folds + 1)), strict=True))
        for name, fitter in fitters.items() if hasattr(fitter, "fit_steps")
    }

    def scored(fold: Fold, name: str) -> DataFrame:
        validation = fold.test(development)
        if name == NAIVE:
            predicted = validation.withColumn("prediction", F.col("lag_7"))
        else:
            model = together[name][fold] if name in together else fitters[name](fold.train(development))
            predicted = predict_demand(validation, model)
        return predicted.select(
            *ROW_KEY, TARGET, "prediction", F.lit(fold.fold).alias("fold"), F.lit(name).alias("model")
        )

    tasks = [
        (lambda fold=fold, name=name: scored(fold, name))
        for fold in folds
        for name in [NAIVE, *fitters]
    ]
    return reduce(DataFrame.unionByName, _in_parallel(development.sparkSession, tasks, parallelism))


def fold_step(folds: Sequence[Fold], day: str = "date") -> Column:
    """The first of the expanding folds, oldest first and from 1, that a row trains; one more than all for later rows."""
    return reduce(lambda step, fold: step + (F.col(day) > F.lit(fold.train_end)).cast("int"), folds, F.lit(1))


def oof_predictions(predictions: DataFrame, model: str = BOOSTING) -> DataFrame:
    """One model's out-of-fold rows with error = actual - prediction."""
    errors = error_columns(TARGET, "prediction")
    return predictions.where(F.col("model") == model).select(
        *ROW_KEY,
        TARGET,
        "prediction",
        errors["error"].alias("error"),
        errors["absolute_error"].alias("abs_error"),
        "fold",
    )


def cv_results(predictions: DataFrame, rounded: bool = True) -> DataFrame:
    """MAE, RMSE and sMAPE per fold and model, all in one aggregation."""
    return evaluate(predictions, ["fold", "model"], rounded=rounded)


def cv_summary(results: DataFrame) -> DataFrame:
    """Mean and sample deviation over the folds per model, best mean MAE first."""
    stats = []
    for metric in ("mae", "rmse", "smape_pct"):
        stats.append(F.avg(metric).alias(f"{metric}_mean"))
        stats.append(F.stddev_samp(metric).alias(f"{metric}_std"))
    return results.groupBy("model").agg(*stats).orderBy("mae_mean", "model")


def best_model(summary: DataFrame) -> DataFrame:
    """The model with the lowest mean MAE."""
    return summary.orderBy("mae_mean", "model").limit(1)


def final_test(
    features: DataFrame,
    fitter: Fitter | None = None,
    days: int = 60,
    signed: str = "actual_minus_prediction",
) -> DataFrame:
    """Fit on the development rows and score the holdout once."""
    development, holdout = holdout_frames(features, days)
    scored = predict_demand(holdout, (fitter or boosting_fitter())(development))
    error = F.col(TARGET) - F.col("prediction")
    if signed == "prediction_minus_actual":
        error = -error
    elif signed != "actual_minus_prediction":
        raise ValueError(f"Unknown error sign: {signed}")
    return scored.select(*ROW_KEY, TARGET, "prediction", error.alias("error")).withColumn(
        "abs_error", F.abs("error")
    )


def final_test_metrics(scored: DataFrame, model: str = BOOSTING) -> DataFrame:
    extra = [
        F.min("date").alias("test_start"),
        F.max("date").alias("test_end"),
        F.count("*").alias("test_rows"),
    ]
    return evaluate(scored, extra=extra).select(F.lit(model).alias("model"), "*")


def holdout_predictions(
    features: DataFrame, models: Mapping[str, Fitter] | None = None, days: int = 60,
    parallelism: int = 4,
) -> DataFrame:
    """Holdout predictions of the naive and every trained model, in long form."""
    development, holdout = holdout_frames(features, days)
    fitters = dict(build_models() if models is None else models)

    def scored(name: str) -> DataFrame:
        if name == NAIVE:
            predicted = holdout.withColumn("prediction", F.col("lag_7"))
        else:
            predicted = predict_demand(holdout, fitters[name](development))
        return predicted.select(*ROW_KEY, TARGET, "prediction", F.lit(name).alias("model"))

    tasks = [(lambda name=name: scored(name)) for name in [NAIVE, *fitters]]
    return reduce(DataFrame.unionByName, _in_parallel(features.sparkSession, tasks, parallelism))


def compare_models(predictions: DataFrame) -> DataFrame:
    """Metrics per model, best MAE first."""
    return evaluate(predictions, ["model"]).orderBy("mae", "model")


def predictions_side_by_side(predictions: DataFrame, models: Sequence[str]) -> DataFrame:
    """One row per product and day with one ``pred_<model>`` column per model."""

    def column(name: str) -> Column:
        label = "pred_" + name.lower().replace(" ", "_")
        return F.max(F.when(F.col("model") == name, F.col("prediction"))).alias(label)

    return predictions.groupBy("product_id", "date", TARGET).agg(*[column(m) for m in models])


def permutation_importance(
    holdout: DataFrame,
    model: Model,
    columns: Sequence[str] = FEATURE_COLUMNS,
    repeats: int = 5,
    seed: int = SEED,
    groups: int | None = None,
) -> DataFrame:
    """Mean rise of the MAE when one feature is shuffled.

    The rows are dealt at random into even groups, by default of about ``IMPORTANCE_ROWS``: large enough
    to shuffle well, small enough for one task, at any size of the table. Within a group, in a random order per
    repeat, each row takes a feature value from the next row (the last from the first), which is a
    random permutation of the group, so no global row number and no join back is needed. One
    shuffle serves all features and repeats; each row is then scored once per feature.
    """
    if groups is None:
        groups = max(1, math.ceil(holdout.count() / IMPORTANCE_ROWS))
    dealt = holdout.select("product_id", "date", TARGET, *columns).withColumn(
        "_group",
        F.pmod(F.xxhash64("product_id", "date", F.lit(seed)), F.lit(groups)),
    )
    variants = []
    for repeat in range(repeats):
        deal = Window.partitionBy("_group").orderBy(
            F.xxhash64("product_id", "date", F.lit(seed + 1 + repeat))
        )
        whole = deal.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        moved = [
            F.coalesce(F.lead(c).over(deal), F.first(c).over(whole)).cast("double").alias(f"_{c}")
            for c in columns
        ]
        shuffled = dealt.select(TARGET, *columns, *moved)
        choices = F.explode(F.array(*[F.lit(c) for c in columns])).alias("feature")
        swapped = shuffled.select("*", choices).select(
            TARGET,
            "feature",
            *[
                F.when(F.col("feature") == c, F.col(f"_{c}")).otherwise(F.col(c)).alias(c)
                for c in columns
            ],
        )
        variants.append(
            predict_demand(swapped, model)
            .groupBy("feature")
            .agg(mae(TARGET, "prediction").alias("mae"))
        )
    base = predict_demand(holdout, model).agg(mae(TARGET, "prediction")).scalar()
    return (
        reduce(DataFrame.unionByName, variants)
        .groupBy("feature")
        .agg(F.avg("mae").alias("shuffled_mae"))
        .select("feature", (F.col("shuffled_mae") - base).alias("importance"))
        .orderBy(F.desc("importance"), "feature")
    )


# Allowed ranges of a scoring request, None meaning no bound.
REQUEST_RANGES: dict[str, tuple[float | None, float | None]] = {
    "price": (0, None),
    "promotion": (0, 1),
    "discount": (0, None),
    "holiday": (0, 1),
    "day_of_week": (0, 6),
    "month": (1, 12),
    "week_of_year": (1, 53),
    "is_weekend": (0, 1),
}
WHOLE_NUMBERS = ("promotion", "holiday", "day_of_week", "month", "week_of_year", "is_weekend")


def validate_requests(requests: DataFrame) -> DataFrame:
    """Add ``failed_rules``, the names of the rules a request breaks; empty means accepted.

    Plain column expressions, so a streaming table works as well.
    """
    broken = []
    for name in ("product_id", "category", *FEATURE_COLUMNS):
        value = F.col(name) if name in requests.columns else F.lit(None)
        broken.append(F.when(value.isNull(), F.lit(f"{name} missing")))
    for name, (low, high) in REQUEST_RANGES.items():
        if name not in requests.columns:
            continue
        if low is not None:
            broken.append(F.when(F.col(name) < low, F.lit(f"{name} below {low}")))
        if high is not None:
            broken.append(F.when(F.col(name) > high, F.lit(f"{name} above {high}")))
        if name in WHOLE_NUMBERS:
            broken.append(F.when(F.col(name) % 1 != 0, F.lit(f"{name} not whole")))
    return requests.withColumn("failed_rules", F.array_compact(F.array(*broken)))


def accepted(validated: DataFrame) -> DataFrame:
    return validated.where(F.size("failed_rules") == 0).drop("failed_rules")


def rejected(validated: DataFrame) -> DataFrame:
    return validated.where(F.size("failed_rules") > 0)


def score_requests(requests: DataFrame, model: Model) -> DataFrame:
    """Predicted demand, to four places, for every request that passes the rules."""
    scored = predict_demand(accepted(validate_requests(requests)), model)
    keep = [c for c in ("request_id",) if c in requests.columns]
    return scored.select(
        *keep, "product_id", "category", fixed("prediction", 4).alias("predicted_demand")
    )
