"""Forecast error and demand driver analysis."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.functions.contracts import require_columns
from shelfcast.functions.metrics import evaluate
from shelfcast.functions.numeric import ratio
from shelfcast.functions.ordered import grouped_quantiles

PREDICTION_COLUMNS = ("date", "product_id", "quantity", "prediction")
# Conditions, drivers and segments of the published reports.
CONDITIONS = ("promotion", "holiday", "is_weekend")
DRIVERS = ("price", "promotion", "discount", "holiday", "day_of_week", "month", "is_weekend")
SEGMENTS = ("promotion", "holiday", "category")


def error_columns(actual: str = "quantity", predicted: str = "prediction") -> dict[str, Column]:
    """Errors as actual minus prediction: positive where the forecast was too low."""
    error = F.col(actual) - F.col(predicted)
    return {"error": error, "absolute_error": F.abs(error), "squared_error": error * error}


def error_frame(features: DataFrame, predictions: DataFrame) -> DataFrame:
    """Predictions with their errors and the features of the same product and day."""
    require_columns(predictions, PREDICTION_COLUMNS, "prediction columns")
    errors = predictions.select(
        "date",
        "product_id",
        F.col("quantity").alias("y_true"),
        F.col("prediction").alias("y_pred"),
    ).withColumns(error_columns("y_true", "y_pred"))
    return errors.join(features, ["date", "product_id"], "left")


def _error_aggregates() -> list[Column]:
    return [
        F.count("absolute_error").alias("observations"),
        F.avg("absolute_error").alias("mae"),
        F.avg("error").alias("bias"),
        F.sqrt(F.avg("squared_error")).alias("rmse"),
    ]


def error_by_product(errors: DataFrame) -> DataFrame:
    """A product has one row per day of the holdout, so its exact percentiles need little memory."""
    tails = F.percentile("absolute_error", F.array(F.lit(0.9), F.lit(0.95)))
    return (
        errors.where(F.col("product_id").isNotNull())
        .groupBy("product_id")
        .agg(*_error_aggregates(), tails.alias("_tails"))
        .withColumns(
            {
                "p90_absolute_error": F.col("_tails")[0],
                "p95_absolute_error": F.col("_tails")[1],
            }
        )
        .drop("_tails")
    )


def error_by_category(errors: DataFrame) -> DataFrame:
    """A category can hold most of the rows, so its percentiles are ranked in ranges."""
    summary = errors.where(F.col("category").isNotNull()).groupBy("category").agg(
        *_error_aggregates()
    )
    tails = grouped_quantiles(
        errors,
        ["category"],
        "absolute_error",
        {"p90_absolute_error": 0.9, "p95_absolute_error": 0.95},
    )
    return summary.join(tails, "category", "left")


def _stacked(
    df: DataFrame, columns: Sequence[str], name: str, aggregates: Sequence[Column]
) -> DataFrame:
    """Group by each column in turn in one pass; null keys drop out, values become text."""
    sets = [[F.col(c)] for c in columns]
    grouped = df.groupingSets(sets, *columns).agg(
        F.grouping_id().alias("_set"), *aggregates
    )
    width = len(columns)
    pick_name = F.lit(None).cast("string")
    pick_value = F.lit(None).cast("string")
    for i, column in enumerate(columns):
        mine = F.col("_set") == (1 << width) - 1 - (1 << (width - 1 - i))
        pick_name = F.when(mine, F.lit(column)).otherwise(pick_name)
        pick_value = F.when(mine, F.col(column).cast("string")).otherwise(pick_value)
    return (
        grouped.withColumns({name: pick_name, f"{name}_value": pick_value})
        .where(F.col(f"{name}_value").isNotNull())
        .drop("_set", *columns)
    )


def error_by_condition(errors: DataFrame) -> DataFrame:
    """Error by promotion, holiday and weekend, stacked; absent columns are skipped."""
    columns = [c for c in CONDITIONS if c in errors.columns]
    aggregates = [
        F.avg("absolute_error").alias("mae"),
        F.avg("error").alias("bias"),
        F.count("absolute_error").alias("observations"),
    ]
    if not columns:
        return _empty(errors, "condition string, condition_value string, mae double, bias double, observations bigint")
    return _stacked(
        errors.select(*columns, "absolute_error", "error"), columns, "condition", aggregates
    ).select("condition", "condition_value", "mae", "bias", "observations")


def driver_segments(df: DataFrame) -> DataFrame:
    """Mean, total and count of the demand by promotion, holiday and category, stacked."""
    columns = [c for c in SEGMENTS if c in df.columns]
    aggregates = [
        F.avg("quantity").alias("avg_demand"),
        F.coalesce(F.sum("quantity"), F.lit(0)).alias("total_units"),
        F.count("quantity").alias("observations"),
    ]
    if not columns:
        return _empty(df, "segment string, segment_value string, avg_demand double, total_units double, observations bigint")
    return _stacked(df.select(*columns, "quantity"), columns, "segment", aggregates).select(
        "segment", "segment_value", "avg_demand", "total_units", "observations"
    )


def _empty(df: DataFrame, schema: str) -> DataFrame:
    return df.sparkSession.createDataFrame([], schema)


def metrics_by_category(predictions: DataFrame) -> DataFrame:
    return evaluate(predictions, ["category"])


def metrics_by_weekday(predictions: DataFrame) -> DataFrame:
    """Metrics by weekday name, Monday first."""
    named = predictions.withColumns(
        {"weekday": F.date_format("date", "EEEE"), "_order": F.weekday("date")}
    )
    return evaluate(named, ["weekday", "_order"]).orderBy("_order").drop("_order")


def metrics_by_promotion(predictions: DataFrame) -> DataFrame:
    label = F.when(F.col("promotion") == 0, "no promotion").when(
        F.col("promotion") == 1, "promotion active"
    )
    return evaluate(predictions.withColumn("promotion", label), ["promotion"])


def metrics_by_tercile(predictions: DataFrame) -> DataFrame:
    """Metrics for low, medium and high demand, cut at the exact thirds, upper edge included."""
    cuts = grouped_quantiles(predictions, [], "quantity", {"t1": 1 / 3, "t2": 2 / 3})
    edges = cuts.select(F.struct("t1", "t2")).scalar()
    level = (
        F.when(F.col("quantity") <= F.col("_edges.t1"), "low")
        .when(F.col("quantity") <= F.col("_edges.t2"), "medium")
        .when(F.col("quantity") > F.col("_edges.t2"), "high")
    )
    leveled = predictions.withColumn("_edges", edges).withColumn("demand_tercile", level)
    return evaluate(leveled, ["demand_tercile"])


def metrics_by_product(predictions: DataFrame) -> DataFrame:
    """Metrics and average demand per product."""
    return evaluate(predictions, ["product_id"], extra=[F.avg("quantity").alias("avg_demand")])


def driver_correlations(df: DataFrame, drivers: Sequence[str] = DRIVERS) -> DataFrame:
    """Pearson correlation of the quantity with each driver, strongest first.

    All pairs are aggregated in one pass over the rows where both values are known; a constant
    column has no correlation.
    """
    present = [name for name in drivers if name in df.columns]

    def correlation(name: str) -> Column:
        both = F.col("quantity").isNotNull() & F.col(name).isNotNull()
        x = F.when(both, F.col("quantity").cast("double"))
        y = F.when(both, F.col(name).cast("double"))
        return ratio(F.covar_samp(x, y), F.stddev_samp(x) * F.stddev_samp(y)).alias(name)

    name = "pearson_correlation_with_demand"
    if not present:
        return _empty(df, f"variable string, {name} double, absolute_correlation double")
    return (
        df.agg(*[correlation(c) for c in present])
        .unpivot([], present, "variable", name)
        .withColumn("absolute_correlation", F.abs(name))
        .orderBy(F.desc_nulls_last("absolute_correlation"), "variable")
    )
