"""Prediction intervals from the errors of past validation windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.functions.numeric import numeric
from shelfcast.functions.ordered import grouped_quantiles

CONFIDENCE_LEVEL = 0.90


def residual_quantile(
    residuals: DataFrame, column: str = "error", level: float = CONFIDENCE_LEVEL, check: bool = True
) -> DataFrame:
    """The ``level`` quantile of the absolute finite residuals, as a one-row table."""
    sizes = residuals.select(F.abs(numeric(column)).alias("residual")).where("residual IS NOT NULL")
    if check and sizes.isEmpty():
        raise ValueError("No finite residual to take a quantile of.")
    return grouped_quantiles(sizes, [], "residual", {"residual_quantile": level})


def interval_width(cv_results: DataFrame) -> DataFrame:
    """The largest validation RMSE of each model."""
    return cv_results.groupBy("model").agg(F.max("rmse").alias("interval_width"))


def prediction_intervals(predictions: DataFrame, widths: DataFrame) -> DataFrame:
    """Bounds around each prediction, never below 0, and whether they cover the demand.

    ``widths`` has one row per model and is looked up: a join on a few models would put most predictions
    into a few tasks. A prediction whose model has no width raises when the rows are computed.
    """
    known = widths.agg(F.map_from_entries(F.collect_list(F.struct("model", "interval_width")))).scalar()
    lacking = F.raise_error(F.concat(F.lit("No interval width for model "), F.coalesce("model", F.lit("null"))))
    width = F.coalesce(F.try_element_at(known, F.col("model")), lacking.cast("double"))
    lower = F.greatest(F.col("prediction") - F.col("interval_width"), F.lit(0.0))
    upper = F.col("prediction") + F.col("interval_width")
    return predictions.withColumn("interval_width", width).withColumns(
        {
            "prediction_lower": lower,
            "prediction_upper": upper,
            "interval_covered": F.col("demand").between(lower, upper),
        }
    )


def require_widths(predictions: DataFrame, widths: DataFrame) -> None:
    """Raise unless predictions and validation results cover the same models."""
    used, known = predictions.select("model").distinct(), widths.select("model").distinct()
    for left, right in ((used, known), (known, used)):
        lone = left.join(right, "model", "left_anti").orderBy("model").first()
        if lone is not None:
            raise ValueError(f"Model without results on both sides: {lone['model']}")


def coverage_columns(actual: str = "demand") -> list[Column]:
    return [
        (F.avg(F.col("interval_covered").cast("double")) * 100).alias("coverage_pct"),
        F.avg(F.col("prediction_upper") - F.col("prediction_lower")).alias("mean_interval_width"),
        F.avg(F.abs(F.col(actual) - F.col("prediction"))).alias("mean_absolute_error"),
        F.count("*").alias("n_observations"),
    ]


def interval_metrics(intervals: DataFrame, level: float = CONFIDENCE_LEVEL) -> DataFrame:
    """Coverage, mean width after clipping, MAE and row count per model."""
    return intervals.groupBy("model").agg(
        F.lit(level * 100).alias("confidence_level_pct"),
        F.max("interval_width").alias("interval_width"),
        *coverage_columns(),
    )
