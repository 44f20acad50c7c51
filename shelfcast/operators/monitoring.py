"""Data quality, distribution shift and model performance in one long report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.functions.contracts import require_columns
from shelfcast.functions.metrics import mae, rmse, smape_zero, wape
from shelfcast.functions.numeric import numeric
from shelfcast.operators.cleaning import safe_stat_columns

# Monitored columns, and those that are never negative.
MONITORED = (
    "demand", "price", "discount", "promotion", "holiday", "lag_1", "lag_7", "lag_14", "lag_28",
)
NEVER_NEGATIVE = ("demand", "price", "discount")


def _rows(df: DataFrame, check: str, per_column: dict[str, dict[str, Column]]) -> DataFrame:
    """One aggregate pass, turned into one row per monitored column."""
    packed = df.agg(
        *[
            F.struct(*[c.alias(stat) for stat, c in stats.items()]).alias(name)
            for name, stats in per_column.items()
        ]
    )
    entries = F.array(
        *[F.struct(F.lit(name).alias("metric"), F.col(name).alias("s")) for name in per_column]
    )
    return packed.select(F.explode(entries).alias("e")).select(
        F.lit(check).alias("check_type"), "e.metric", "e.s.*"
    )


def _present(df: DataFrame, columns: Sequence[str]) -> list[str]:
    return [name for name in columns if name in df.columns]


def data_quality_rows(df: DataFrame, columns: Sequence[str] = MONITORED) -> DataFrame:
    """Nulls, negatives (only where a negative is an error) and statistics per column."""
    stats = {
        name: {
            "missing_count": F.count_if(F.col(name).isNull()),
            "negative_count": (
                F.count_if(numeric(name) < 0) if name in NEVER_NEGATIVE else F.count_if(F.lit(False))
            ),
            **safe_stat_columns(name),
        }
        for name in _present(df, columns)
    }
    return _rows(df, "data_quality", stats)


def shift_column(name: str, reference: Column, monitored: Column) -> Column:
    """Distance of the two means in reference deviations.

    Null if a side has no values; 0 if the reference does not vary.
    """
    value = numeric(name)
    old, new = F.when(reference, value), F.when(monitored, value)
    spread = F.stddev_samp(old)
    return F.when((F.count(old) > 0) & (F.count(new) > 0),
        F.when(spread.isNull() | (spread == 0), F.lit(0.0)).otherwise(
            F.try_divide(F.abs(F.avg(new) - F.avg(old)), spread)
        ),
    )


def distribution_shift(
    df: DataFrame, columns: Sequence[str] = MONITORED, flag: str = "is_final_test"
) -> DataFrame:
    reference, monitored = F.col(flag) == 0, F.col(flag) == 1
    stats = {
        name: {"standardized_mean_shift": shift_column(name, reference, monitored)}
        for name in _present(df, columns)
    }
    return _rows(df, "distribution_shift", stats)


def shift_rows(
    df: DataFrame, columns: Sequence[str] = MONITORED, flag: str = "is_final_test"
) -> DataFrame:
    """Shift of each column together with nulls, negatives and statistics of the monitored rows."""
    reference, monitored = F.col(flag) == 0, F.col(flag) == 1
    stats = {
        name: {
            "missing_count": F.count_if(monitored & F.col(name).isNull()),
            "negative_count": F.count_if(monitored & (numeric(name) < 0)),
            **safe_stat_columns(name, monitored),
            "standardized_mean_shift": shift_column(name, reference, monitored),
        }
        for name in _present(df, columns)
    }
    return _rows(df, "distribution_shift", stats)


def model_performance(predictions: DataFrame) -> DataFrame:
    """Accuracy and prediction range per model."""
    return predictions.groupBy(F.col("model").alias("metric")).agg(
        F.count_if(F.col("prediction").isNull()).alias("missing_count"),
        F.count_if(F.col("prediction") < 0).alias("negative_count"),
        F.avg("prediction").alias("mean"),
        F.stddev_pop("prediction").alias("std"),
        F.min("prediction").alias("min"),
        F.max("prediction").alias("max"),
        mae("demand", "prediction").alias("mae"),
        rmse("demand", "prediction").alias("rmse"),
        smape_zero("demand", "prediction").alias("smape_pct"),
        wape("demand", "prediction").alias("wape_pct"),
    ).select(F.lit("model_performance").alias("check_type"), "*")


def monitoring_report(
    benchmark: DataFrame, predictions: DataFrame, columns: Sequence[str] = MONITORED
) -> DataFrame:
    """The three checks stacked; a check has nulls where it has no such figure."""
    require_columns(benchmark, ("id", "date", "demand", "is_final_test"), "benchmark columns")
    require_columns(
        predictions, ("id", "date", "demand", "prediction", "model"), "prediction columns"
    )
    return (
        data_quality_rows(benchmark, columns)
        .unionByName(shift_rows(benchmark, columns), allowMissingColumns=True)
        .unionByName(model_performance(predictions), allowMissingColumns=True)
    )


def monitoring_summary(benchmark: DataFrame, predictions: DataFrame) -> DataFrame:
    """Row counts, holdout rows, missing and negative predictions, in one row."""
    rows = benchmark.agg(
        F.struct(F.count("*").alias("rows"), F.sum("is_final_test").alias("holdout"))
    ).scalar()
    return predictions.agg(
        F.count("*").alias("prediction_rows"),
        F.count_if(F.col("prediction").isNull()).alias("missing_predictions"),
        F.count_if(F.col("prediction") < 0).alias("negative_predictions"),
    ).select(
        rows["rows"].alias("benchmark_rows"), rows["holdout"].alias("final_test_rows"), "*"
    )


# The labels of the summary text.
SUMMARY_LABELS = {
    "benchmark_rows": "Benchmark rows",
    "final_test_rows": "Final-test rows",
    "prediction_rows": "Prediction rows",
    "missing_predictions": "Missing predictions",
    "negative_predictions": "Negative predictions",
}


def monitoring_summary_text(summary: DataFrame) -> DataFrame:
    """The summary as lines of text, one row per line, ready for ``df.write.text``."""
    counts = summary.unpivot([], list(SUMMARY_LABELS), "name", "n")
    label = F.create_map(*[F.lit(x) for pair in SUMMARY_LABELS.items() for x in pair])
    return counts.select(F.concat_ws(": ", label[F.col("name")], "n").alias("value"))
