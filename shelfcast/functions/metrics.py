"""Forecast accuracy metrics as aggregate column expressions.

Every function takes the actual and predicted columns and returns an aggregate, so several of them
share one pass and any grouping: ``df.groupBy(keys).agg(mae(y, p), rmse(y, p))``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.functions.numeric import fixed, ratio


def _gap(actual: str, predicted: str) -> Column:
    return F.abs(F.col(predicted) - F.col(actual))


def mae(actual: str, predicted: str) -> Column:
    return F.avg(_gap(actual, predicted))


def rmse(actual: str, predicted: str) -> Column:
    gap = _gap(actual, predicted)
    return F.sqrt(F.avg(gap * gap))


def smape_eps(actual: str, predicted: str, eps: float = 1.0) -> Column:
    """Symmetric percentage error with a floor in the denominator, so days near zero stay finite."""
    scale = F.abs(F.col(actual)) + F.abs(F.col(predicted)) + F.lit(eps)
    return F.avg(2 * _gap(actual, predicted) / scale) * 100


def smape_zero(actual: str, predicted: str) -> Column:
    """Symmetric percentage error; a row where both values are 0 counts as no error."""
    scale = F.abs(F.col(actual)) + F.abs(F.col(predicted))
    share = F.when(scale == 0, F.lit(0.0)).otherwise(
        F.try_divide(2 * _gap(actual, predicted), scale)
    )
    return F.avg(share) * 100


def wape(actual: str, predicted: str) -> Column:
    """Total absolute error over total absolute demand; null when there is no demand."""
    return ratio(F.sum(_gap(actual, predicted)), F.sum(F.abs(F.col(actual)))) * 100


def evaluate(
    df: DataFrame,
    keys: Sequence[str] = (),
    actual: str = "quantity",
    predicted: str = "prediction",
    extra: Sequence[Column] = (),
    rounded: bool = True,
) -> DataFrame:
    """MAE, RMSE and the eps form of sMAPE per group; report rounding is 3, 3 and 2 places."""
    columns = {
        "mae": (mae(actual, predicted), 3),
        "rmse": (rmse(actual, predicted), 3),
        "smape_pct": (smape_eps(actual, predicted), 2),
    }
    aggregates = [
        (fixed(column, places) if rounded else column).alias(name)
        for name, (column, places) in columns.items()
    ]
    present = df
    for key in keys:
        present = present.where(F.col(key).isNotNull())
    return present.groupBy(*keys).agg(*aggregates, *extra)


def evaluate_benchmark(
    df: DataFrame,
    keys: Sequence[str] = (),
    actual: str = "demand",
    predicted: str = "prediction",
) -> DataFrame:
    """MAE, RMSE, the zero-safe sMAPE and WAPE per group, pooled over all series."""
    return df.groupBy(*keys).agg(
        mae(actual, predicted).alias("mae"),
        rmse(actual, predicted).alias("rmse"),
        smape_zero(actual, predicted).alias("smape_pct"),
        wape(actual, predicted).alias("wape_pct"),
    )
