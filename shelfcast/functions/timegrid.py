"""Gap-free time grids without joining against a calendar."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def fill_periods(
    df: DataFrame, keys: Sequence[str], period: str, value: str, step: str
) -> DataFrame:
    """Add the missing periods between the first and last one of each key, with value 0.

    Each row is stretched up to the next known period of its key, so no calendar table and no join
    is needed. ``df`` holds one row per key and period, so a window partition is bounded by the
    length of the calendar.
    """
    interval = F.expr(f"interval {step}")
    following = F.lead(period).over(Window.partitionBy(*keys).orderBy(period))
    last = F.coalesce((F.col("_next") - interval).cast("date"), F.col(period))
    return (
        df.withColumn("_next", following)
        .withColumn("_at", F.explode(F.sequence(F.col(period), last, interval)))
        .select(
            *keys,
            F.col("_at").alias(period),
            F.when(F.col("_at") == F.col(period), F.col(value)).otherwise(F.lit(0)).alias(value),
        )
    )


def week_end(day: Column | str) -> Column:
    """The Sunday that closes the week of ``day``."""
    return F.date_add(F.trunc(day, "week"), 6)


def month_start(day: Column | str) -> Column:
    return F.trunc(day, "month")


def latest(df: DataFrame, day: str = "date") -> Column:
    """The last day of ``df`` as a scalar subquery: stays lazy, and reads that one column only."""
    return df.agg(F.max(day)).scalar()


def date_span(df: DataFrame, day: str = "date") -> tuple[Column, Column]:
    """First and last day of ``df``, from one scalar subquery that both columns share."""
    span = df.agg(F.struct(F.min(day).alias("first"), F.max(day).alias("last"))).scalar()
    return span["first"], span["last"]
