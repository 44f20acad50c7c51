"""Time-series aggregates for exploration.

Every operator aggregates the sales to days, weeks or months first; windows and gap filling run on
those totals, whose length is bounded by the calendar.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.functions.timegrid import fill_periods, month_start, week_end


def daily_total(sales: DataFrame) -> DataFrame:
    return sales.groupBy("date").agg(F.sum("quantity").alias("quantity"))


def weekly_total(sales: DataFrame) -> DataFrame:
    """Weeks ending on Sunday; a week without sales counts 0."""
    weeks = sales.groupBy(week_end("date").alias("week_end")).agg(
        F.sum("quantity").alias("quantity")
    )
    return fill_periods(weeks, [], "week_end", "quantity", "7 days")


def monthly_total(sales: DataFrame) -> DataFrame:
    """Months by their first day; a month without sales counts 0."""
    months = sales.groupBy(month_start("date").alias("month_start")).agg(
        F.sum("quantity").alias("quantity")
    )
    return fill_periods(months, [], "month_start", "quantity", "1 month")


def top_n_products(sales: DataFrame, n: int = 8) -> DataFrame:
    return (
        sales.groupBy("product_id")
        .agg(F.sum("quantity").alias("total_units"))
        .orderBy(F.desc("total_units"), "product_id")
        .limit(n)
    )


def top_products_weekly(sales: DataFrame, n: int = 8) -> DataFrame:
    """Weekly series of the top products, each filled between its own first and last week."""
    top = top_n_products(sales, n).select("product_id")
    weeks = (
        sales.join(F.broadcast(top), "product_id", "left_semi")  # at most n rows
        .groupBy("product_id", week_end("date").alias("week_end"))
        .agg(F.sum("quantity").alias("quantity"))
    )
    return fill_periods(weeks, ["product_id"], "week_end", "quantity", "7 days")


def category_weekly(sales: DataFrame) -> DataFrame:
    """Weekly totals by category, for the weeks that occur."""
    return sales.groupBy("category", week_end("date").alias("week_end")).agg(
        F.sum("quantity").alias("quantity")
    )


def weekday_mean(sales: DataFrame) -> DataFrame:
    """Mean quantity by weekday name, Monday first."""
    return (
        sales.groupBy(F.weekday("date").alias("_order"), F.date_format("date", "EEEE").alias("weekday"))
        .agg(F.avg("quantity").alias("avg_quantity"))
        .orderBy("_order")
        .drop("_order")
    )


def month_mean(sales: DataFrame) -> DataFrame:
    return (
        sales.groupBy(F.month("date").alias("month"))
        .agg(F.avg("quantity").alias("avg_quantity"))
        .orderBy("month")
    )


def rolling_outliers(
    sales: DataFrame, window: int = 7, threshold: float = 3.0, include_current: bool = True
) -> DataFrame:
    """Days whose total is far from the product's rolling mean, in rolling standard deviations.

    With the day itself in the window, |z| cannot pass ``(window - 1) / sqrt(window)``, 2.27 for a
    week; ``include_current=False`` compares the day with the ``window`` days before it.
    """
    daily = sales.groupBy("product_id", "date").agg(F.sum("quantity").alias("quantity"))
    days = Window.partitionBy("product_id").orderBy("date")
    frame = days.rowsBetween(1 - window, 0) if include_current else days.rowsBetween(-window, -1)
    return (
        daily.select(
            "product_id",
            "date",
            "quantity",
            F.avg("quantity").over(frame).alias("rolling_mean"),
            F.stddev_samp("quantity").over(frame).alias("rolling_std"),
            F.count("quantity").over(frame).alias("_days"),
        )
        .where(F.col("_days") == window)
        .withColumn(
            "z", F.try_divide(F.col("quantity") - F.col("rolling_mean"), F.col("rolling_std"))
        )
        .where(F.abs("z") > threshold)
        .drop("_days")
    )
