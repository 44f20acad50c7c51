"""The eleven sales questions, as DataFrame queries over ``sales`` and the daily panel.

Top-k queries break ties by product so that the result is the same on every run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.functions.numeric import fixed, ratio
from shelfcast.functions.ordered import ranked_values
from shelfcast.functions.sharing import tied
from shelfcast.functions.timegrid import latest


def _units() -> Column:
    return F.sum("quantity").alias("total_units")


def _revenue() -> Column:
    return fixed(F.sum(F.col("quantity") * F.col("price")), 2).alias("total_revenue")


def _month() -> Column:
    return F.date_format("date", "yyyy-MM").alias("year_month")


def _growth(current: str, previous: str) -> Column:
    change = 100.0 * (F.col(current) - F.col(previous))
    return fixed(ratio(change, F.col(previous)), 2).alias("mom_growth_pct")


def monthly_sales(sales: DataFrame) -> DataFrame:
    return sales.groupBy(_month()).agg(_units(), _revenue()).orderBy("year_month")


def top_products(sales: DataFrame, n: int = 10) -> DataFrame:
    return (
        sales.groupBy("product_id", "category")
        .agg(_units(), _revenue())
        .orderBy(F.desc("total_units"), "product_id")
        .limit(n)
    )


def top_categories(sales: DataFrame) -> DataFrame:
    """Products are rolled up to categories, so a large category is combined before its shuffle."""
    per_product = sales.groupBy("category", "product_id").agg(
        F.sum("quantity").alias("units"), F.sum(F.col("quantity") * F.col("price")).alias("revenue")
    )
    return (
        per_product.groupBy("category")
        .agg(
            F.sum("units").alias("total_units"),
            fixed(F.sum("revenue"), 2).alias("total_revenue"),
            F.count("product_id").alias("n_products"),
        )
        .orderBy(F.desc("total_revenue"))
    )


def demand_variance(sales: DataFrame, n: int = 10) -> DataFrame:
    """Population variance of the quantity per product, by the numerically stable aggregate."""
    return (
        sales.groupBy("product_id", "category")
        .agg(
            fixed(F.avg("quantity"), 2).alias("avg_daily_units"),
            fixed(F.var_pop("quantity"), 2).alias("variance_daily_units"),
        )
        .orderBy(F.desc("variance_daily_units"), "product_id")
        .limit(n)
    )


def average_daily_demand(sales: DataFrame, n: int = 15) -> DataFrame:
    return (
        sales.groupBy("product_id", "category")
        .agg(
            fixed(F.avg("quantity"), 2).alias("avg_daily_units"),
            F.min("quantity").alias("min_daily_units"),
            F.max("quantity").alias("max_daily_units"),
        )
        .orderBy(F.desc("avg_daily_units"), "product_id")
        .limit(n)
    )


def monthly_growth(sales: DataFrame) -> DataFrame:
    """The window has no partition, but it runs on one row per calendar month."""
    monthly = sales.groupBy(_month()).agg(_units())
    previous = F.lag("total_units").over(Window.orderBy("year_month"))
    return (
        monthly.withColumn("prev_month_units", previous)
        .withColumn("mom_growth_pct", _growth("total_units", "prev_month_units"))
        .orderBy("year_month")
    )


def weekday_demand(sales: DataFrame) -> DataFrame:
    """Average and total by weekday, Sunday = 0."""
    return (
        sales.groupBy(
            F.date_format("date", "EEEE").alias("weekday"),
            (F.dayofweek("date") - 1).alias("weekday_num"),
        )
        .agg(fixed(F.avg("quantity"), 2).alias("avg_units"), _units())
        .orderBy("weekday_num")
    )


def declining_products(
    sales: DataFrame, n: int = 10, days: int = 90, strict: bool = False
) -> DataFrame:
    """The largest percentage drops of the recent window against the one before it.

    Both windows are averaged in one pass over the last ``2 * days`` days; products seen in only
    one of them drop out. By default the boundary day counts as recent, which gives a recent window
    of ``days + 1`` days; ``strict`` gives two windows of ``days`` days.
    """
    last = latest(sales)
    edge = F.date_sub(last, days - 1 if strict else days)
    start = F.date_sub(last, 2 * days - 1 if strict else 2 * days)
    recent = F.avg(F.when(F.col("date") >= edge, F.col("quantity")))
    prior = F.avg(F.when(F.col("date") < edge, F.col("quantity")))
    return (
        sales.where(F.col("date") >= start)
        .groupBy("product_id")
        .agg(prior.alias("prior"), recent.alias("recent"))
        .where(F.col("prior").isNotNull() & F.col("recent").isNotNull())
        .select(
            "product_id",
            fixed("prior", 2).alias("avg_daily_prior_90d"),
            fixed("recent", 2).alias("avg_daily_recent_90d"),
            fixed(F.col("recent") - F.col("prior"), 2).alias("change"),
            fixed(ratio(100.0 * (F.col("recent") - F.col("prior")), F.col("prior")), 2).alias(
                "pct_change"
            ),
        )
        .orderBy("pct_change", "product_id")
        .limit(n)
    )


def category_rank(sales: DataFrame) -> DataFrame:
    """SQL ``RANK`` of the products by units within their category.

    A window by category would sort a large category in one task, so the ranks come from counted
    unit totals and are joined back.
    """
    products = sales.groupBy("product_id", "category").agg(
        _units(), F.sum(F.col("quantity") * F.col("price")).alias("total_revenue")
    )
    units = products.select("category", tied("total_units", "total_revenue"))
    ranks = ranked_values(units, ["category"], "total_units").select(
        "category", "total_units", (F.col("n_after") + 1).alias("category_rank")
    )
    return products.join(ranks, ["category", "total_units"]).select(
        "product_id",
        "category",
        "total_units",
        fixed("total_revenue", 2).alias("total_revenue"),
        "category_rank",
    )


def rolling_week(panel: DataFrame) -> DataFrame:
    """Average of up to seven rows ending today, over the rows the panel has."""
    frame = Window.partitionBy("product_id").orderBy("date").rowsBetween(-6, 0)
    return panel.select(
        "date",
        "product_id",
        F.col("quantity").alias("daily_units"),
        fixed(F.avg("quantity").over(frame), 2).alias("rolling_7d_avg_units"),
    )


def product_growth(sales: DataFrame) -> DataFrame:
    """Month-over-month growth per product; a product has one row per month."""
    monthly = sales.groupBy(_month(), "product_id", "category").agg(_units())
    previous = F.lag("total_units").over(Window.partitionBy("product_id").orderBy("year_month"))
    return monthly.withColumn("prev_month_units", previous).withColumn(
        "mom_growth_pct", _growth("total_units", "prev_month_units")
    )
