"""Demand tables derived from the star-schema tables the driver provides.

``sales`` turns line items into product sales, ``sales_raw`` adds the kinds of dirt a raw export
has, and ``wide_demand`` with its dimensions is one row per series and one column per day.
Dimension joins carry no broadcast hint: Spark broadcasts a side only when its size statistics
allow it and otherwise shuffles both sides, with skew handling by adaptive execution.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

HOLIDAYS = (101, 704, 1225)  # fixed values: month * 100 + day


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _sales_columns() -> dict[str, Column]:
    day = F.col("l_shipdate").cast("date")
    return {
        "date": day,
        "product_id": F.concat("p_brand", F.lit("/"), "p_type"),
        "category": F.col("p_type"),
        "quantity": F.col("l_quantity").cast("bigint"),
        "price": F.col("l_extendedprice") * (1 - F.col("l_discount")) / F.col("l_quantity"),
        "promotion": F.when(F.col("l_discount") >= 0.08, 1).otherwise(0),
        "discount": F.col("l_discount"),
        "store": F.concat(F.lit("STORE_"), (F.col("l_suppkey") % 5 + 1).cast("string")),
        "holiday": F.when(
            (F.month(day) * 100 + F.dayofmonth(day)).isin(*HOLIDAYS), 1
        ).otherwise(0),
    }


def sales(spark: SparkSession, folder: str, with_region: bool = False) -> DataFrame:
    """One row per line item; ``region`` costs three more joins, so it is left out unless asked."""
    lines = table(spark, folder, "lineitem").join(
        table(spark, folder, "part"), F.col("p_partkey") == F.col("l_partkey")
    )
    columns = _sales_columns()
    if with_region:
        lines = (
            lines.join(table(spark, folder, "supplier"), F.col("s_suppkey") == F.col("l_suppkey"))
            .join(table(spark, folder, "nation"), F.col("n_nationkey") == F.col("s_nationkey"))
            .join(table(spark, folder, "region"), F.col("r_regionkey") == F.col("n_regionkey"))
        )
        columns["region"] = F.col("r_name")
    return lines.select(
        *[c.alias(name) for name, c in columns.items()], F.col("l_orderkey").alias("order_id")
    )


def sales_raw(spark: SparkSession, folder: str) -> DataFrame:
    """Sales with bad dates, missing and negative numbers and exact copies, set by the order id."""
    order = F.col("order_id")
    dirty = sales(spark, folder, with_region=True).select(
        "order_id",
        F.when(order % 2400 == 6, "2001-13-40")
        .when(order % 2400 == 7, "2026-01-15")
        .when(order % 4800 == 8, F.lit(None))
        .otherwise(F.col("date").cast("string"))
        .alias("date"),
        "product_id",
        "category",
        F.when(order % 500 == 1, F.lit(None))
        .when(order % 2000 == 3, -F.col("quantity") - 1)
        .otherwise(F.col("quantity"))
        .cast("double")
        .alias("quantity"),
        F.when(order % 500 == 2, F.lit(None))
        .when(order % 2000 == 4, -F.col("price"))
        .otherwise(F.col("price"))
        .alias("price"),
        "promotion",
        "discount",
        "store",
        "region",
        "holiday",
    )
    copies = F.when(order % 700 == 5, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return dirty.withColumn("_copy", F.explode(copies)).drop("_copy")


def daily_events(spark: SparkSession, folder: str) -> DataFrame:
    """Events per user and day number, counted from the first day of the table."""
    events = table(spark, folder, "events").select(
        F.col("user_id"), F.col("ts").cast("date").alias("day")
    )
    first = events.agg(F.min("day")).scalar()
    return (
        events.groupBy("user_id", "day")
        .agg(F.count("*").alias("demand"))
        .withColumn("n", F.datediff("day", first) + 1)
    )


def wide_demand(spark: SparkSession, folder: str) -> DataFrame:
    """One row per series with a day column, ``d_1`` and on, for every day from the first to the last event."""
    days = daily_events(spark, folder).agg(F.max("n")).first()[0] or 0
    day_columns = [
        F.coalesce(F.sum(F.when(F.col("n") == i, F.col("demand"))), F.lit(0)).alias(f"d_{i}")
        for i in range(1, days + 1)
    ]
    return (
        daily_events(spark, folder)
        .groupBy(F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("id"))
        .agg(*day_columns)
    )


def series_metadata(spark: SparkSession, folder: str) -> DataFrame:
    """Item, department, category, store and state of every series."""
    user = F.col("user_id")
    return (
        table(spark, folder, "events")
        .select("user_id")
        .distinct()
        .select(
            F.concat(F.lit("U"), user.cast("string")).alias("id"),
            F.concat(F.lit("ITEM_"), (user % 40).cast("string")).alias("item_id"),
            F.concat(F.lit("DEPT_"), (user % 7).cast("string")).alias("dept_id"),
            F.concat(F.lit("CAT_"), (user % 3).cast("string")).alias("cat_id"),
            F.concat(F.lit("STORE_"), (user % 10).cast("string")).alias("store_id"),
            F.element_at(
                F.array(F.lit("CA"), F.lit("TX"), F.lit("WI"), F.lit("NY")),
                (user % 4 + 1).cast("int"),
            ).alias("state_id"),
        )
    )


def calendar_columns(day: Column) -> dict[str, Column]:
    """Calendar attributes of a day; week days are numbered from Saturday = 1."""
    wday = F.dayofweek(day) % 7 + 1
    return {
        "wm_yr_wk": F.weekofyear(day),
        "weekday": F.date_format(day, "EEEE"),
        "wday": wday,
        "month": F.month(day),
        "year": F.year(day),
        "event_name_1": F.when(F.dayofmonth(day) == 1, "MonthStart"),
        "event_type_1": F.when(F.dayofmonth(day) == 1, "Cultural"),
        "event_name_2": F.when(F.dayofmonth(day) == 15, "MidMonth"),
        "event_type_2": F.when(F.dayofmonth(day) == 15, "National"),
        "snap_CA": F.when(wday.isin(1, 4), 1).otherwise(0),
        "snap_TX": F.when(wday.isin(2, 5), 1).otherwise(0),
        "snap_WI": F.when(wday.isin(3, 6), 1).otherwise(0),
    }


def calendar(spark: SparkSession, folder: str, extra_days: int = 0) -> DataFrame:
    """One row per day of the events table, and ``extra_days`` more as a published calendar has."""
    span = table(spark, folder, "events").agg(
        F.min(F.col("ts").cast("date")).alias("first"),
        F.max(F.col("ts").cast("date")).alias("last"),
    )
    days = span.select(
        F.col("first"),
        F.explode(F.sequence("first", F.date_add("last", extra_days))).alias("date"),
    )
    return days.select(
        "date",
        F.concat(F.lit("d_"), (F.datediff("date", "first") + 1).cast("string")).alias("d"),
        *[c.alias(name) for name, c in calendar_columns(F.col("date")).items()],
    )
