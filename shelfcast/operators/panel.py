"""The gap-free product-by-day panel and its leakage-safe features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.functions.timegrid import date_span

LAGS = (1, 7, 14, 28)
WINDOWS = (7, 14, 28)
CALENDAR_FEATURES = ("day_of_week", "month", "week_of_year", "is_weekend")
DRIVERS = ("price", "promotion", "discount", "holiday")
TARGET = "quantity"
# The order in which models expect their features.
FEATURE_COLUMNS = [
    *[f"lag_{n}" for n in LAGS],
    *[f"rolling_mean_{n}" for n in WINDOWS],
    *[f"rolling_std_{n}" for n in WINDOWS],
    *CALENDAR_FEATURES,
    *DRIVERS,
]
PANEL_COLUMNS = ["product_id", "category", "date", "quantity", *DRIVERS]


def daily_aggregate(sales: DataFrame) -> DataFrame:
    """One row per product, category and day.

    The keys include the day, so one busy product is spread over many tasks, and partial sums are
    combined before the shuffle. This is the only step that moves data in proportion to the sales.
    """
    return (
        sales.where(
            F.col("product_id").isNotNull()
            & F.col("category").isNotNull()
            & F.col("date").isNotNull()
        )
        .groupBy("product_id", "category", "date")
        .agg(
            F.coalesce(F.sum("quantity"), F.lit(0)).cast("double").alias("quantity"),
            F.avg("price").alias("price"),
            F.max("promotion").cast("double").alias("promotion"),
            F.avg("discount").alias("discount"),
            F.max("holiday").cast("double").alias("holiday"),
        )
    )


def calendar_spine(sales: DataFrame) -> DataFrame:
    """Every day between the first and the last sale."""
    return sales.agg(F.min("date").alias("a"), F.max("date").alias("b")).select(
        F.explode(F.sequence("a", "b")).alias("date")
    )


def _by_product() -> Window:
    return Window.partitionBy("product_id").orderBy("date")


def complete_panel(daily: DataFrame, first: Column, last: Column) -> DataFrame:
    """The product-by-day grid between ``first`` and ``last``; days without sales hold nulls.

    ``known_category`` and ``known_price`` carry the latest value known on each day. Every daily row
    is stretched up to the product's next sale, and the product's first row also back to ``first``,
    so the grid needs neither a calendar join nor a product-by-calendar product: one shuffle by
    product, on daily rows. A product with two rows for one day stops the job.

    The partition count is set here because the rows grow after the shuffle: sparse products would
    otherwise be packed into few tasks by the size of their daily rows.
    """
    partitions = int(daily.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    daily = daily.repartition(partitions, "product_id")
    days = _by_product()
    following = F.lead("date").over(days)
    upto_now = days.rowsBetween(Window.unboundedPreceding, 0)
    ahead = daily.select(
        *PANEL_COLUMNS,
        following.alias("_next"),
        F.lag("date").over(days).alias("_previous"),
        F.last("price", ignorenulls=True).over(upto_now).alias("_price"),
    )
    until = F.when(
        F.col("_next") == F.col("date"),
        F.raise_error(
            F.concat_ws(" ", F.lit("Two rows for product"), "product_id", F.lit("on"), "date")
        ).cast("date"),
    ).otherwise(F.coalesce(F.date_sub("_next", 1), last))
    since = F.when(F.col("_previous").isNull(), first).otherwise(F.col("date"))
    grid = ahead.withColumn("_day", F.explode(F.sequence(since, until)))

    sold = F.col("_day") == F.col("date")
    started = F.col("_day") >= F.col("date")
    return grid.select(
        "product_id",
        F.when(sold, F.col("category")).alias("category"),
        F.col("_day").alias("date"),
        *[F.when(sold, F.col(c)).alias(c) for c in ("quantity", *DRIVERS)],
        F.when(started, F.col("category")).alias("known_category"),
        F.when(started, F.col("_price")).alias("known_price"),
    )


def fill_forward(grid: DataFrame) -> DataFrame:
    """Use the latest known category and price; days before the first sale stay null."""
    return grid.withColumns(
        {"category": F.col("known_category"), "price": F.col("known_price")}
    ).drop("known_category", "known_price")


def zero_fill(grid: DataFrame) -> DataFrame:
    """A day without sales has no demand, promotion, discount or holiday mark."""
    return grid.withColumns(
        {
            name: F.coalesce(F.col(name), F.lit(0.0))
            for name in ("quantity", "promotion", "discount", "holiday")
        }
    )


def build_panel(sales: DataFrame) -> DataFrame:
    """One row per product and calendar day between the table's first and last date."""
    known = sales.where(
        F.col("product_id").isNotNull() & F.col("category").isNotNull()
    )
    grid = complete_panel(daily_aggregate(sales), *date_span(known))
    return zero_fill(fill_forward(grid)).select(*PANEL_COLUMNS)


def lag_columns(
    value: str, days: Window, lags: Sequence[int] = LAGS
) -> dict[str, Column]:
    return {f"lag_{n}": F.lag(value, n).over(days) for n in lags}


def rolling_columns(
    value: str,
    days: Window,
    means: Sequence[int] = WINDOWS,
    stds: Sequence[int] = WINDOWS,
) -> dict[str, Column]:
    """Mean and sample deviation of the ``n`` rows before today, null until ``n`` rows exist."""

    def full(n: int, aggregate: Column) -> Column:
        frame = days.rowsBetween(-n, -1)
        return F.when(F.count(value).over(frame) == n, aggregate.over(frame))

    columns = {f"rolling_mean_{n}": full(n, F.avg(value)) for n in means}
    columns.update({f"rolling_std_{n}": full(n, F.stddev_samp(value)) for n in stds})
    return columns


def calendar_feature_columns(day: str = "date") -> dict[str, Column]:
    """Weekday with Monday = 0, month, ISO week and a weekend mark."""
    return {
        "day_of_week": F.weekday(day),
        "month": F.month(day),
        "week_of_year": F.weekofyear(day),
        "is_weekend": F.when(F.weekday(day) >= 5, 1).otherwise(0),
    }


def lag_features(panel: DataFrame) -> DataFrame:
    return panel.withColumns(lag_columns(TARGET, _by_product()))


def rolling_features(panel: DataFrame) -> DataFrame:
    return panel.withColumns(rolling_columns(TARGET, _by_product()))


def calendar_features(panel: DataFrame) -> DataFrame:
    return panel.withColumns(calendar_feature_columns())


def add_features(panel: DataFrame) -> DataFrame:
    """All features in one projection, so that one sort by product and date serves them all."""
    days = _by_product()
    return panel.withColumns(
        {
            **lag_columns(TARGET, days),
            **rolling_columns(TARGET, days),
            **calendar_feature_columns(),
        }
    )


def drop_warmup(features: DataFrame) -> DataFrame:
    """Keep the rows on which every feature is known."""
    return features.dropna(subset=FEATURE_COLUMNS)


def model_features(sales: DataFrame) -> DataFrame:
    return drop_warmup(add_features(build_panel(sales)))


def warmup_loss(features: DataFrame) -> DataFrame:
    """Nulls per feature, with the rows before and after dropping them and the mean loss."""
    complete = F.lit(True)
    for name in FEATURE_COLUMNS:
        complete = complete & F.col(name).isNotNull()
    per_product = features.groupBy("product_id").agg(
        F.count("*").alias("rows_before"),
        F.count_if(complete).alias("rows_after"),
        *[F.count_if(F.col(name).isNull()).alias(name) for name in FEATURE_COLUMNS],
    )
    total = per_product.agg(
        F.count("*").alias("products"),
        *[F.sum(c).alias(c) for c in ("rows_before", "rows_after", *FEATURE_COLUMNS)],
    )
    return total.unpivot(
        ["products", "rows_before", "rows_after"], FEATURE_COLUMNS, "feature", "n_null"
    ).select(
        "feature",
        "n_null",
        "rows_before",
        "rows_after",
        F.try_divide(
            (F.col("rows_before") - F.col("rows_after")).cast("double"), F.col("products")
        ).alias("mean_rows_lost"),
    )


def leakage_check(features: DataFrame, lag: int = 7) -> DataFrame:
    """Rows whose lag differs from the quantity found ``lag`` days earlier; must be 0."""
    earlier = features.select(
        "product_id",
        F.date_add("date", lag).alias("date"),
        F.col(TARGET).alias("_earlier"),
    )
    name = f"lag_{lag}"
    return (
        features.select("product_id", "date", name)
        .join(earlier, ["product_id", "date"])
        .agg(
            F.count("*").alias("rows_checked"),
            F.count_if(~F.col(name).eqNullSafe(F.col("_earlier"))).alias("mismatches"),
        )
    )


def feature_columns(features: DataFrame) -> DataFrame:
    """The ordered feature list, with the non-null values each feature has in the table."""
    counts = features.agg(*[F.count(name).alias(name) for name in FEATURE_COLUMNS])
    entries = F.array(
        *[
            F.struct(
                F.lit(i + 1).alias("position"),
                F.lit(name).alias("feature"),
                F.col(name).alias("n_values"),
            )
            for i, name in enumerate(FEATURE_COLUMNS)
        ]
    )
    return counts.select(F.explode(entries).alias("e")).select("e.*")
