"""Profiling and cleaning of a dirty sales table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.functions.numeric import numeric
from shelfcast.functions.ordered import grouped_quantiles
from shelfcast.functions.sharing import counted_once

SALES_KEY = ("date", "product_id", "store", "region")


def parsed_date(column: str = "date") -> Column:
    """The date of a text column, null where the text is not a valid day."""
    return F.col(column).try_cast("date")


def profile_shape(df: DataFrame) -> DataFrame:
    """One row per column with its type, and the table's row and column counts."""
    fields = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(i + 1).alias("position"),
                    F.lit(field.name).alias("column_name"),
                    F.lit(field.dataType.simpleString()).alias("data_type"),
                )
                for i, field in enumerate(df.schema.fields)
            ]
        )
    ).alias("field")
    return (
        df.agg(F.count("*").alias("n_rows"))
        .select("n_rows", F.lit(len(df.columns)).alias("n_columns"), fields)
        .select("field.*", "n_rows", "n_columns")
    )


def profile_describe(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Count, distinct count, most frequent value, mean, std, min, quartiles and max per column.

    All columns are turned into (column, text, number) and counted together, so the statistics come
    from one scan and from counts that are already combined before the shuffle. Numeric statistics
    are null for text columns. Ties for the most frequent value go to the smallest text.
    """
    names = list(columns or df.columns)
    types = {f.name: f.dataType for f in df.schema.fields}
    cells = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(name).alias("column_name"),
                    F.col(name).cast("string").alias("text"),
                    (
                        F.col(name).cast("double")
                        if isinstance(types[name], T.NumericType)
                        else F.lit(None).cast("double")
                    ).alias("number"),
                )
                for name in names
            ]
        )
    )
    present = df.select(cells.alias("cell")).select("cell.*").where(F.col("text").isNotNull())
    counted = counted_once(present, ["column_name", "text", "number"], "n")
    weight = F.col("n").cast("double")
    total = F.sum(F.when(F.col("number").isNotNull(), weight))
    mean = F.try_divide(F.sum(F.col("number") * weight), total)
    summary = counted.groupBy("column_name").agg(
        F.sum("n").alias("n_values"),
        F.count("*").alias("n_unique"),
        F.min_by("text", F.struct(-F.col("n"), F.col("text"))).alias("top"),
        F.max("n").alias("top_freq"),
        mean.alias("mean"),
        F.min("number").alias("min"),
        F.max("number").alias("max"),
    )
    # One entry per column, so it is looked up: ten join keys would put most rows into a few tasks.
    known = summary.agg(
        F.map_from_entries(F.collect_list(F.struct("column_name", F.struct("mean", "n_values"))))
    ).scalar()
    own = F.element_at(known, F.col("column_name"))
    gap = F.col("number") - own["mean"]
    spread = (
        counted.where(F.col("number").isNotNull())
        .groupBy("column_name")
        .agg(F.sum(gap * gap * weight).alias("squares"), F.max(own["n_values"]).alias("n_values"))
        .select(
            "column_name",
            F.sqrt(F.try_divide(F.col("squares"), F.col("n_values") - F.lit(1))).alias("std"),
        )
    )
    quartiles = grouped_quantiles(
        counted, ["column_name"], "number", {"q25": 0.25, "q50": 0.5, "q75": 0.75}, weight="n"
    )
    return (
        summary.join(spread, "column_name", "left")
        .join(quartiles, "column_name", "left")
        .select(
            "column_name", "n_values", "n_unique", "top", "top_freq",
            "mean", "std", "min", "q25", "q50", "q75", "max",
        )
    )


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Nulls per column, most first."""
    names = list(columns or df.columns)
    counts = df.agg(*[F.count_if(F.col(name).isNull()).alias(name) for name in names])
    return counts.unpivot([], names, "column_name", "n_null").orderBy(
        F.desc("n_null"), "column_name"
    )


def exact_duplicates(df: DataFrame) -> DataFrame:
    """Rows that repeat an earlier row in every column."""
    return _repeated(df, df.columns, "exact_duplicates")


def key_duplicates(df: DataFrame, keys: Sequence[str] = SALES_KEY) -> DataFrame:
    """Rows that repeat an earlier row's key; null counts as a key value."""
    return _repeated(df, keys, "key_duplicates")


def _repeated(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    return (
        df.groupBy(*keys)
        .agg(F.count("*").alias("n"))
        .agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias(name))
    )


def invalid_numeric(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count_if(F.col("quantity") < 0).alias("negative_quantity"),
        F.count_if(F.col("price") < 0).alias("negative_price"),
        F.count_if(F.col("quantity") == 0).alias("zero_quantity"),
    )


def date_problems(df: DataFrame, cutoff: str) -> DataFrame:
    """Missing and unparsable dates, the parsed range, and dates after ``cutoff``."""
    day = parsed_date()
    return df.agg(
        F.count_if(F.col("date").isNull()).alias("missing_dates"),
        F.count_if(day.isNull() & F.col("date").isNotNull()).alias("unparsable_dates"),
        F.min(day).alias("min_date"),
        F.max(day).alias("max_date"),
        F.count_if(day > F.lit(cutoff).cast("date")).alias("future_dates"),
    )


def drop_duplicates(df: DataFrame) -> DataFrame:
    """Keep one copy of rows that agree in every column."""
    return df.dropDuplicates()


def drop_bad_dates(df: DataFrame, cutoff: str) -> DataFrame:
    """Parse the date and keep valid days up to ``cutoff``."""
    return df.withColumn("date", parsed_date()).where(F.col("date") <= F.lit(cutoff).cast("date"))


def drop_missing_target(df: DataFrame, target: str = "quantity") -> DataFrame:
    return df.dropna(subset=[target])


def drop_negative(df: DataFrame) -> DataFrame:
    """Keep non-negative quantities and prices; an unknown price stays."""
    return df.where((F.col("quantity") >= 0) & ((F.col("price") >= 0) | F.col("price").isNull()))


def impute_median_price(df: DataFrame) -> DataFrame:
    """Replace a missing price by the product's exact median price.

    Only rows without a price meet the medians; the other rows pass through without a shuffle, so a
    product with most of the rows cannot make one join task slow. ``df`` is read by three branches:
    give a table, or a plan whose shuffle the branches can share, as :func:`clean_sales` does.
    """
    priced = df.where(F.col("price").isNotNull())
    unpriced = df.where(F.col("price").isNull())
    medians = grouped_quantiles(
        priced.select("product_id", "price"), ["product_id"], "price", {"median_price": 0.5}
    )
    filled = (
        unpriced.drop("price")
        .join(medians, "product_id", "left")
        .withColumnRenamed("median_price", "price")
    )
    return priced.unionByName(filled.select(*df.columns))


def valid_rows(df: DataFrame, cutoff: str) -> DataFrame:
    """The rows that the date, target and sign rules keep, with the date still as text."""
    in_time = parsed_date() <= F.lit(cutoff).cast("date")
    return drop_negative(drop_missing_target(df.where(in_time)))


def clean_sales(df: DataFrame, cutoff: str) -> DataFrame:
    """Copies, dates, target and negative values, then prices; quantity as integer.

    Copies are rows that agree in every column before any parsing. The row rules treat copies
    alike, so they run first and less data is shuffled.
    """
    single = counted_once(valid_rows(df, cutoff), df.columns, "_copies").drop("_copies")
    kept = single.withColumn("date", parsed_date())
    return impute_median_price(kept).withColumn("quantity", F.col("quantity").cast("bigint"))


def cleaning_report(raw: DataFrame, cutoff: str) -> DataFrame:
    """Rows before and after cleaning; imputation changes no row count, so it is not run here."""
    kept = drop_duplicates(valid_rows(raw, cutoff))
    after = kept.agg(F.count("*")).scalar()
    return raw.agg(F.count("*").alias("rows_before")).select(
        "rows_before",
        after.alias("rows_after"),
        (F.col("rows_before") - after).alias("rows_removed"),
        F.try_divide((F.col("rows_before") - after).cast("double"), F.col("rows_before")).alias(
            "share_removed"
        ),
    )


def safe_stat_columns(column: Column | str, when: Column | None = None) -> dict[str, Column]:
    """Mean, std, min and max over the finite numbers of a column, null where there are none."""
    value = numeric(column)
    if when is not None:
        value = F.when(when, value)
    return {
        "mean": F.avg(value),
        "std": F.stddev_samp(value),
        "min": F.min(value),
        "max": F.max(value),
    }


def safe_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column, computed in a single pass."""
    aggregates = [
        F.struct(*[c.alias(stat) for stat, c in safe_stat_columns(name).items()]).alias(name)
        for name in columns
    ]
    row = df.agg(*aggregates)
    entries = F.explode(
        F.array(*[F.struct(F.lit(n).alias("column_name"), F.col(n).alias("s")) for n in columns])
    )
    return row.select(entries.alias("e")).select("e.column_name", "e.s.*")
