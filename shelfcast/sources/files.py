"""Readers and writers for sales, panel and report tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.functions.contracts import require_columns


def _schema(date_type: T.DataType, quantity_type: T.DataType) -> T.StructType:
    return T.StructType(
        [
            T.StructField("date", date_type),
            T.StructField("product_id", T.StringType()),
            T.StructField("category", T.StringType()),
            T.StructField("quantity", quantity_type),
            T.StructField("price", T.DoubleType()),
            T.StructField("promotion", T.IntegerType()),
            T.StructField("discount", T.DoubleType()),
            T.StructField("store", T.StringType()),
            T.StructField("region", T.StringType()),
            T.StructField("holiday", T.IntegerType()),
        ]
    )


SALES_SCHEMA = _schema(T.DateType(), T.LongType())
RAW_SALES_SCHEMA = _schema(T.StringType(), T.DoubleType())
SALES_COLUMNS = SALES_SCHEMA.fieldNames()


def read_table(
    spark: SparkSession, path: str, schema: T.StructType, columns: Sequence[str] | None = None
) -> DataFrame:
    """Read a CSV (with header) or parquet table with an explicit schema, optionally pruned.

    The schema is never inferred, so the read costs no extra pass, and a column selection reaches
    the scan.
    """
    if path.rstrip("/").endswith(".parquet"):
        df = spark.read.parquet(path)
    else:
        df = spark.read.schema(schema).csv(path, header=True, enforceSchema=False)
    return require_columns(df, columns).select(*columns) if columns else df


def read_sales(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Clean sales, dates parsed."""
    return read_table(spark, path, SALES_SCHEMA, columns)


def read_raw_sales(
    spark: SparkSession, path: str, columns: Sequence[str] | None = None
) -> DataFrame:
    """Sales as exported: the date stays text until it is cleaned."""
    return read_table(spark, path, RAW_SALES_SCHEMA, columns)


def register_views(spark: SparkSession, **tables: DataFrame) -> None:
    """Put tables under SQL names, such as ``sales`` and ``daily_product_panel``."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def run_sql_catalog(
    spark: SparkSession, statements: Mapping[str, str], **tables: DataFrame
) -> dict[str, DataFrame]:
    """Analyze every named statement; a statement that does not resolve names itself and fails.

    A statement names a table of ``tables`` in braces; no view of the session is touched.
    """
    results, failures = {}, []
    for name, text in statements.items():
        try:
            results[name] = spark.sql(text, **tables)
        except Exception as error:  # collected, so that one run reports every broken statement
            failures.append(f"{name}: {error}")
    if failures:
        raise ValueError("Statements that failed:\n" + "\n".join(failures))
    return results


def preview(df: DataFrame, order_by: Sequence[str], n: int = 15) -> DataFrame:
    """The first ``n`` rows in the given order, each with the row count of the whole table."""
    total = df.agg(F.count("*")).scalar()
    return df.orderBy(*order_by).limit(n).withColumn("total_rows", total)


def write_report(df: DataFrame, path: str, fmt: str = "parquet") -> str:
    """Write one result table, replacing an earlier version of the same report."""
    if fmt not in ("parquet", "csv"):
        raise ValueError(f"Unknown report format: {fmt}")
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.parquet(path)
    return path
