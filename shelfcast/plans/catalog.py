"""Registered queries: every operator on the driver tables, with its reference SQL.

``columns`` lists the result columns with a mark for how they are compared: ``:i`` whole number,
``:<n>`` a double rounded to n places, none for values that must be equal as they are. Rounding
happens here, at the edge; the operators keep full precision. Both sides add a small offset before
rounding, because decimal prices often lie exactly halfway between two rounded values, where the
last bit of a sum would decide.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.functions import contracts, metrics
from shelfcast.functions.numeric import fixed
from shelfcast.functions.timegrid import date_span
from shelfcast.functions.workspace import materialize, new_folder
from shelfcast.operators import (
    benchmark, cleaning, eda, errors, intervals, models, monitoring, panel, policy, sales_queries,
    splits,
)
from shelfcast.plans import inputs, oracle
from shelfcast.plans.statements import STATEMENTS
from shelfcast.sources import files, standin
from shelfcast.streaming import scoring

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    run: Run
    columns: str
    sql: str | None = None
    reads: str = ""
    extra: dict = field(default_factory=dict)

    def dataframe(self, spark: SparkSession, folder: str) -> DataFrame:
        selected = []
        for entry in self.columns.split():
            name, _, mark = entry.partition(":")
            column = F.col(name)
            if mark == "i":
                column = column.cast("bigint")
            elif mark:
                column = fixed(column + oracle.offset(int(mark)), int(mark))
            selected.append(column.alias(name))
        return self.run(spark, folder).select(*selected)

    def reference(self) -> str | None:
        if self.sql is None:
            return None
        selected = []
        for entry in self.columns.split():
            name, _, mark = entry.partition(":")
            if mark == "i":
                selected.append(f"CAST({name} AS BIGINT) AS {name}")
            elif mark:
                shifted = f"{name} + {oracle.offset(int(mark))!r}"
                selected.append(f"{oracle.fx(shifted, int(mark))} AS {name}")
            else:
                selected.append(name)
        body = f"SELECT {', '.join(selected)} FROM ({self.sql}) AS result"
        return oracle.with_tables(body, self.reads, self.extra)


QUERIES: dict[str, Query] = {}


def register(key: str, columns: str, sql: str | None = None, reads: str = "", extra=None):
    def add(run: Run) -> Run:
        QUERIES[key] = Query(run, columns, sql, reads, extra or {})
        return run

    return add


def sales_with_region(spark: SparkSession, folder: str) -> DataFrame:
    return standin.sales(spark, folder, with_region=True)


# Sources, sinks and contracts ------------------------------------------------------------------

SALES_COLUMNS = (
    "date product_id category quantity:i price:6 promotion:i discount store region holiday:i"
)
RAW_COLUMNS = (
    "date product_id category quantity price:6 promotion:i discount store region holiday:i"
)


@register("read_sales", SALES_COLUMNS, "SELECT * FROM sales", "sales")
def read_sales(spark, folder):
    path = new_folder(spark, "sales-csv")
    table = sales_with_region(spark, folder).select(*files.SALES_COLUMNS)
    return files.read_sales(spark, files.write_report(table, path, "csv"))


@register("read_raw_sales", RAW_COLUMNS, "SELECT * FROM raw", "raw")
def read_raw_sales(spark, folder):
    path = new_folder(spark, "raw-csv")
    table = standin.sales_raw(spark, folder).select(*files.SALES_COLUMNS)
    return files.read_raw_sales(spark, files.write_report(table, path, "csv"))


@register(
    "read_projected", "id first_day:i last_day:i",
    "SELECT id, sum(demand) FILTER (n = 1) AS first_day, "
    "sum(demand) FILTER (n = (SELECT max(n) FROM event_days)) AS last_day FROM event_long GROUP BY id",
    "event_long event_days",
)
def read_projected(spark, folder):
    path = new_folder(spark, "wide") + ".parquet"
    wide = standin.wide_demand(spark, folder)
    files.write_report(wide, path)
    last = wide.columns[-1]
    found = files.read_table(spark, path, wide.schema, ["id", "d_1", last])
    return found.select("id", F.col("d_1").alias("first_day"), F.col(last).alias("last_day"))


@register(
    "register_views", "view_name n_rows:i units:2",
    "SELECT 'sales' AS view_name, count(*) AS n_rows, sum(quantity) AS units FROM sales "
    "UNION ALL SELECT 'daily_product_panel', count(*), sum(quantity) FROM model",
    "sales model",
)
def register_views(spark, folder):
    files.register_views(
        spark, sales=standin.sales(spark, folder),
        daily_product_panel=inputs.features(spark, folder),
    )
    return spark.sql(
        "SELECT 'sales' AS view_name, count(*) AS n_rows, sum(quantity) AS units FROM sales "
        "UNION ALL SELECT 'daily_product_panel', count(*), sum(quantity) FROM daily_product_panel"
    )


CATEGORY_SQL = (
    f"SELECT category, sum(quantity) AS total_units, {oracle.fx('sum(quantity * price)', 2)} AS "
    "total_revenue, count(DISTINCT product_id) AS n_products FROM sales GROUP BY category"
)


@register(
    "write_report", "category total_units:i total_revenue:2 n_products:i",
    CATEGORY_SQL,
    "sales",
)
def write_report(spark, folder):
    report = sales_queries.top_categories(standin.sales(spark, folder))
    path = files.write_report(report, new_folder(spark, "report"))
    return spark.read.schema(report.schema).parquet(path)


@register(
    "preview", "product_id category total_units:i total_rows:i",
    "SELECT *, count(*) OVER () AS total_rows FROM (SELECT product_id, category, "
    "sum(quantity) AS total_units FROM sales GROUP BY ALL) ORDER BY product_id LIMIT 15",
    "sales",
)
def preview(spark, folder):
    table = standin.sales(spark, folder).groupBy("product_id", "category").agg(
        F.sum("quantity").alias("total_units")
    )
    return files.preview(table, ["product_id"])


@register(
    "require_columns", "store n_rows:i units:i",
    "SELECT store, count(*) AS n_rows, sum(quantity) AS units FROM sales GROUP BY store", "sales",
)
def require_columns(spark, folder):
    table = contracts.require_columns(
        sales_with_region(spark, folder), files.SALES_COLUMNS, "sales columns"
    )
    return table.groupBy("store").agg(
        F.count("*").alias("n_rows"), F.sum("quantity").alias("units")
    )


@register(
    "assert_unique_key", "product_id date n_rows:i",
    "SELECT product_id, date, count(*) AS n_rows FROM sales GROUP BY ALL HAVING count(*) > 1",
    "sales",
)
def assert_unique_key(spark, folder):
    contracts.assert_unique_key(inputs.features(spark, folder), ["product_id", "date"], "features")
    return contracts.duplicate_keys(standin.sales(spark, folder), ["product_id", "date"])


@register(
    "panel_quality_gate", "n_rows:i n_series:i null_dates:i null_demand:i negative_demand:i duplicates:i",
    "SELECT count(*) AS n_rows, count(DISTINCT id) AS n_series, "
    "count(*) FILTER (date IS NULL) AS null_dates, count(*) FILTER (demand IS NULL) AS null_demand, "
    "count(*) FILTER (demand < 0) AS negative_demand, "
    "count(*) - count(DISTINCT (id, date)) AS duplicates FROM event_daily",
    "event_daily",
)
def panel_quality_gate(spark, folder):
    return benchmark.quality_gate(inputs.event_daily(spark, folder))


@register(
    "calendar_coverage", "calendar_rows:i calendar_days:i expected_days:i",
    "SELECT count(*) AS calendar_rows, count(DISTINCT d) AS calendar_days, max(last) AS expected_days "
    "FROM calendar, (SELECT max(n) AS last FROM event_days) WHERE CAST(substr(d, 3) AS INTEGER) BETWEEN 1 AND last",
    "calendar event_days",
)
def calendar_coverage(spark, folder):
    parts = inputs.event_benchmark(spark, folder)
    benchmark.require_calendar_coverage(parts["calendar"], parts["days"])
    return benchmark.calendar_coverage(parts["calendar"], parts["days"])


@register("save_load_model", "product_id date prediction:4")
def save_load_model(spark, folder):
    path = models.save_model(spark, inputs.production_model(spark, folder), new_folder(spark, "model"))
    _, holdout = splits.holdout_frames(inputs.features(spark, folder))
    return models.predict_demand(holdout, models.load_model(spark, path))


@register(
    "monitoring_summary_text", "value",
    """SELECT 'Benchmark rows: ' || (SELECT count(*) FROM monitored) AS value
    UNION ALL SELECT 'Final-test rows: ' || (SELECT sum(is_final_test) FROM monitored)
    UNION ALL SELECT 'Prediction rows: ' || (SELECT 2 * count(*) FROM predictions)
    UNION ALL SELECT 'Missing predictions: '
        || (SELECT count(*) FILTER (prediction IS NULL) FROM predictions)
    UNION ALL SELECT 'Negative predictions: '
        || (SELECT count(*) FILTER (prediction < 0) FROM predictions)""",
    "monitored predictions",
)
def monitoring_summary_text(spark, folder):
    return monitoring.monitoring_summary_text(
        monitoring.monitoring_summary(
            inputs.monitored(spark, folder), inputs.benchmark_final(spark, folder)
        )
    )


# Cleaning and profiling ------------------------------------------------------------------------


def _raw(run):
    return lambda spark, folder: run(standin.sales_raw(spark, folder))


def _dated(run):
    """With the last day of the sales as the cutoff."""
    return lambda spark, folder: run(standin.sales_raw(spark, folder), inputs.cutoff(spark, folder))


def _count(column: str, condition: str) -> str:
    return f"count(*) FILTER ({condition}) AS {column}"


register(
    "profile_shape", "position:i column_name data_type n_rows:i n_columns:i",
    """SELECT t.*, (SELECT count(*) FROM raw) AS n_rows, 11 AS n_columns FROM (VALUES
        (1, 'order_id', 'bigint'), (2, 'date', 'string'), (3, 'product_id', 'string'),
        (4, 'category', 'string'), (5, 'quantity', 'double'), (6, 'price', 'double'),
        (7, 'promotion', 'int'), (8, 'discount', 'double'), (9, 'store', 'string'),
        (10, 'region', 'string'), (11, 'holiday', 'int')
    ) AS t(position, column_name, data_type)""",
    "raw",
)(_raw(cleaning.profile_shape))


def _describe_sql(name: str, numeric: bool) -> str:
    number = name if numeric else "CAST(NULL AS DOUBLE)"
    return f"""SELECT '{name}' AS column_name, count({name}) AS n_values,
        count(DISTINCT {name}) AS n_unique, max(c) AS top_freq,
        avg({number}) AS mean, stddev_samp({number}) AS std, min({number}) AS min,
        quantile_cont({number}, 0.25) AS q25, quantile_cont({number}, 0.5) AS q50,
        quantile_cont({number}, 0.75) AS q75, max({number}) AS max
        FROM (SELECT {name}, count(*) FILTER ({name} IS NOT NULL) OVER (PARTITION BY {name}) AS c
              FROM raw)"""


DESCRIBED = {
    "date": False, "product_id": False, "category": False, "quantity": True, "price": True,
    "promotion": True, "discount": True, "store": False, "region": False, "holiday": True,
}
register(
    "profile_describe",
    "column_name n_values:i n_unique:i top_freq:i mean:6 std:6 min:6 q25:6 q50:6 q75:6 max:6",
    " UNION ALL ".join(_describe_sql(name, numeric) for name, numeric in DESCRIBED.items()),
    "raw",
)(_raw(lambda df: cleaning.profile_describe(df, list(DESCRIBED))))
register(
    "profile_top_values", "column_name top top_freq:i",
    " UNION ALL ".join(
        f"SELECT * FROM (SELECT '{name}' AS column_name, {name} AS top, count(*) AS top_freq "
        f"FROM raw WHERE {name} IS NOT NULL GROUP BY {name} "
        f"ORDER BY count(*) DESC, {name} LIMIT 1)"
        for name in ("date", "product_id", "category", "store", "region")
    ),
    "raw",
)(
    _raw(
        lambda df: cleaning.profile_describe(
            df, ["date", "product_id", "category", "store", "region"]
        )
    )
)
register(
    "null_counts", "column_name n_null:i",
    " UNION ALL ".join(
        f"SELECT '{name}' AS column_name, count(*) FILTER ({name} IS NULL) AS n_null FROM raw"
        for name in ("order_id", *DESCRIBED)
    ),
    "raw",
)(_raw(cleaning.null_counts))
register(
    "exact_duplicates", "exact_duplicates:i",
    "SELECT (SELECT count(*) FROM raw) - (SELECT count(*) FROM (SELECT DISTINCT * FROM raw)) "
    "AS exact_duplicates",
    "raw",
)(_raw(cleaning.exact_duplicates))
register(
    "key_duplicates", "key_duplicates:i",
    "SELECT (SELECT count(*) FROM raw) - (SELECT count(*) FROM "
    "(SELECT DISTINCT date, product_id, store, region FROM raw)) AS key_duplicates",
    "raw",
)(_raw(cleaning.key_duplicates))
register(
    "invalid_numeric", "negative_quantity:i negative_price:i zero_quantity:i",
    "SELECT " + ", ".join(
        [
            _count("negative_quantity", "quantity < 0"),
            _count("negative_price", "price < 0"),
            _count("zero_quantity", "quantity = 0"),
        ]
    ) + " FROM raw",
    "raw",
)(_raw(cleaning.invalid_numeric))
register(
    "date_problems", "missing_dates:i unparsable_dates:i min_date max_date future_dates:i",
    "SELECT " + ", ".join(
        [
            _count("missing_dates", "date IS NULL"),
            _count("unparsable_dates", "date IS NOT NULL AND TRY_CAST(date AS DATE) IS NULL"),
            "min(TRY_CAST(date AS DATE)) AS min_date",
            "max(TRY_CAST(date AS DATE)) AS max_date",
            _count("future_dates", "TRY_CAST(date AS DATE) > (SELECT max(date) FROM sales)"),
        ]
    ) + " FROM raw",
    "raw sales",
)(_dated(cleaning.date_problems))

register(
    "drop_duplicates", "order_id:i " + RAW_COLUMNS, "SELECT DISTINCT * FROM raw", "raw"
)(_raw(cleaning.drop_duplicates))
register(
    "drop_bad_dates", "order_id:i " + RAW_COLUMNS,
    "SELECT * REPLACE (TRY_CAST(date AS DATE) AS date) FROM raw "
    "WHERE TRY_CAST(date AS DATE) <= (SELECT max(date) FROM sales)",
    "raw sales",
)(_dated(cleaning.drop_bad_dates))
register(
    "drop_missing_target", "order_id:i " + RAW_COLUMNS,
    "SELECT * FROM raw WHERE quantity IS NOT NULL", "raw",
)(_raw(cleaning.drop_missing_target))
register(
    "drop_negative", "order_id:i " + RAW_COLUMNS,
    "SELECT * FROM raw WHERE quantity >= 0 AND (price >= 0 OR price IS NULL)", "raw",
)(_raw(cleaning.drop_negative))
register(
    "impute_median_price", "order_id:i " + RAW_COLUMNS,
    "SELECT * REPLACE (coalesce(price, median(price) OVER (PARTITION BY product_id)) AS price) "
    "FROM raw",
    "raw",
)(_raw(lambda df: cleaning.impute_median_price(materialize(df, "raw"))))
register(
    "clean_sales", "order_id:i " + SALES_COLUMNS, "SELECT * FROM clean", "clean"
)(_dated(cleaning.clean_sales))
register(
    "cleaning_report", "rows_before:i rows_after:i rows_removed:i share_removed:6",
    "SELECT b AS rows_before, a AS rows_after, b - a AS rows_removed, (b - a) / b AS share_removed "
    "FROM (SELECT count(*) AS b FROM raw), (SELECT count(*) AS a FROM clean)",
    "raw clean",
)(_dated(cleaning.cleaning_report))
register(
    "safe_stats", "column_name mean:6 std:6 min:6 max:6",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, avg({c}) AS mean, stddev_samp({c}) AS std, "
        f"min({c}) AS min, max({c}) AS max FROM raw"
        for c in ("quantity", "price", "promotion", "discount", "holiday")
    ),
    "raw",
)(
    _raw(
        lambda df: cleaning.safe_stats(
            df, ["quantity", "price", "promotion", "discount", "holiday"]
        )
    )
)

# Sales questions -------------------------------------------------------------------------------


def _sales(run):
    return lambda spark, folder: run(standin.sales(spark, folder))


def _units_by(keys: str, tail: str = "") -> str:
    return (
        f"SELECT {keys}, sum(quantity) AS total_units, "
        f"{oracle.fx('sum(quantity * price)', 2)} AS total_revenue FROM sales GROUP BY ALL {tail}"
    )


GROWTH = oracle.fx(
    "100.0::DOUBLE * (total_units - prev_month_units) / nullif(prev_month_units, 0)", 2
)
register(
    "q1_monthly_sales", "year_month total_units:i total_revenue:2",
    _units_by("strftime(date, '%Y-%m') AS year_month"), "sales",
)(_sales(sales_queries.monthly_sales))
register(
    "q2_top_products", "product_id category total_units:i total_revenue:2",
    _units_by("product_id, category", "ORDER BY total_units DESC, product_id LIMIT 10"), "sales",
)(_sales(sales_queries.top_products))
register(
    "q3_top_categories", "category total_units:i total_revenue:2 n_products:i",
    CATEGORY_SQL,
    "sales",
)(_sales(sales_queries.top_categories))
register(
    "q4_demand_variance", "product_id category avg_daily_units:2 variance_daily_units:2",
    f"SELECT product_id, category, {oracle.fx('avg(quantity)', 2)} AS avg_daily_units, "
    f"{oracle.fx('var_pop(quantity)', 2)} AS variance_daily_units FROM sales GROUP BY ALL "
    "ORDER BY variance_daily_units DESC, product_id LIMIT 10",
    "sales",
)(_sales(sales_queries.demand_variance))
register(
    "q5_avg_daily_demand",
    "product_id category avg_daily_units:2 min_daily_units:i max_daily_units:i",
    f"SELECT product_id, category, {oracle.fx('avg(quantity)', 2)} AS avg_daily_units, "
    "min(quantity) AS min_daily_units, max(quantity) AS max_daily_units FROM sales GROUP BY ALL "
    "ORDER BY avg_daily_units DESC, product_id LIMIT 15",
    "sales",
)(_sales(sales_queries.average_daily_demand))
register(
    "q6_monthly_growth", "year_month total_units:i prev_month_units:i mom_growth_pct:2",
    f"SELECT *, {GROWTH} AS mom_growth_pct FROM (SELECT *, lag(total_units) OVER (ORDER BY year_month) AS "
    "prev_month_units FROM (SELECT strftime(date, '%Y-%m') AS year_month, "
    "CAST(sum(quantity) AS BIGINT) AS total_units FROM sales GROUP BY ALL))",
    "sales",
)(_sales(sales_queries.monthly_growth))
register(
    "q7_weekday_demand", "weekday weekday_num:i avg_units:2 total_units:i",
    f"SELECT dayname(date) AS weekday, dayofweek(date) AS weekday_num, "
    f"{oracle.fx('avg(quantity)', 2)} AS avg_units, sum(quantity) AS total_units FROM sales GROUP BY ALL",
    "sales",
)(_sales(sales_queries.weekday_demand))


def _declining_sql(edge: int, start: int) -> str:
    return f"""
    SELECT product_id, {oracle.fx("prior", 2)} AS avg_daily_prior_90d,
           {oracle.fx("recent", 2)} AS avg_daily_recent_90d,
           {oracle.fx("recent - prior", 2)} AS change,
           {oracle.fx("100.0::DOUBLE * (recent - prior) / nullif(prior, 0)", 2)} AS pct_change
    FROM (SELECT product_id, avg(quantity) FILTER (date >= m - {edge}) AS recent,
                 avg(quantity) FILTER (date < m - {edge} AND date >= m - {start}) AS prior
          FROM sales, (SELECT max(date) AS m FROM sales) GROUP BY product_id)
    WHERE recent IS NOT NULL AND prior IS NOT NULL
    ORDER BY pct_change, product_id LIMIT 10"""


DECLINING = "product_id avg_daily_prior_90d:2 avg_daily_recent_90d:2 change:2 pct_change:2"
register("q8_declining_products", DECLINING, _declining_sql(90, 180), "sales")(
    _sales(sales_queries.declining_products)
)
register("q8_declining_products_strict", DECLINING, _declining_sql(89, 179), "sales")(
    _sales(lambda df: sales_queries.declining_products(df, strict=True))
)
register(
    "q9_category_rank", "product_id category total_units:i total_revenue:2 category_rank:i",
    "SELECT *, rank() OVER (PARTITION BY category ORDER BY total_units DESC) AS category_rank "
    "FROM (" + _units_by("product_id, category") + ")",
    "sales",
)(_sales(sales_queries.category_rank))


@register(
    "q10_rolling_7d", "date product_id daily_units:2 rolling_7d_avg_units:2",
    "SELECT date, product_id, quantity AS daily_units, "
    + oracle.fx(
        "avg(quantity) OVER (PARTITION BY product_id ORDER BY date "
        "ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)",
        2,
    )
    + " AS rolling_7d_avg_units FROM model",
    "model",
)
def q10_rolling_7d(spark, folder):
    return sales_queries.rolling_week(inputs.features(spark, folder))


register(
    "q11_product_growth",
    "year_month product_id category total_units:i prev_month_units:i mom_growth_pct:2",
    f"SELECT *, {GROWTH} AS mom_growth_pct FROM (SELECT *, lag(total_units) OVER (PARTITION BY product_id "
    "ORDER BY year_month) AS prev_month_units FROM (SELECT strftime(date, '%Y-%m') AS year_month, "
    "product_id, category, CAST(sum(quantity) AS BIGINT) AS total_units FROM sales GROUP BY ALL))",
    "sales",
)(_sales(sales_queries.product_growth))

def _statement_rows() -> str:
    """Rows of every question; that the rows are those of the DataFrame forms is checked in Spark."""
    return " UNION ALL ".join(
        f"SELECT '{key}' AS statement, count(*) AS n_rows, true AS same_as_dataframe FROM ({QUERIES[key].sql}) AS q"
        for key in STATEMENTS
    )


def run_sql_catalog(spark, folder):
    sales, daily = standin.sales(spark, folder), inputs.features(spark, folder)
    results = files.run_sql_catalog(spark, STATEMENTS, sales=sales, panel=daily)
    rows = []
    for name, df in results.items():
        expected = QUERIES[name].run(spark, folder).select(*df.columns)
        marked = df.select("*", F.lit(1).alias("_side")).unionByName(expected.select("*", F.lit(-1).alias("_side")))
        unequal = marked.groupBy(*df.columns).agg(
            F.sum("_side").alias("side"), F.count_if(F.col("_side") == 1).alias("n"))
        rows.append(unequal.agg(
            F.lit(name).alias("statement"), F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
            (F.count_if(F.col("side") != 0) == 0).alias("same_as_dataframe")))
    return reduce(DataFrame.unionByName, rows)


register("run_sql_catalog", "statement n_rows:i same_as_dataframe", _statement_rows(), "sales model")(run_sql_catalog)

# Exploration -----------------------------------------------------------------------------------

WEEK_END = "CAST(date_trunc('week', date) AS DATE) + 6"


def _filled_sql(keys: str, label: str, period: str, step: str, source: str = "sales") -> str:
    """Totals per period with the empty periods inside each key's own span as 0."""
    key_list = f"{keys}, " if keys else ""
    same_key = f"AND t.{keys} = g.{keys}" if keys else ""
    group = f"GROUP BY {keys}" if keys else ""
    return f"""
    SELECT {"g." + keys + "," if keys else ""} g.p AS {label}, coalesce(t.quantity, 0) AS quantity
    FROM (SELECT {key_list} CAST(unnest(generate_series(min({period}), max({period}),
                 INTERVAL {step})) AS DATE) AS p FROM {source} {group}) g
    LEFT JOIN (SELECT {key_list} {period} AS p, sum(quantity) AS quantity FROM {source}
               GROUP BY ALL) t ON t.p = g.p {same_key}"""


TOP_EIGHT = (
    "(SELECT * FROM sales WHERE product_id IN (SELECT product_id FROM sales GROUP BY product_id "
    "ORDER BY sum(quantity) DESC, product_id LIMIT 8))"
)
register(
    "daily_total", "date quantity:i",
    "SELECT date, sum(quantity) AS quantity FROM sales GROUP BY date", "sales",
)(_sales(eda.daily_total))
register(
    "weekly_total", "week_end quantity:i", _filled_sql("", "week_end", WEEK_END, "7 DAY"), "sales"
)(_sales(eda.weekly_total))
register(
    "monthly_total", "month_start quantity:i",
    _filled_sql("", "month_start", "CAST(date_trunc('month', date) AS DATE)", "1 MONTH"), "sales",
)(_sales(eda.monthly_total))
register(
    "top_n_products", "product_id total_units:i",
    "SELECT product_id, sum(quantity) AS total_units FROM sales GROUP BY product_id "
    "ORDER BY total_units DESC, product_id LIMIT 8",
    "sales",
)(_sales(eda.top_n_products))
register(
    "top_products_weekly", "product_id week_end quantity:i",
    _filled_sql("product_id", "week_end", WEEK_END, "7 DAY", TOP_EIGHT), "sales",
)(_sales(eda.top_products_weekly))
register(
    "category_weekly", "category week_end quantity:i",
    f"SELECT category, {WEEK_END} AS week_end, sum(quantity) AS quantity FROM sales GROUP BY ALL",
    "sales",
)(_sales(eda.category_weekly))
register(
    "weekday_mean", "weekday avg_quantity:6",
    "SELECT dayname(date) AS weekday, avg(quantity) AS avg_quantity FROM sales GROUP BY ALL",
    "sales",
)(_sales(eda.weekday_mean))
register(
    "month_mean", "month:i avg_quantity:6",
    "SELECT month(date) AS month, avg(quantity) AS avg_quantity FROM sales GROUP BY ALL", "sales",
)(_sales(eda.month_mean))


def _outlier_sql(frame: str, threshold: float) -> str:
    over = f"(PARTITION BY product_id ORDER BY date ROWS BETWEEN {frame})"
    return f"""
    SELECT product_id, date, quantity, a AS rolling_mean, s AS rolling_std,
           (quantity - a) / s AS z
    FROM (SELECT *, avg(quantity) OVER {over} AS a, stddev_samp(quantity) OVER {over} AS s,
                 count(*) OVER {over} AS n
          FROM (SELECT product_id, date, CAST(sum(quantity) AS BIGINT) AS quantity
                FROM sales GROUP BY ALL))
    WHERE n = 7 AND s > 0 AND abs((quantity - a) / s) > {threshold}"""


OUTLIERS = "product_id date quantity:i rolling_mean:6 rolling_std:6 z:4"
register(
    "rolling_outliers", OUTLIERS, _outlier_sql("6 PRECEDING AND CURRENT ROW", 3.0), "sales"
)(_sales(eda.rolling_outliers))
register(
    "rolling_outliers_prior", OUTLIERS, _outlier_sql("7 PRECEDING AND 1 PRECEDING", 3.0), "sales"
)(_sales(lambda df: eda.rolling_outliers(df, include_current=False)))

# Panel and features ----------------------------------------------------------------------------

DRIVER_COLUMNS = "quantity:2 price:6 promotion:2 discount:6 holiday:2"
PANEL_LIST = f"product_id category date {DRIVER_COLUMNS}"
LAG_LIST = "lag_1:2 lag_7:2 lag_14:2 lag_28:2"
ROLLING_LIST = (
    "rolling_mean_7:6 rolling_mean_14:6 rolling_mean_28:6 "
    "rolling_std_7:6 rolling_std_14:6 rolling_std_28:6"
)
CALENDAR_LIST = "day_of_week:i month:i week_of_year:i is_weekend:i"
FEATURE_LIST = f"{PANEL_LIST} {LAG_LIST} {ROLLING_LIST} {CALENDAR_LIST}"


def _grid(sales: DataFrame) -> DataFrame:
    return panel.complete_panel(panel.daily_aggregate(sales), *date_span(sales))


def _panel(run):
    return lambda spark, folder: run(panel.build_panel(standin.sales(spark, folder)))


register("daily_aggregate", PANEL_LIST, "SELECT * FROM daily", "daily")(
    _sales(panel.daily_aggregate)
)
register("calendar_spine", "date", "SELECT * FROM spine", "spine")(_sales(panel.calendar_spine))
register(
    "complete_panel", f"{PANEL_LIST} known_category known_price:6", "SELECT * FROM grid", "grid"
)(_sales(_grid))
register(
    "fill_forward", PANEL_LIST,
    "SELECT * REPLACE (known_category AS category, known_price AS price) FROM grid", "grid",
)(_sales(lambda df: panel.fill_forward(_grid(df))))
register(
    "zero_fill", PANEL_LIST,
    "SELECT * REPLACE (coalesce(quantity, 0) AS quantity, coalesce(promotion, 0) AS promotion, "
    "coalesce(discount, 0) AS discount, coalesce(holiday, 0) AS holiday) FROM grid",
    "grid",
)(_sales(lambda df: panel.zero_fill(_grid(df))))
register("build_panel", PANEL_LIST, "SELECT * FROM panel", "panel")(_sales(panel.build_panel))
register(
    "lag_features", f"product_id date {LAG_LIST}", "SELECT * FROM features", "features"
)(_panel(panel.lag_features))
register(
    "rolling_features", f"product_id date {ROLLING_LIST}", "SELECT * FROM features", "features"
)(_panel(panel.rolling_features))
register(
    "calendar_features", f"product_id date {CALENDAR_LIST}", "SELECT * FROM features", "features"
)(_panel(panel.calendar_features))
register("add_features", FEATURE_LIST, "SELECT * FROM features", "features")(
    _panel(panel.add_features)
)
register("drop_warmup", FEATURE_LIST, "SELECT * FROM model", "model")(_sales(panel.model_features))
register(
    "warmup_loss", "feature n_null:i rows_before:i rows_after:i mean_rows_lost:6",
    " UNION ALL ".join(
        f"SELECT '{c}' AS feature, count(*) FILTER ({c} IS NULL) AS n_null, count(*) AS rows_before, "
        "(SELECT count(*) FROM model) AS rows_after, (count(*) - (SELECT count(*) FROM model)) "
        "/ count(DISTINCT product_id) AS mean_rows_lost FROM features"
        for c in oracle.FEATURE_NAMES
    ),
    "features model",
)(lambda spark, folder: panel.warmup_loss(inputs.full_features(spark, folder)))
register(
    "leakage_check", "rows_checked:i mismatches:i",
    "SELECT count(*) AS rows_checked, "
    "count(*) FILTER (f.lag_7 IS DISTINCT FROM e.quantity) AS mismatches "
    "FROM features f JOIN features e ON e.product_id = f.product_id AND e.date = f.date - 7",
    "features",
)(lambda spark, folder: panel.leakage_check(inputs.full_features(spark, folder)))
register(
    "feature_columns", "position:i feature n_values:i",
    " UNION ALL ".join(
        f"SELECT {i + 1} AS position, '{c}' AS feature, count({c}) AS n_values FROM features"
        for i, c in enumerate(oracle.FEATURE_NAMES)
    ),
    "features",
)(lambda spark, folder: panel.feature_columns(inputs.full_features(spark, folder)))

# Splits ----------------------------------------------------------------------------------------

register(
    "holdout_split", "split n_rows:i first_date last_date",
    "SELECT CASE WHEN date > (SELECT max(date) FROM sales) - 60 THEN 'test' ELSE 'development' END "
    "AS split, count(*) AS n_rows, min(date) AS first_date, max(date) AS last_date "
    "FROM model GROUP BY ALL",
    "model",
)(
    lambda spark, folder: splits.holdout_split(
        inputs.features(spark, folder), last=inputs.last_day(spark, folder)
    )
    .groupBy("split")
    .agg(
        F.count("*").alias("n_rows"),
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
    )
)
register(
    "time_series_folds", "fold:i train_end test_start test_end train_rows:i test_rows:i",
    """SELECT f.*, count(*) FILTER (s.date <= train_end) AS train_rows,
              count(*) FILTER (s.date BETWEEN test_start AND test_end) AS test_rows
       FROM sales s, (SELECT k AS fold, m - CAST(60 * (5 - k) AS INTEGER) AS train_end,
                    m - CAST(60 * (5 - k) AS INTEGER) + 1 AS test_start,
                    m - CAST(60 * (4 - k) AS INTEGER) AS test_end
             FROM (SELECT max(date) AS m FROM sales), (SELECT unnest([1, 2, 3, 4]) AS k)) f
       GROUP BY ALL""",
    "sales",
)(lambda spark, folder: _folds_with_sizes(standin.sales(spark, folder)))
register(
    "assign_folds", "product_id date fold:i", "SELECT product_id, date, fold FROM oof", "oof"
)(lambda spark, folder: inputs.naive_oof(spark, folder))


def _folds_with_sizes(sales: DataFrame) -> DataFrame:
    """Fold bounds as rows with the sales in each side; rows are counted per day first."""
    splits.time_series_folds(sales)  # raises when there are too few dates
    bounds = splits.fold_table(sales)
    days = sales.groupBy("date").agg(F.count("*").alias("n"))
    sizes = days.agg(F.collect_list(F.struct("date", "n"))).scalar()  # one entry per calendar day

    def total(condition):
        return F.aggregate(
            F.filter("_days", condition), F.lit(0).cast("bigint"), lambda s, d: s + d["n"]
        )

    return bounds.withColumn("_days", sizes).withColumns(
        {
            "train_rows": total(lambda d: d["date"] <= F.col("train_end")),
            "test_rows": total(
                lambda d: (d["date"] >= F.col("test_start")) & (d["date"] <= F.col("test_end"))
            ),
        }
    )


register(
    "benchmark_windows", "fold:i train_end validation_start validation_end",
    "SELECT k AS fold, m - CAST(28 * k AS INTEGER) - 28 AS train_end, "
    "m - CAST(28 * k AS INTEGER) - 27 AS validation_start, m - CAST(28 * k AS INTEGER) AS "
    "validation_end FROM (SELECT max(date) AS m FROM sales), (SELECT unnest([1, 2, 3, 4]) AS k)",
    "sales",
)(_sales(splits.benchmark_windows))
register(
    "final_flag", "is_final_test:i n_rows:i first_date last_date",
    "SELECT is_final_test, count(*) AS n_rows, min(date) AS first_date, max(date) AS last_date "
    "FROM monitored GROUP BY ALL",
    "monitored",
)(
    lambda spark, folder: inputs.monitored(spark, folder)
    .groupBy("is_final_test")
    .agg(
        F.count("*").alias("n_rows"),
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
    )
)

# Models and scoring ----------------------------------------------------------------------------


@register(
    "seasonal_naive", "product_id date quantity:2 prediction:2",
    "SELECT product_id, date, quantity, lag(quantity, 7) OVER (PARTITION BY product_id "
    "ORDER BY date) AS prediction FROM panel",
    "panel",
)
def seasonal_naive(spark, folder):
    return models.seasonal_naive(panel.build_panel(standin.sales(spark, folder)))


SCORED = "product_id category date quantity:2 prediction:4"


def _fitted(name: str) -> Run:
    return lambda spark, folder: inputs.predictions_of(spark, folder, name)


register("ridge", SCORED)(_fitted(models.RIDGE))
register("random_forest", SCORED)(_fitted(models.FOREST))
register("gradient_boosting", SCORED)(_fitted(models.BOOSTING))


@register("train_production", "feature importance:6")
def train_production(spark, folder):
    model = inputs.production_model(spark, folder)
    pairs = F.array(
        *[
            F.struct(F.lit(name).alias("feature"), F.lit(w).alias("importance"))
            for name, w in model.importances().items()
        ]
    )
    return spark.range(1).select(F.explode(pairs).alias("p")).select("p.*")


@register("predict_demand", "product_id date prediction:4")
def predict_demand(spark, folder):
    return models.predict_demand(
        inputs.features(spark, folder), inputs.production_model(spark, folder)
    )


@register("batch_score", "date product_id category quantity:2 prediction:4 error:4 absolute_error:4")
def batch_score(spark, folder):
    return models.batch_score(
        inputs.features(spark, folder), inputs.production_model(spark, folder)
    )


@register(
    "batch_score_summary",
    "n_rows:i products:i min_date max_date prediction_min:4 prediction_max:4 prediction_mean:4 "
    "negative_predictions:i",
)
def batch_score_summary(spark, folder):
    return models.batch_score_summary(batch_score(spark, folder))


@register(
    "validate_requests", "request_id failed_rules",
    """SELECT concat_ws('|', product_id, CAST(date AS VARCHAR)) AS request_id,
        concat_ws(',', CASE WHEN dayofyear(date) % 50 = 3 THEN 'lag_7 missing' END,
                  CASE WHEN dayofyear(date) % 50 = 4 AND price > 0 THEN 'price below 0' END,
                  CASE WHEN dayofyear(date) % 50 = 1 THEN 'promotion above 1' END,
                  CASE WHEN dayofyear(date) % 50 = 2 THEN 'month above 12' END) AS failed_rules
       FROM model""",
    "model",
)
def validate_requests(spark, folder):
    checked = models.validate_requests(inputs.requests(spark, folder))
    return checked.withColumn("failed_rules", F.array_join("failed_rules", ","))


@register("score_requests", "request_id product_id category predicted_demand:4")
def score_requests(spark, folder):
    return models.score_requests(
        inputs.requests(spark, folder), inputs.production_model(spark, folder)
    )


@register(
    "score_requests_stream", "outcome n_rows:i n_requests:i",
    """SELECT CASE WHEN dayofyear(date) % 50 IN (1, 2, 3) OR (dayofyear(date) % 50 = 4 AND price > 0)
                   THEN 'rejected' ELSE 'accepted' END AS outcome,
              count(*) AS n_rows, count(DISTINCT (product_id, date)) AS n_requests
       FROM model GROUP BY ALL""",
    "model",
)
def score_requests_stream(spark, folder):
    base = new_folder(spark, "requests")
    columns = [f.name for f in scoring.REQUEST_SCHEMA.fields]
    typed = inputs.requests(spark, folder).select(
        *[F.col(f.name).cast(f.dataType) for f in scoring.REQUEST_SCHEMA.fields]
    )
    typed.select(*columns).write.parquet(f"{base}/arriving")
    started = scoring.score_requests_stream(
        scoring.read_requests(spark, f"{base}/arriving", files_per_trigger=4),
        inputs.production_model(spark, folder),
        f"{base}/accepted", f"{base}/rejected", f"{base}/progress",
    )
    for query in started:
        query.awaitTermination()
    outcomes = [
        spark.read.parquet(f"{base}/{name}").select(F.lit(name).alias("outcome"), "request_id")
        for name in ("accepted", "rejected")
    ]
    return outcomes[0].unionByName(outcomes[1]).groupBy("outcome").agg(
        F.count("*").alias("n_rows"), F.count_distinct("request_id").alias("n_requests")
    )


@register("model_info", "model_type feature_count:i features")
def model_info(spark, folder):
    # Its names do not depend on the size, so one round tells them.
    model = models.boosting_fitter(1)(inputs.development(spark, folder))
    info = models.model_info(spark, model)
    return info.withColumn("features", F.array_join("features", ","))


@register("cross_validate", "fold:i model mae:3 rmse:3 smape_pct:2")
def cross_validate(spark, folder):
    return models.cv_results(inputs.cv_predictions(spark, folder))


@register("oof_predictions", "product_id category date quantity:2 prediction:4 error:4 abs_error:4 fold:i")
def oof_predictions(spark, folder):
    return models.oof_predictions(inputs.cv_predictions(spark, folder))


@register(
    "oof_predictions_naive",
    "product_id category date quantity:2 prediction:4 error:4 abs_error:4 fold:i",
    "SELECT * FROM oof", "oof",
)
def oof_predictions_naive(spark, folder):
    """The same table for the one model that has an exact reference."""
    development = inputs.development(spark, folder)
    return models.oof_predictions(models.cross_validate(development, {}), models.NAIVE)


@register("cv_summary", "model mae_mean:4 mae_std:4 rmse_mean:4 rmse_std:4 smape_pct_mean:4 smape_pct_std:4")
def cv_summary(spark, folder):
    return models.cv_summary(cross_validate(spark, folder))


@register("final_test", "model mae:3 rmse:3 smape_pct:2 test_start test_end test_rows:i")
def final_test(spark, folder):
    scored = models.final_test(
        inputs.features(spark, folder), lambda train: inputs.production_model(spark, folder)
    )
    return models.final_test_metrics(scored)


@register("compare_models", "model mae:3 rmse:3 smape_pct:2")
def compare_models(spark, folder):
    return models.compare_models(inputs.model_predictions(spark, folder))


@register(
    "predictions_side_by_side",
    "product_id date quantity:2 pred_seasonal_naive:4 pred_ridge_regression:4 "
    "pred_random_forest:4 pred_gradient_boosting:4",
)
def predictions_side_by_side(spark, folder):
    names = [models.NAIVE, models.RIDGE, models.FOREST, models.BOOSTING]
    return models.predictions_side_by_side(inputs.model_predictions(spark, folder), names)


@register("permutation_importance", "feature importance:4")
def permutation_importance(spark, folder):
    _, holdout = splits.holdout_frames(inputs.features(spark, folder))
    return models.permutation_importance(holdout, inputs.production_model(spark, folder))


@register("best_model", "model mae_mean:4")
def best_model(spark, folder):
    return models.best_model(cv_summary(spark, folder))


# Metrics, errors and drivers -------------------------------------------------------------------

EVALUATE_LIST = "mae:3 rmse:3 smape_pct:2"


SMAPE_EPS = "avg(2 * absolute_error / (abs(quantity) + abs(prediction) + 1)) * 100"


def _evaluate_sql(keys: str, source: str = "errors", extra: str = "") -> str:
    return f"""SELECT {keys + "," if keys else ""}
        {oracle.fx("avg(absolute_error)", 3)} AS mae,
        {oracle.fx("sqrt(avg(squared_error))", 3)} AS rmse,
        {oracle.fx(SMAPE_EPS, 2)} AS smape_pct {extra}
        FROM {source} GROUP BY ALL"""


def _holdout(run):
    return lambda spark, folder: run(inputs.naive_holdout(spark, folder))


def _errors(run):
    def call(spark, folder):
        return run(
            errors.error_frame(inputs.features(spark, folder), inputs.naive_holdout(spark, folder))
        )

    return call


register(
    "mae_rmse", "mae:6 rmse:6",
    "SELECT avg(absolute_error) AS mae, sqrt(avg(squared_error)) AS rmse FROM errors", "errors",
)(
    _holdout(
        lambda df: df.agg(
            metrics.mae("quantity", "prediction").alias("mae"),
            metrics.rmse("quantity", "prediction").alias("rmse"),
        )
    )
)
register(
    "smape_eps", "smape_pct:6",
    "SELECT avg(2 * absolute_error / (abs(quantity) + abs(prediction) + 1)) * 100 AS smape_pct "
    "FROM errors",
    "errors",
)(_holdout(lambda df: df.agg(metrics.smape_eps("quantity", "prediction").alias("smape_pct"))))
register(
    "smape_zero_wape", "smape_pct:6 wape_pct:6",
    "SELECT avg(CASE WHEN quantity = 0 AND prediction = 0 THEN 0 ELSE 2 * absolute_error "
    "/ (abs(quantity) + abs(prediction)) END) * 100 AS smape_pct, "
    "sum(absolute_error) / nullif(sum(abs(quantity)), 0) * 100 AS wape_pct FROM errors",
    "errors",
)(
    _holdout(
        lambda df: df.agg(
            metrics.smape_zero("quantity", "prediction").alias("smape_pct"),
            metrics.wape("quantity", "prediction").alias("wape_pct"),
        )
    )
)
register("evaluate", EVALUATE_LIST, _evaluate_sql(""), "errors")(_holdout(metrics.evaluate))
register(
    "error_frame",
    f"date product_id y_true:2 y_pred:2 error:2 absolute_error:2 squared_error:2 category "
    f"quantity:2 {LAG_LIST} is_weekend:i",
    "SELECT * FROM errors", "errors",
)(_errors(lambda df: df))

ERROR_LIST = "observations:i mae:6 bias:6 rmse:6 p90_absolute_error:6 p95_absolute_error:6"


def _error_sql(key: str) -> str:
    return f"""SELECT {key}, count(*) AS observations, avg(absolute_error) AS mae,
        avg(error) AS bias, sqrt(avg(squared_error)) AS rmse,
        quantile_cont(absolute_error, 0.9) AS p90_absolute_error,
        quantile_cont(absolute_error, 0.95) AS p95_absolute_error
        FROM errors GROUP BY {key}"""


register("error_by_product", f"product_id {ERROR_LIST}", _error_sql("product_id"), "errors")(
    _errors(errors.error_by_product)
)
register("error_by_category", f"category {ERROR_LIST}", _error_sql("category"), "errors")(
    _errors(errors.error_by_category)
)
register(
    "error_by_condition", "condition condition_value mae:6 bias:6 observations:i",
    " UNION ALL ".join(
        f"SELECT '{c}' AS condition, CAST({c} AS VARCHAR) AS condition_value, "
        f"avg(absolute_error) AS mae, avg(error) AS bias, count(*) AS observations "
        f"FROM errors GROUP BY {c}"
        for c in ("promotion", "holiday", "is_weekend")
    ),
    "errors",
)(_errors(errors.error_by_condition))
register(
    "metrics_by_category", f"category {EVALUATE_LIST}", _evaluate_sql("category"), "errors"
)(_holdout(errors.metrics_by_category))
register(
    "metrics_by_weekday", f"weekday {EVALUATE_LIST}",
    _evaluate_sql("dayname(date) AS weekday"), "errors",
)(_holdout(errors.metrics_by_weekday))
register(
    "metrics_by_promotion", f"promotion {EVALUATE_LIST}",
    _evaluate_sql(
        "CASE promotion WHEN 0 THEN 'no promotion' WHEN 1 THEN 'promotion active' END AS promotion"
    ),
    "errors",
)(_holdout(errors.metrics_by_promotion))
register(
    "metrics_by_tercile", f"demand_tercile {EVALUATE_LIST}",
    _evaluate_sql(
        "CASE WHEN quantity <= t1 THEN 'low' WHEN quantity <= t2 THEN 'medium' ELSE 'high' END "
        "AS demand_tercile",
        "errors, (SELECT quantile_cont(quantity, 1.0 / 3) AS t1, quantile_cont(quantity, 2.0 / 3) "
        "AS t2 FROM errors)",
    ),
    "errors",
)(_holdout(errors.metrics_by_tercile))
register(
    "metrics_by_product", f"product_id {EVALUATE_LIST} avg_demand:6",
    _evaluate_sql("product_id", extra=", avg(quantity) AS avg_demand"), "errors",
)(_holdout(errors.metrics_by_product))
register(
    "driver_correlations", "variable pearson_correlation_with_demand:6 absolute_correlation:6",
    " UNION ALL ".join(
        f"SELECT '{c}' AS variable, corr(quantity, {c}) AS pearson_correlation_with_demand, "
        f"abs(corr(quantity, {c})) AS absolute_correlation FROM model"
        for c in errors.DRIVERS
    ),
    "model",
)(lambda spark, folder: errors.driver_correlations(inputs.features(spark, folder)))
register(
    "driver_segments", "segment segment_value avg_demand:6 total_units:2 observations:i",
    " UNION ALL ".join(
        f"SELECT '{c}' AS segment, CAST({c} AS VARCHAR) AS segment_value, "
        f"avg(quantity) AS avg_demand, sum(quantity) AS total_units, count(*) AS observations "
        f"FROM model GROUP BY {c}"
        for c in errors.SEGMENTS
    ),
    "model",
)(lambda spark, folder: errors.driver_segments(inputs.features(spark, folder)))

# Replenishment policy --------------------------------------------------------------------------

FIVE = oracle.policy_tables("five")
ONE = oracle.policy_tables("normal")
THREE = oracle.policy_tables("z_set")
KPI_LIST = (
    "product_id scenario z_score:2 capacity_fraction:2 oof_error_std:6 oof_rows:i avg_inventory:4 "
    "stockout_days:i service_level_pct:2 lost_units:1 total_units_ordered:1 avg_daily_forecast:2 "
    "protection_period_days:i reorder_point:1 target_level:1 safety_stock:1 inventory_capacity:1"
)
SUMMARY_LIST = (
    "products:i test_days:i lead_time_days:i review_period_days:i protection_period_days:i "
    "mean_service_level_pct:2 products_below_90pct_service:i products_below_95pct_service:i "
    "total_lost_units:1 total_units_ordered:1 total_average_inventory:1 mean_safety_stock:1 "
    "mean_reorder_point:1 mean_oof_error_std:2"
)
COSTS = (
    "z_score:2 total_lost_units:1 total_units_ordered:1 total_average_inventory:1 holding_cost:2 "
    "stockout_cost:2 ordering_cost:2 total_cost:2"
)


def _policy_inputs(spark, folder):
    return (
        inputs.policy_test(spark, folder),
        policy.error_stats(inputs.naive_oof(spark, folder)),
    )


def _parameters(spark, folder, scenarios=policy.SCENARIOS):
    test, stats = _policy_inputs(spark, folder)
    products = policy.attach_error_stats(policy.collect_days(test), stats, check=False)
    return policy.policy_parameters(policy.expand_scenarios(products, scenarios))


register(
    "oof_error_stats", "product_id error_std:6 oof_rows:i", "SELECT * FROM stats", "stats"
)(lambda spark, folder: policy.error_stats(inputs.naive_oof(spark, folder)))
register(
    "attach_error_stats", "product_id date actual_demand:2 forecast:2 error_std:6 oof_rows:i",
    "SELECT h.product_id, date, quantity AS actual_demand, prediction AS forecast, error_std, "
    "oof_rows FROM holdout h JOIN stats s ON s.product_id = h.product_id",
    "holdout stats",
)(lambda spark, folder: policy.attach_error_stats(*_policy_inputs(spark, folder)))
register(
    "policy_parameters",
    "product_id scenario z_score:2 avg_daily_forecast:6 error_std:6 protection_period_days:i "
    "safety_stock:6 reorder_point:6 target_level:6 inventory_capacity:6",
    "SELECT *, avg_forecast AS avg_daily_forecast, reorder_point AS target_level, "
    "capacity AS inventory_capacity FROM parameters",
    "parameters", FIVE,
)(_parameters)


@register(
    "validate_policy", "scenario multiplier:2 capacity_fraction:2 n_products:i",
    "SELECT scenario, multiplier, capacity_fraction, count(*) AS n_products FROM parameters "
    "GROUP BY ALL",
    "parameters", FIVE,
)
def validate_policy(spark, folder):
    policy.validate_policy(policy.SCENARIOS)
    return (
        _parameters(spark, folder)
        .groupBy("scenario", "multiplier", "capacity_fraction")
        .agg(F.count("*").alias("n_products"))
    )


register(
    "expand_scenarios", "product_id scenario multiplier:2 spike capacity_fraction:2 z_score:2 n_days:i",
    "SELECT product_id, scenario, multiplier, spike, capacity_fraction, z_score, n_days "
    "FROM parameters",
    "parameters", FIVE,
)(lambda spark, folder: _parameters(spark, folder).withColumn("n_days", F.size("days")))
register(
    "apply_spike", "product_id date actual_demand:2 forecast:2",
    "SELECT d.product_id, d.date, demand * CASE WHEN i >= n // 2 AND i < n // 2 + 5 THEN 3 ELSE 1 "
    "END AS actual_demand, prediction AS forecast FROM days d JOIN holdout h "
    "ON h.product_id = d.product_id AND h.date = d.date",
    "days holdout",
)(lambda spark, folder: policy.apply_spike(inputs.policy_test(spark, folder)))
register(
    "replenishment_fold",
    "product_id scenario stock:4 stockouts:i lost:4 ordered:4 levels:4",
    "SELECT f.* FROM fold f JOIN parameters p ON p.product_id = f.product_id "
    "AND p.scenario = f.scenario AND f.i = p.n_days - 1",
    "fold", FIVE,
)(
    lambda spark, folder: policy.replenishment_fold(_parameters(spark, folder)).select(
        "product_id", "scenario", "_end.*"
    )
)


def _five(spark, folder):
    return policy.evaluate_policy(*_policy_inputs(spark, folder))


register("policy_kpis", KPI_LIST, "SELECT * FROM kpis", "kpis", FIVE)(_five)
register("normal_by_product", KPI_LIST, "SELECT * FROM kpis", "kpis", ONE)(
    lambda spark, folder: policy.normal_by_product(*_policy_inputs(spark, folder))
)
register(
    "portfolio_summary", f"scenario z_score:2 capacity_fraction:2 {SUMMARY_LIST}",
    oracle.portfolio("scenario"), "kpis", FIVE,
)(lambda spark, folder: policy.portfolio_summary(_five(spark, folder)))
register(
    "z_sensitivity", f"z_score:2 capacity_fraction:2 {SUMMARY_LIST}",
    oracle.portfolio("z_score"), "kpis", THREE,
)(lambda spark, folder: policy.z_sensitivity(*_policy_inputs(spark, folder)))
COST_SQL = f"""
    SELECT *, {oracle.fx("total_average_inventory * test_days * 1.00", 2)} AS holding_cost,
           {oracle.fx("total_lost_units * 20.00", 2)} AS stockout_cost,
           {oracle.fx("total_units_ordered * 0.10", 2)} AS ordering_cost,
           {oracle.fx("total_average_inventory * test_days * 1.00 + total_lost_units * 20.00"
                      " + total_units_ordered * 0.10", 2)} AS total_cost
    FROM ({oracle.portfolio("z_score")})"""
register("cost_table", COSTS, COST_SQL, "kpis", THREE)(
    lambda spark, folder: policy.cost_table(
        policy.z_sensitivity(*_policy_inputs(spark, folder))
    )
)
register(
    "validate_z_set", "z_score:2 test_days:i products:i",
    f"SELECT * FROM ({oracle.portfolio('z_score')})", "kpis", THREE,
)(
    lambda spark, folder: policy.validate_z_set(
        policy.z_sensitivity(*_policy_inputs(spark, folder))
    )
)

# Public benchmark ------------------------------------------------------------------------------

SERIES_LIST = "id item_id dept_id cat_id store_id state_id"
FLAG_LIST = "is_weekend:i has_event:i event_type_present:i"
HISTORY_LIST = (
    f"{LAG_LIST} rolling_mean_7:6 rolling_mean_14:6 rolling_mean_28:6 rolling_std_7:6 "
    "rolling_std_28:6"
)
CODE_LIST = "item_code:i store_code:i dept_code:i cat_code:i state_code:i"


def _selected(spark, folder):
    """Series of the first two departments."""
    return standin.series_metadata(spark, folder).where(F.col("dept_id").isin("DEPT_0", "DEPT_1"))


@register(
    "select_series", "id days demands",
    "SELECT id, string_agg(d, ',' ORDER BY n) AS days, string_agg(CAST(demand AS VARCHAR), ',' ORDER BY n) AS demands "
    "FROM event_long WHERE id IN (SELECT id FROM metadata WHERE dept_id IN ('DEPT_0', 'DEPT_1')) GROUP BY id",
    "event_long metadata",
)
def select_series(spark, folder):
    wide = standin.wide_demand(spark, folder)
    days = [c for c in wide.columns if c.startswith("d_")]
    return benchmark.select_series(wide, _selected(spark, folder)).select(
        "id", F.lit(",".join(days)).alias("days"), F.concat_ws(",", *[F.col(c).cast("string") for c in days]).alias("demands"))


register(
    "melt_days", "id d demand:i",
    "SELECT id, d, demand FROM event_long", "event_long",
)(lambda spark, folder: benchmark.melt_days(standin.wide_demand(spark, folder)))
register(
    "join_metadata", f"{SERIES_LIST} d demand:i",
    "SELECT m.*, l.d, l.demand FROM event_long l LEFT JOIN metadata m USING (id)",
    "event_long metadata",
)(
    lambda spark, folder: benchmark.join_metadata(
        benchmark.melt_days(standin.wide_demand(spark, folder)),
        standin.series_metadata(spark, folder),
    )
)
register(
    "join_calendar",
    "id d demand:i date wm_yr_wk:i weekday wday:i month:i year:i event_name_1 event_type_1 "
    "event_name_2 event_type_2 snap_CA:i snap_TX:i snap_WI:i",
    "SELECT * FROM event_daily", "event_daily",
)(
    lambda spark, folder: (
        lambda parts: benchmark.join_calendar(
            benchmark.melt_days(parts["wide"], parts["days"]), parts["calendar"], parts["days"]
        )
    )(inputs.event_benchmark(spark, folder))
)
register(
    "event_flags", f"id date demand:2 wday:i {FLAG_LIST}", "SELECT * FROM event_flags", "event_flags"
)(lambda spark, folder: inputs.event_daily(spark, folder))
register(
    "state_snap", "id date state_id snap:i", "SELECT * FROM event_flags", "event_flags"
)(lambda spark, folder: inputs.event_daily(spark, folder))
register(
    "benchmark_features", f"id date demand:2 {HISTORY_LIST}", "SELECT * FROM bench", "bench"
)(lambda spark, folder: inputs.benchmark_daily(spark, folder))
BENCH_LIST = (
    f"{SERIES_LIST} date d demand:2 weekday wday:i month:i year:i wm_yr_wk:i {FLAG_LIST} snap:i "
    f"{HISTORY_LIST} is_final_test:i"
)


@register(
    "prepare_benchmark", BENCH_LIST,
    f"SELECT *, {oracle._history('demand', 'id', (7, 14, 28), (7, 28))}, "
    "CASE WHEN date > (SELECT max(date) FROM event_flags) - 28 THEN 1 ELSE 0 END AS is_final_test "
    "FROM event_flags",
    "event_flags",
)
def prepare_benchmark(spark, folder):
    parts = inputs.event_benchmark(spark, folder)
    return benchmark.prepare_benchmark(parts["wide"], parts["metadata"], parts["calendar"])


register(
    "encode_categories", f"{SERIES_LIST} {CODE_LIST}",
    "SELECT *, " + ", ".join(
        f"dense_rank() OVER (ORDER BY {c}) - 1 AS {c.removesuffix('_id')}_code"
        for c in benchmark.CODED
    ) + f" FROM (SELECT DISTINCT {SERIES_LIST.replace(' ', ', ')} FROM bench_base)",
    "bench_base",
)(
    lambda spark, folder: benchmark.encode_categories(
        inputs.benchmark_daily(spark, folder).select(*benchmark.SERIES_COLUMNS).distinct()
    )
)
register(
    "benchmark_training_rows", f"id date demand:2 {HISTORY_LIST}",
    "SELECT * FROM bench WHERE is_final_test = 0 AND lag_28 IS NOT NULL "
    "AND rolling_mean_28 IS NOT NULL AND rolling_std_28 IS NOT NULL",
    "bench",
)(
    lambda spark, folder: benchmark.training_rows(
        inputs.benchmark_encoded(spark, folder),
        benchmark.final_fold(inputs.benchmark_encoded(spark, folder)).train_end,
    )
)
@register(
    "naive_multistep", "id date demand:2 prediction:2",
    oracle.NAIVE_STEPS.format(source="bench", horizon=28), "bench",
)
def naive_multistep(spark, folder):
    encoded = inputs.benchmark_encoded(spark, folder)
    return benchmark.naive_multistep(encoded, benchmark.final_fold(encoded))


@register(
    "recursive_feature_row",
    f"id date {HISTORY_LIST} month:i wday:i {FLAG_LIST} snap:i {CODE_LIST}",
    "SELECT b.*, c.* EXCLUDE (id) FROM bench b JOIN (SELECT id, " + ", ".join(
        f"dense_rank() OVER (ORDER BY {c}) - 1 AS {c.removesuffix('_id')}_code"
        for c in benchmark.CODED
    ) + f" FROM (SELECT DISTINCT {SERIES_LIST.replace(' ', ', ')} FROM bench_base)) c "
    "ON c.id = b.id WHERE b.date = (SELECT max(date) FROM bench) - 27",
    "bench bench_base",
)
def recursive_feature_row(spark, folder):
    encoded = inputs.benchmark_encoded(spark, folder)
    return benchmark.recursive_feature_row(encoded, benchmark.final_fold(encoded))


@register("recursive_forecast", "id date demand:2 prediction:4")
def recursive_forecast(spark, folder):
    return inputs.benchmark_final(spark, folder).where(F.col("model") == models.BOOSTING)


BENCH_METRICS = "mae:6 rmse:6 smape_pct:6 wape_pct:6"
BENCH_METRICS_SQL = oracle.BENCH_METRICS


@register(
    "evaluate_window", BENCH_METRICS,
    f"SELECT {BENCH_METRICS_SQL} FROM ({oracle.NAIVE_STEPS.format(source='bench', horizon=28)})", "bench",
)
def evaluate_window(spark, folder):
    """Pooled metrics of the naive forecast on the holdout, the part with an exact reference."""
    return metrics.evaluate_benchmark(naive_multistep(spark, folder))


@register(
    "benchmark_cv", f"fold:i train_end validation_start validation_end model {BENCH_METRICS}"
)
def benchmark_cv(spark, folder):
    return inputs.benchmark_cv(spark, folder)


@register(
    "benchmark_cv_naive", f"fold:i train_end validation_start validation_end model {BENCH_METRICS}",
    "SELECT * FROM cv", "cv",
)
def benchmark_cv_naive(spark, folder):
    """The naive rows of the benchmark validation, which have an exact reference."""
    return inputs.benchmark_cv_naive(spark, folder)


@register("benchmark_cv_summary", f"model {BENCH_METRICS}")
def benchmark_cv_summary(spark, folder):
    return benchmark.benchmark_cv_summary(inputs.benchmark_cv(spark, folder))


@register("benchmark_final", "id date demand:2 model prediction:4")
def benchmark_final(spark, folder):
    return inputs.benchmark_final(spark, folder)


# Intervals and monitoring ----------------------------------------------------------------------


# Widths come from the validation and bounds go around the holdout forecasts of both models. The rows of the
# naive one, which have an exact reference, have queries of their own.


def _interval_width_naive(spark, folder):
    return intervals.interval_width(inputs.benchmark_cv_naive(spark, folder))


def _prediction_intervals_naive(spark, folder):
    return intervals.prediction_intervals(inputs.benchmark_final_naive(spark, folder), _interval_width_naive(spark, folder))


WIDTH_LIST = "model interval_width:6"
INTERVAL_LIST = (
    "id date demand:2 prediction:2 model interval_width:6 prediction_lower:6 prediction_upper:6 "
    "interval_covered"
)
COVERAGE_LIST = (
    "model confidence_level_pct:2 interval_width:6 coverage_pct:6 mean_interval_width:6 "
    "mean_absolute_error:6 n_observations:i"
)


register(
    "residual_quantile", "residual_quantile:6",
    "SELECT quantile_cont(abs(error), 0.9) AS residual_quantile FROM oof", "oof",
)(lambda spark, folder: intervals.residual_quantile(inputs.naive_oof(spark, folder)))


@register("interval_width", WIDTH_LIST)
def interval_width(spark, folder):
    return intervals.interval_width(inputs.benchmark_cv(spark, folder))


@register("prediction_intervals", INTERVAL_LIST)
def prediction_intervals(spark, folder):
    return intervals.prediction_intervals(inputs.benchmark_final(spark, folder), interval_width(spark, folder))


@register("interval_metrics", COVERAGE_LIST)
def interval_metrics(spark, folder):
    return intervals.interval_metrics(prediction_intervals(spark, folder))


register(
    "interval_width_naive", WIDTH_LIST,
    "SELECT model, max(rmse) AS interval_width FROM cv GROUP BY model", "cv",
)(_interval_width_naive)
register(
    "prediction_intervals_naive", INTERVAL_LIST,
    "SELECT * FROM intervals", "intervals",
)(_prediction_intervals_naive)
register(
    "interval_metrics_naive", COVERAGE_LIST,
    "SELECT model, 90.0 AS confidence_level_pct, max(interval_width) AS interval_width, "
    "avg(CASE WHEN interval_covered THEN 1 ELSE 0 END) * 100 AS coverage_pct, "
    "avg(prediction_upper - prediction_lower) AS mean_interval_width, "
    "avg(abs(demand - prediction)) AS mean_absolute_error, count(*) AS n_observations "
    "FROM intervals GROUP BY model",
    "intervals",
)(lambda spark, folder: intervals.interval_metrics(_prediction_intervals_naive(spark, folder)))

STAT_LIST = "missing_count:i negative_count:i mean:6 std:6 min:6 max:6"


def _quality_sql(c: str) -> str:
    negative = f"count(*) FILTER ({c} < 0)" if c in monitoring.NEVER_NEGATIVE else "0"
    return (
        f"SELECT 'data_quality' AS check_type, '{c}' AS metric, "
        f"count(*) FILTER ({c} IS NULL) AS missing_count, {negative} AS negative_count, "
        f"avg({c}) AS mean, stddev_samp({c}) AS std, min({c}) AS min, max({c}) AS max FROM monitored"
    )


def _shift_sql(c: str) -> str:
    new, old = "FILTER (is_final_test = 1)", "FILTER (is_final_test = 0)"
    return (
        f"SELECT 'distribution_shift' AS check_type, '{c}' AS metric, "
        f"count(*) FILTER ({c} IS NULL AND is_final_test = 1) AS missing_count, "
        f"count(*) FILTER ({c} < 0 AND is_final_test = 1) AS negative_count, "
        f"avg({c}) {new} AS mean, stddev_samp({c}) {new} AS std, min({c}) {new} AS min, "
        f"max({c}) {new} AS max, CASE WHEN stddev_samp({c}) {old} > 0 THEN "
        f"abs(avg({c}) {new} - avg({c}) {old}) / stddev_samp({c}) {old} ELSE 0 END "
        f"AS standardized_mean_shift FROM monitored"
    )


PERFORMANCE_SQL = f"""SELECT 'model_performance' AS check_type, model AS metric,
    count(*) FILTER (prediction IS NULL) AS missing_count,
    count(*) FILTER (prediction < 0) AS negative_count, avg(prediction) AS mean,
    stddev_pop(prediction) AS std, min(prediction) AS min, max(prediction) AS max,
    {BENCH_METRICS_SQL} FROM predictions GROUP BY model"""
register(
    "data_quality_rows", f"check_type metric {STAT_LIST}",
    " UNION ALL ".join(_quality_sql(c) for c in monitoring.MONITORED), "monitored",
)(lambda spark, folder: monitoring.data_quality_rows(inputs.monitored(spark, folder)))
register(
    "distribution_shift", "metric standardized_mean_shift:6",
    " UNION ALL ".join(_shift_sql(c) for c in monitoring.MONITORED), "monitored",
)(lambda spark, folder: monitoring.distribution_shift(inputs.monitored(spark, folder)))
register(
    "shift_rows", f"check_type metric {STAT_LIST} standardized_mean_shift:6",
    " UNION ALL ".join(_shift_sql(c) for c in monitoring.MONITORED), "monitored",
)(lambda spark, folder: monitoring.shift_rows(inputs.monitored(spark, folder)))


@register("model_performance", f"check_type metric {STAT_LIST} {BENCH_METRICS}")
def model_performance(spark, folder):
    return monitoring.model_performance(inputs.benchmark_final(spark, folder))


@register("monitoring_report", f"check_type metric {STAT_LIST} standardized_mean_shift:6 {BENCH_METRICS}")
def monitoring_report(spark, folder):
    return monitoring.monitoring_report(inputs.monitored(spark, folder), inputs.benchmark_final(spark, folder))


register(
    "model_performance_naive", f"check_type metric {STAT_LIST} {BENCH_METRICS}", PERFORMANCE_SQL,
    "predictions",
)(lambda spark, folder: monitoring.model_performance(inputs.benchmark_final_naive(spark, folder)))
register(
    "monitoring_report_naive",
    f"check_type metric {STAT_LIST} standardized_mean_shift:6 {BENCH_METRICS}",
    " UNION ALL BY NAME ".join(
        [
            *[f"({_quality_sql(c)})" for c in monitoring.MONITORED],
            *[f"({_shift_sql(c)})" for c in monitoring.MONITORED],
            f"({PERFORMANCE_SQL})",
        ]
    ),
    "monitored predictions",
)(
    lambda spark, folder: monitoring.monitoring_report(
        inputs.monitored(spark, folder), inputs.benchmark_final_naive(spark, folder))
)

# Trained models: what is exact about their results ---------------------------------------------
#
# Numbers of a trained model have no reference in SQL. These queries run the same operators and return
# the rows, keys, dates and figures that do, with marks for what must hold of the trained numbers.

FEATURE_ROWS = " UNION ALL ".join(f"SELECT '{c}' AS feature" for c in oracle.FEATURE_NAMES)
TRAINED_MODELS = (models.RIDGE, models.FOREST, models.BOOSTING)
KEYS = "product_id category date quantity:2"
CLOSE = 1e-9


def _measured(*names: str):
    """Whether all figures are numbers, and not below 0."""
    return reduce(lambda a, c: a & F.coalesce((F.col(c) >= 0) & ~F.isnan(c), F.lit(False)), names, F.lit(True))


def _only_naive(df: DataFrame, names: list[str]) -> DataFrame:
    """Figures of the naive model; those of a trained one are only marked as measured."""
    shown = {c: F.when(F.col("model") == models.NAIVE, F.col(c)) for c in names}
    return df.withColumn("measured", _measured(*names)).withColumns(shown)


def _trained_rows(naive: str, keys: str, names: list[str], trained: tuple[str, ...], source: str) -> str:
    empty = ", ".join(f"CAST(NULL AS DOUBLE) AS {c}" for c in names)
    select = f"{keys}, " if keys else ""
    return f"SELECT *, true AS measured FROM ({naive}) UNION ALL BY NAME " + " UNION ALL BY NAME ".join(
        f"SELECT DISTINCT {select}'{m}' AS model, {empty}, true AS measured FROM ({source})" for m in trained)


def _error_marks(actual: str, error: str, size: str):
    gap = F.col(actual) - F.col("prediction")
    return {
        "error_is_gap": F.abs(F.col(error) - gap) <= CLOSE,
        "size_is_absolute": F.abs(F.col(size) - F.abs(gap)) <= CLOSE,
        "never_negative": F.coalesce(F.col("prediction") >= 0, F.lit(False)),
    }


ERROR_MARKS = "error_is_gap size_is_absolute never_negative"
ERROR_MARKS_SQL = "true AS error_is_gap, true AS size_is_absolute, true AS never_negative"

QUERIES["model_info"] = Query(
    QUERIES["model_info"].run, QUERIES["model_info"].columns,
    f"SELECT 'boosting' AS model_type, {len(oracle.FEATURE_NAMES)} AS feature_count, "
    f"'{','.join(oracle.FEATURE_NAMES)}' AS features",
)


@register(
    "save_load_model_checked", "product_id date difference:6",
    "SELECT product_id, date, 0.0 AS difference FROM holdout", "holdout",
)
def save_load_model_checked(spark, folder):
    """The loaded pipeline predicts what the saved one did."""
    _, holdout = splits.holdout_frames(inputs.features(spark, folder))
    before = models.predict_demand(holdout, inputs.production_model(spark, folder))
    after = save_load_model(spark, folder).select("product_id", "date", F.col("prediction").alias("loaded"))
    return before.join(after, ["product_id", "date"]).withColumn("difference", F.abs(F.col("prediction") - F.col("loaded")))


@register("ridge_checked", "feature stationary", f"SELECT feature, true AS stationary FROM ({FEATURE_ROWS} UNION ALL SELECT 'intercept')")
def ridge_checked(spark, folder):
    """The penalised loss has no slope at the fitted weights."""
    alpha = 1.0
    development, _ = splits.holdout_frames(inputs.features(spark, folder))
    model = models.ridge_fitter(alpha)(development)
    scored = model.transform(development)
    residual = F.col("prediction") - F.col(panel.TARGET)
    rows = []
    for name, weight, mean, scale in zip(
        [*panel.FEATURE_COLUMNS, "intercept"], [*model.weights, 0.0], [*model.mean, 0.0], [*model.scale, 1.0], strict=True
    ):
        # The penalty is on weights of standardised features; a constant one has no part in the loss.
        x = F.lit(1.0) if name == "intercept" else F.lit(0.0) if not scale else (F.col(name) - F.lit(float(mean))) / F.lit(float(scale))
        slope = F.sum(residual * x) + F.lit(float(alpha * weight * scale))
        size = F.sum(F.abs(F.col(panel.TARGET) * x))
        rows.append(F.struct(F.lit(name).alias("feature"), (F.abs(slope) <= 1e-7 * size).alias("stationary")))
    return scored.agg(F.array(*rows).alias("rows")).select(F.explode("rows").alias("r")).select("r.*")


@register("random_forest_checked", f"{KEYS} within_targets", "SELECT *, true AS within_targets FROM holdout", "holdout")
def random_forest_checked(spark, folder):
    """Means of leaves lie within the targets that were learned."""
    development, _ = splits.holdout_frames(inputs.features(spark, folder))
    span = development.agg(F.min(panel.TARGET).alias("low"), F.max(panel.TARGET).alias("high")).first()
    predicted = inputs.predictions_of(spark, folder, models.FOREST)
    return predicted.withColumn("within_targets", F.col("prediction").between(span["low"] - CLOSE, span["high"] + CLOSE))


@register("gradient_boosting_checked", f"{KEYS} adds_up", "SELECT *, true AS adds_up FROM holdout", "holdout")
def gradient_boosting_checked(spark, folder):
    """A prediction is the weighted sum of the trees', and at least 0."""
    model = inputs.production_model(spark, folder)
    rows = models.predict_demand(inputs.holdout(spark, folder), model).withColumnRenamed("prediction", "whole")

    @F.pandas_udf("double")
    def by_tree(*columns: pd.Series) -> pd.Series:
        x = np.column_stack([c.to_numpy(float) for c in columns])
        return pd.Series(model.base + sum(model.tree_values(x, k) for k in range(len(model.roots))))

    total = by_tree(*[F.col(c).cast("double") for c in model.columns])
    return rows.withColumn("adds_up", F.abs(F.greatest(total, F.lit(0.0)) - F.col("whole")) <= 1e-6)


@register(
    "train_production_checked", "feature valid total:6",
    f"SELECT feature, true AS valid, 1.0 AS total FROM ({FEATURE_ROWS})",
)
def train_production_checked(spark, folder):
    weights = train_production(spark, folder)
    total = weights.agg(F.sum("importance")).scalar()
    return weights.select("feature", F.col("importance").between(0, 1).alias("valid"), total.alias("total"))


@register(
    "predict_demand_checked", "product_id n_rows:i n_missing:i n_negative:i",
    "SELECT product_id, count(*) AS n_rows, 0 AS n_missing, 0 AS n_negative FROM model GROUP BY product_id", "model",
)
def predict_demand_checked(spark, folder):
    return predict_demand(spark, folder).groupBy("product_id").agg(
        F.count("*").alias("n_rows"), F.count_if(F.col("prediction").isNull()).alias("n_missing"),
        F.count_if(F.col("prediction") < 0).alias("n_negative"))


@register("batch_score_checked", f"{KEYS} {ERROR_MARKS}", f"SELECT *, {ERROR_MARKS_SQL} FROM model", "model")
def batch_score_checked(spark, folder):
    return batch_score(spark, folder).withColumns(_error_marks("quantity", "error", "absolute_error"))


@register(
    "batch_score_summary_checked", "n_rows:i products:i min_date max_date negative_predictions:i ordered",
    "SELECT count(*) AS n_rows, count(DISTINCT product_id) AS products, min(date) AS min_date, max(date) AS max_date, "
    "0 AS negative_predictions, true AS ordered FROM model",
    "model",
)
def batch_score_summary_checked(spark, folder):
    mean = F.col("prediction_mean")
    return batch_score_summary(spark, folder).withColumn(
        "ordered", (F.col("prediction_min") <= mean) & (mean <= F.col("prediction_max")))


@register(
    "score_requests_checked", "request_id product_id category scored",
    "SELECT concat_ws('|', product_id, CAST(date AS VARCHAR)) AS request_id, product_id, category, true AS scored FROM model "
    "WHERE NOT (dayofyear(date) % 50 IN (1, 2, 3) OR (dayofyear(date) % 50 = 4 AND price > 0))",
    "model",
)
def score_requests_checked(spark, folder):
    return score_requests(spark, folder).withColumn("scored", _measured("predicted_demand"))


THREE_METRICS = ["mae", "rmse", "smape_pct"]
FOLD_SQL = f"""SELECT fold, 'Seasonal Naive' AS model, {oracle.fx("avg(abs_error)", 3)} AS mae,
    {oracle.fx("sqrt(avg(error * error))", 3)} AS rmse,
    {oracle.fx("avg(2 * abs_error / (abs(quantity) + abs(prediction) + 1)) * 100", 2)} AS smape_pct
    FROM oof GROUP BY fold"""


@register(
    "cross_validate_checked", f"fold:i model {EVALUATE_LIST} measured",
    _trained_rows(FOLD_SQL, "fold", THREE_METRICS, TRAINED_MODELS, "SELECT fold FROM oof"), "oof",
)
def cross_validate_checked(spark, folder):
    return _only_naive(cross_validate(spark, folder), THREE_METRICS)


@register("oof_predictions_checked", f"{KEYS} fold:i {ERROR_MARKS}", f"SELECT *, {ERROR_MARKS_SQL} FROM oof", "oof")
def oof_predictions_checked(spark, folder):
    return oof_predictions(spark, folder).withColumns(_error_marks("quantity", "error", "abs_error"))


SUMMARY_METRICS = [f"{m}_{s}" for m in THREE_METRICS for s in ("mean", "std")]


@register(
    "cv_summary_checked", "model " + " ".join(f"{c}:4" for c in SUMMARY_METRICS) + " measured",
    _trained_rows(
        "SELECT model, " + ", ".join(f"{f}({m}) AS {m}_{s}" for m in THREE_METRICS for f, s in (("avg", "mean"), ("stddev_samp", "std")))
        + f" FROM ({FOLD_SQL}) GROUP BY model", "", SUMMARY_METRICS, TRAINED_MODELS, "SELECT 1 AS one"),
    "oof",
)
def cv_summary_checked(spark, folder):
    return _only_naive(cv_summary(spark, folder), SUMMARY_METRICS)


@register("best_model_checked", "models:i least", "SELECT 1 AS models, true AS least")
def best_model_checked(spark, folder):
    """The best model is the one with the least mean error of all."""
    least = cv_summary(spark, folder).agg(F.min("mae_mean")).scalar()
    return best_model(spark, folder).agg(F.count("*").alias("models"), F.bool_and(F.col("mae_mean") == least).alias("least"))


@register(
    "final_test_checked", "model test_start test_end test_rows:i measured",
    "SELECT 'Gradient Boosting' AS model, min(date) AS test_start, max(date) AS test_end, count(*) AS test_rows, "
    "true AS measured FROM holdout",
    "holdout",
)
def final_test_checked(spark, folder):
    return final_test(spark, folder).withColumn("measured", _measured(*THREE_METRICS))


@register(
    "compare_models_checked", f"model {EVALUATE_LIST} measured",
    _trained_rows("SELECT 'Seasonal Naive' AS model, * FROM (" + _evaluate_sql("") + ")", "", THREE_METRICS, TRAINED_MODELS, "SELECT 1 AS one"),
    "errors",
)
def compare_models_checked(spark, folder):
    return _only_naive(compare_models(spark, folder), THREE_METRICS)


@register(
    "predictions_side_by_side_checked", "product_id date quantity:2 pred_seasonal_naive:4 measured",
    "SELECT product_id, date, quantity, prediction AS pred_seasonal_naive, true AS measured FROM holdout", "holdout",
)
def predictions_side_by_side_checked(spark, folder):
    others = [f"pred_{m.lower().replace(' ', '_')}" for m in TRAINED_MODELS]
    return predictions_side_by_side(spark, folder).withColumn("measured", _measured(*others))


@register("permutation_importance_checked", "feature measured", f"SELECT feature, true AS measured FROM ({FEATURE_ROWS})")
def permutation_importance_checked(spark, folder):
    importance = F.col("importance")
    return permutation_importance(spark, folder).withColumn("measured", importance.isNotNull() & ~F.isnan(importance))


@register(
    "recursive_forecast_checked", "id date demand:2 never_negative",
    "SELECT *, true AS never_negative FROM bench WHERE is_final_test = 1", "bench",
)
def recursive_forecast_checked(spark, folder):
    return recursive_forecast(spark, folder).withColumn("never_negative", _measured("prediction"))


FOUR_METRICS = ["mae", "rmse", "smape_pct", "wape_pct"]


@register(
    "evaluate_window_checked", "n_rows:i measured",
    "SELECT count(*) AS n_rows, true AS measured FROM bench WHERE is_final_test = 1", "bench",
)
def evaluate_window_checked(spark, folder):
    """Metrics of the trained forecast of the holdout."""
    rows = recursive_forecast(spark, folder)
    return metrics.evaluate_benchmark(rows).select(
        rows.agg(F.count("*")).scalar().alias("n_rows"), _measured(*FOUR_METRICS).alias("measured"))


BOTH = (models.BOOSTING,)


@register(
    "benchmark_cv_checked", f"fold:i train_end validation_start validation_end model {BENCH_METRICS} measured",
    _trained_rows("SELECT * FROM cv", "fold, train_end, validation_start, validation_end", FOUR_METRICS, BOTH, "SELECT * FROM cv"), "cv",
)
def benchmark_cv_checked(spark, folder):
    return _only_naive(benchmark_cv(spark, folder), FOUR_METRICS)


@register(
    "benchmark_cv_summary_checked", f"model {BENCH_METRICS} measured",
    _trained_rows("SELECT model, " + ", ".join(f"avg({m}) AS {m}" for m in FOUR_METRICS) + " FROM cv GROUP BY model", "", FOUR_METRICS, BOTH, "SELECT 1 AS one"),
    "cv",
)
def benchmark_cv_summary_checked(spark, folder):
    return _only_naive(benchmark_cv_summary(spark, folder), FOUR_METRICS)


@register(
    "benchmark_final_checked", "id date demand:2 model prediction:2 measured",
    _trained_rows("SELECT * FROM predictions", "id, date, demand", ["prediction"], BOTH, "SELECT * FROM predictions"), "predictions",
)
def benchmark_final_checked(spark, folder):
    return _only_naive(benchmark_final(spark, folder), ["prediction"])


# Queries that fit models come last, so that what costs minutes never keeps a cheap query waiting.
TRAINED = [
    key for key, query in QUERIES.items()
    if query.sql is None or key.endswith("_checked") or key in ("model_info", "score_requests_stream", "monitoring_summary_text")
]
for _key in TRAINED:
    QUERIES[_key] = QUERIES.pop(_key)
