"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Tables that several queries read are written first and timed under their own names, so that no query pays
for another one's input.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from pyspark.sql import SparkSession

from shelfcast.functions.workspace import release
from shelfcast.operators import models
from shelfcast.plans import inputs
from shelfcast.plans.catalog import QUERIES

SHARED = {
    "table_features": inputs.features,
    "table_benchmark": inputs.benchmark_encoded,
    "table_monitored": inputs.monitored,
}
HEADLINE = [
    "clean_sales", "impute_median_price", "profile_describe",
    "q1_monthly_sales", "q2_top_products", "q3_top_categories", "q4_demand_variance",
    "q5_avg_daily_demand", "q6_monthly_growth", "q7_weekday_demand", "q8_declining_products",
    "q9_category_rank", "q11_product_growth", "weekly_total", "top_products_weekly",
    "rolling_outliers_prior", "build_panel", "add_features", "drop_warmup", "q10_rolling_7d",
    "error_by_product", "error_by_category", "metrics_by_tercile", "driver_correlations",
    "driver_segments", "prepare_benchmark", "encode_categories", "naive_multistep",
    "benchmark_cv_naive", "oof_predictions_naive", "monitoring_report_naive",
]
# Fits of a fixed small size, timed last and apart; what a whole one takes follows from the rounds (README).
FITS = {
    "fit_ridge": lambda spark, folder: models.ridge_fitter()(inputs.development(spark, folder)),
    "fit_boosting_two_rounds": lambda spark, folder: models.boosting_fitter(2)(inputs.development(spark, folder)),
    "fit_forest_four_trees": lambda spark, folder: models.forest_fitter(4)(inputs.development(spark, folder)),
}


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", f"file://{tempfile.mkdtemp(prefix='bench-')}")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = os.environ.get("BENCH_QUERIES", "").split(",") if os.environ.get("BENCH_QUERIES") else [*SHARED, *HEADLINE, *FITS]
    # Executors start and code is compiled before anything is timed.
    QUERIES["q3_top_categories"].dataframe(spark, folder).collect()
    QUERIES["clean_sales"].dataframe(spark, folder).write.format("noop").mode("overwrite").save()
    seconds: dict[str, float] = {}
    for name in names:
        start = time.perf_counter()
        if name in SHARED or name in FITS:
            (SHARED | FITS)[name](spark, folder)
        else:
            QUERIES[name].dataframe(spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale) if scale.replace(".", "").isdigit() else scale,
            }
        )
    )
    release(spark)
    spark.stop()


if __name__ == "__main__":
    main()
