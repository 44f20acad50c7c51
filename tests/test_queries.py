"""Every registered query on the driver tables: exact results and plans that scale."""

from __future__ import annotations

from urllib.parse import urlparse

import compare
import pytest
from plans import planned
from pyspark.sql import functions as F

import __spark_entry__ as entry
from shelfcast.functions.workspace import shared_folder
from shelfcast.operators import models, panel
from shelfcast.plans import inputs
from shelfcast.plans.catalog import QUERIES, TRAINED
from shelfcast.sources import standin

EXACT = [key for key, query in QUERIES.items() if query.sql]
MODELS = [key for key, query in QUERIES.items() if not query.sql]


@pytest.fixture(scope="module")
def duck(folder):
    connection = compare.connect(folder)
    yield connection
    connection.close()


@pytest.mark.parametrize("key", EXACT)
def test_result_equals_reference_sql(spark, folder, duck, key):
    query = QUERIES[key]
    assert compare.difference(query.dataframe(spark, folder), duck, query.reference()) is None


@pytest.mark.parametrize("key", MODELS)
def test_model_query_gives_rows(spark, folder, key):
    df = QUERIES[key].dataframe(spark, folder)
    rows = df.limit(5).collect()
    assert rows and df.columns == [c.partition(":")[0] for c in QUERIES[key].columns.split()]


@pytest.mark.parametrize("key", [k for k in EXACT if k not in TRAINED])
def test_no_pairwise_join_and_no_python_rows(spark, folder, key):
    plan = planned(QUERIES[key].dataframe(spark, folder))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas"):
        assert operator not in plan, f"{key} plans {operator}"


def test_entry_points(spark, folder):
    assert set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() > 1000


def test_scans_read_only_what_a_query_needs(spark, folder):
    plan = planned(QUERIES["q7_weekday_demand"].dataframe(spark, folder))
    lines = [s for s in plan.splitlines() if "ReadSchema" in s and "l_shipdate" in s]
    assert lines and all("l_extendedprice" not in s and "l_suppkey" not in s for s in lines)


def test_holdout_filter_reaches_the_written_feature_table(spark, folder):
    table = inputs.features(spark, folder).where(F.col("date") >= F.lit("2001-10-01").cast("date"))
    assert "GreaterThanOrEqual(date,2001-10-01)" in planned(table.select("quantity"))


def test_one_window_node_and_two_shuffles_build_the_features(spark, folder):
    sales = standin.sales(spark, folder)
    lines = planned(panel.add_features(panel.build_panel(sales))).splitlines()
    # Gap filling, and all features together; the second one reuses the partitioning of the first.
    assert sum(" Window [" in s for s in lines) == 2
    assert sum("Exchange hashpartitioning(product_id" in s for s in lines) == 2


def test_written_tables_go_to_the_shared_folder(spark, folder):
    path = inputs.features(spark, folder).inputFiles()[0]
    assert urlparse(path).path.startswith(urlparse(shared_folder(spark)).path + "/")


@pytest.mark.parametrize("key", ["interval_width", "prediction_intervals", "interval_metrics", "model_performance", "monitoring_report"])
def test_intervals_and_monitoring_return_every_model(spark, folder, key):
    both = {models.NAIVE, models.BOOSTING}
    whole = QUERIES[key].dataframe(spark, folder)
    column = "model" if "model" in whole.columns else "metric"
    found = lambda df: {r[0] for r in df.select(column).distinct().collect()}
    assert both <= found(whole)
    assert both & found(QUERIES[f"{key}_naive"].dataframe(spark, folder)) == {models.NAIVE}
