from __future__ import annotations

import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfcast.functions import ordered


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.tuples(
            st.sampled_from(["a", "b", "c", None]),
            st.one_of(st.none(), st.integers(-5, 5).map(float), st.floats(-1e6, 1e6)),
        ),
        min_size=1,
        max_size=60,
    )
)
def test_quantiles_match_numpy(spark, rows):
    df = spark.createDataFrame(rows, "k string, v double")
    probs = {"p0": 0.0, "p33": 1 / 3, "p50": 0.5, "p90": 0.9, "p100": 1.0}
    found = {r.k: r for r in ordered.grouped_quantiles(df, ["k"], "v", probs, ranges=4).collect()}
    groups = {}
    for k, v in rows:
        if k is not None and v is not None:
            groups.setdefault(k, []).append(v)
    assert set(found) == set(groups)
    for k, values in groups.items():
        for name, p in probs.items():
            assert found[k][name] == pytest.approx(np.quantile(values, p), rel=1e-9, abs=1e-9)


def test_whole_table_quantile_and_weights(spark):
    values = [random.Random(3).randrange(1000) / 7 for _ in range(3000)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert ordered.grouped_quantiles(df, [], "v", {"q": 0.9}).first().q == pytest.approx(
        np.quantile(values, 0.9)
    )
    counted = df.groupBy("v").agg(F.count("*").alias("n"))
    assert ordered.grouped_quantiles(counted, [], "v", {"q": 0.9}, weight="n").first().q == (
        pytest.approx(np.quantile(values, 0.9))
    )


def test_ranks_of_text_values(spark):
    rows = [("k", w) for w in ["pear", "apple", "fig", "fig", "kiwi"]]
    df = spark.createDataFrame(rows, "k string, v string")
    found = {r.v: (r.n, r.n_before, r.n_after) for r in ordered.ranked_values(df, ["k"], "v", 2).collect()}
    assert found == {"apple": (1, 0, 4), "fig": (2, 1, 2), "kiwi": (1, 3, 1), "pear": (1, 4, 0)}


def test_a_key_with_most_rows_is_spread_over_the_ranges(spark):
    """Half of the rows belong to one key; no range may hold more than a small part of them."""
    df = spark.range(60000).select(
        F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("k"),
        (F.col("id") * 7919 % 60013).cast("double").alias("v"),
    )
    counts = ordered._ranged_counts(df, ["k"], "v", ranges=128)
    per_range = counts.where("k = 'hot'").groupBy("_range").agg(F.sum("_n").alias("n"))
    assert per_range.count() > 40
    assert per_range.agg(F.max("n")).first()[0] < 30000 / 8
    exact = ordered.grouped_quantiles(df, ["k"], "v", {"m": 0.5}, ranges=128)
    builtin = df.groupBy("k").agg(F.percentile("v", 0.5).alias("e"))
    assert exact.join(builtin, "k").where(F.abs(F.col("m") - F.col("e")) > 1e-9).isEmpty()


def test_empty_input(spark):
    df = spark.createDataFrame([], "k string, v double")
    assert ordered.grouped_quantiles(df, ["k"], "v", {"m": 0.5}).isEmpty()
    assert ordered.ranked_values(df, ["k"], "v").isEmpty()
