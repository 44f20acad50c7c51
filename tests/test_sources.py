"""Inputs derived from the driver tables follow the data, and written tables go where they are told."""

from __future__ import annotations

import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from shelfcast.functions import workspace
from shelfcast.sources import standin


def test_events_after_a_month_are_kept(spark, tmp_path):
    first = dt.datetime(2024, 1, 1, 12)
    rows = [(1, first), (1, first + dt.timedelta(days=30)), (2, first + dt.timedelta(days=44))]
    spark.createDataFrame(rows, "user_id long, ts timestamp").write.parquet(f"{tmp_path}/events.parquet")
    wide = standin.wide_demand(spark, str(tmp_path))
    assert wide.columns == ["id", *[f"d_{n}" for n in range(1, 46)]]
    found = {r["id"]: r for r in wide.collect()}
    assert (found["U1"]["d_1"], found["U1"]["d_31"], found["U2"]["d_45"], found["U2"]["d_31"]) == (1, 1, 1, 0)
    assert standin.calendar(spark, str(tmp_path)).count() == 45


def test_a_session_without_a_folder_raises(spark):
    class Bare:
        conf = type("Conf", (), {"get": staticmethod(lambda key, default: default)})

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        workspace.shared_folder(Bare())
    Bare.conf.get = staticmethod(lambda key, default: "/own/" if key == workspace.OWN_SETTING else default)
    assert workspace.shared_folder(Bare()) == "/own"


def test_superseded_tables_are_deleted(spark):
    old = workspace.materialize(spark.range(3), "old")
    place = Path(old.inputFiles()[0].removeprefix("file://")).parent
    new = workspace.replace(old, old.select(F.col("id") + 1), "new")
    assert not place.exists() and new.count() == 3
