from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from shelfcast.functions.workspace import release  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", f"file://{tmp_path_factory.mktemp('shared')}")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    release(session)
    session.stop()


@pytest.fixture(scope="session")
def folder():
    if not Path(SMALL).exists():
        pytest.skip("driver tables are not here")
    return SMALL


@pytest.fixture(scope="session", autouse=True)
def small_models():
    """Fewer rounds and trees: the registered model queries are only checked for shape here."""
    from shelfcast.plans import inputs

    inputs.QUERY_ROUNDS, inputs.QUERY_TREES = 2, 2
