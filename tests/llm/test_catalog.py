"""Registered queries against their reference SQL on the smallest tables."""

from __future__ import annotations

import compare
import pytest

from shelfcast.llm import catalog


@pytest.fixture(scope="module")
def duck(folder):
    connection = compare.connect(folder)
    yield connection
    connection.close()


@pytest.mark.parametrize("key", sorted(catalog.ORACLE_SQL))
def test_result_equals_reference_sql(spark, folder, duck, key):
    assert compare.difference(catalog.QUERIES[key](spark, folder), duck, catalog.ORACLE_SQL[key]) is None
