from __future__ import annotations

import pandas as pd
import pytest
from plans import executed, scans
from pyspark.sql import functions as F

from shelfcast.functions import contracts
from shelfcast.operators import cleaning
from shelfcast.sources import files, standin

CUTOFF = "2025-06-30"
RAW = [
    # date, product, quantity, price
    ("2025-01-01", "P1", 5.0, 10.0),
    ("2025-01-01", "P1", 5.0, 10.0),  # exact copy
    ("2025-01-02", "P1", 4.0, None),  # price becomes the median of 10, 20, 60
    ("2025-01-03", "P1", 3.0, 20.0),
    ("2025-01-04", "P1", 0.0, 60.0),
    ("2025-01-05", "P1", -2.0, 30.0),  # negative quantity
    ("2025-01-06", "P1", 2.0, -30.0),  # negative price
    ("2025-01-07", "P1", None, 90.0),  # no target
    ("2025-13-40", "P1", 1.0, 90.0),  # no such day
    ("2026-01-15", "P1", 1.0, 90.0),  # after the cutoff
    (None, "P1", 1.0, 90.0),
    ("2025-01-01", "P2", 1.0, None),  # no price known for the product
    ("2025-01-01", "P3", 1.0, 7.0),
    ("2025-01-02", "P3", 1.0, 8.0),
    ("2025-01-03", "P3", 1.0, None),  # median of two is their mean
]


@pytest.fixture()
def raw(spark):
    return spark.createDataFrame(RAW, "date string, product_id string, quantity double, price double")


def test_cleaning_in_order(raw):
    clean = cleaning.clean_sales(raw, CUTOFF)
    rows = {(r.product_id, r.date.isoformat()): (r.quantity, r.price) for r in clean.collect()}
    assert clean.count() == len(rows) == 8
    assert rows["P1", "2025-01-02"] == (4, 20.0)
    assert rows["P1", "2025-01-04"] == (0, 60.0)
    assert rows["P2", "2025-01-01"] == (1, None)
    assert rows["P3", "2025-01-03"] == (1, 7.5)
    assert dict(clean.dtypes)["quantity"] == "bigint" and dict(clean.dtypes)["date"] == "date"
    report = cleaning.cleaning_report(raw, CUTOFF).first()
    assert (report.rows_before, report.rows_after, report.rows_removed) == (15, 8, 7)
    assert report.share_removed == pytest.approx(7 / 15)


def test_branches_share_one_scan_and_one_shuffle(spark, folder):
    clean = cleaning.clean_sales(standin.sales_raw(spark, folder), "2001-11-04")
    plan = executed(clean)
    assert scans(plan, "lineitem") == 1, plan
    assert "ReusedExchange" in plan


def test_profile(raw):
    assert cleaning.exact_duplicates(raw).first()[0] == 1
    assert cleaning.key_duplicates(raw, ["date", "product_id"]).first()[0] == 1
    assert tuple(cleaning.invalid_numeric(raw).first()) == (1, 1, 1)
    dates = cleaning.date_problems(raw, CUTOFF).first()
    assert (dates.missing_dates, dates.unparsable_dates, dates.future_dates) == (1, 1, 1)
    nulls = {r.column_name: r.n_null for r in cleaning.null_counts(raw).collect()}
    assert nulls == {"date": 1, "product_id": 0, "quantity": 1, "price": 3}
    shape = {r.column_name: (r.position, r.data_type, r.n_rows) for r in cleaning.profile_shape(raw).collect()}
    assert shape["price"] == (4, "double", 15)


def test_describe_matches_pandas(raw):
    found = {r.column_name: r for r in cleaning.profile_describe(raw).collect()}
    expected = pd.DataFrame(RAW, columns=["date", "product_id", "quantity", "price"]).describe(include="all")
    for name in ("quantity", "price"):
        r, e = found[name], expected[name]
        assert [r.n_values, r.mean, r.std, r.min, r.q25, r.q50, r.q75, r.max] == pytest.approx(
            [e["count"], e["mean"], e["std"], e["min"], e["25%"], e["50%"], e["75%"], e["max"]]
        )
    r, e = found["product_id"], expected["product_id"]
    assert (r.n_values, r.n_unique, r.top, r.top_freq) == (e["count"], e["unique"], e["top"], e["freq"])
    assert r.mean is None


def test_stats_skip_what_is_not_a_finite_number(spark):
    rows = [("1",), ("3",), ("nan",), ("inf",), ("-inf",), ("x",), (None,)]
    df = spark.createDataFrame(rows, "v string").withColumns({"one": F.when(F.col("v") == "1", 1.0), "no": F.lit(None).cast("double")})
    found = {r.column_name: r for r in cleaning.safe_stats(df, ["v", "one", "no"]).collect()}
    assert (found["v"].mean, found["v"].min, found["v"].max) == (2.0, 1.0, 3.0)
    assert found["v"].std == pytest.approx(2**0.5)
    assert found["one"].mean == 1.0 and found["one"].std is None
    assert found["no"].mean is None


def test_contracts(spark, raw):
    assert contracts.require_columns(raw, ["date"]) is raw
    with pytest.raises(ValueError, match=r"\['a', 'b'\]"):
        contracts.require_columns(raw, ["b", "a", "date"])
    with pytest.raises(ValueError, match="Duplicate"):
        contracts.assert_unique_key(raw, ["product_id"])


def test_files(spark, raw, tmp_path):
    path = files.write_report(raw, str(tmp_path / "raw"), "csv")
    back = files.read_table(spark, path, raw.schema)
    assert back.exceptAll(raw).isEmpty() and raw.exceptAll(back).isEmpty()
    assert files.read_table(spark, path, raw.schema, ["price"]).columns == ["price"]
    with pytest.raises(ValueError):
        files.write_report(raw, path, "xml")
    files.register_views(spark, sales=raw)
    with pytest.raises(ValueError, match="broken"):
        files.run_sql_catalog(spark, {"fine": "SELECT 1", "broken": "SELECT nothing FROM sales"})
    first = files.preview(raw.where("date IS NOT NULL"), ["date", "product_id"], 3).collect()
    assert len(first) == 3 and {r.total_rows for r in first} == {14}
