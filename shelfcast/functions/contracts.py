"""Input contracts: required columns and unique keys."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def require_columns(df: DataFrame, columns: Iterable[str], what: str = "columns") -> DataFrame:
    """Return ``df`` unchanged, or raise ``ValueError`` naming every missing column."""
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ValueError(f"Missing required {what}: {missing}")
    return df


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row, with their row count."""
    return df.groupBy(*keys).agg(F.count("*").alias("n_rows")).where("n_rows > 1")


def assert_unique_key(df: DataFrame, keys: Sequence[str], what: str = "table") -> DataFrame:
    """Return ``df`` unchanged, or raise ``ValueError`` when a key is repeated."""
    sample = duplicate_keys(df, keys).limit(3).collect()
    if sample:
        shown = [tuple(row[k] for k in keys) for row in sample]
        raise ValueError(f"Duplicate {tuple(keys)} in {what}: {shown}")
    return df
