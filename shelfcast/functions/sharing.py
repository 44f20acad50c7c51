"""Plans whose shuffle several branches can read."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def counted_once(df: DataFrame, columns: Sequence[str], count: str) -> DataFrame:
    """Distinct rows of ``columns`` with their number, behind a shuffle that runs once.

    A branch that filters or joins the result would normally have its conditions pushed below the
    aggregation, which gives every branch a shuffle of its own. Here each column also depends on
    the count, which exists only above the aggregation, so all branches keep the same plan below it
    and Spark reuses the exchange.
    """
    counted = df.groupBy(*columns).agg(F.count("*").alias(count))
    return counted.select(
        *[F.when(F.col(count) > 0, F.col(name)).alias(name) for name in columns], count
    )


def tied(column: str, other: str) -> Column:
    """``column`` in a form that also reads ``other``.

    A branch that needs only some of the aggregates would otherwise compute just those, in a shuffle
    of its own. The condition holds for every row: a hash is never below the smallest integer.
    """
    return F.when(F.xxhash64(column, other) >= F.lit(-(2**63)), F.col(column)).alias(column)
