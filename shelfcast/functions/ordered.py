"""Exact ranks and quantiles that do not put a whole group into one task.

A window over ``partitionBy(key).orderBy(value)`` sorts each key in a single task, and the built-in
exact percentile holds every distinct value of a key in one aggregation buffer. Both break down
when one key owns a large share of the table. Here the distinct ``(key, value)`` pairs are counted
first (map-side combine), cut into ordered ranges by splitters taken from a bounded hash sample,
and ranked range by range; the rows before each range are added from one small table of range
totals. A key that owns a third of the data is spread over about a third of the ranges.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _range_count(df: DataFrame) -> int:
    return max(32, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def _ranged_counts(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    ranges: int | None = None,
    weight: str | None = None,
) -> DataFrame:
    """Distinct (keys, value) with row count ``_n`` and ordered range number ``_range``."""
    present = df.where(F.col(value).isNotNull())
    for key in keys:
        present = present.where(F.col(key).isNotNull())
    rows = F.sum(weight) if weight else F.count("*")
    counts = present.groupBy(*keys, value).agg(rows.alias("_n"))
    pair = F.struct(*keys, value)
    limit = ranges or _range_count(df)
    # The condition on the count is always true: it keeps the sampled plan equal to the plan that is
    # ranked, so that the counting shuffle runs once and is reused.
    splitters = (
        counts.where("_n > 0")
        .select(pair.alias("_pair"))
        .orderBy(F.xxhash64("_pair"))
        .limit(limit)
        .agg(F.array_sort(F.collect_list("_pair")))
        .scalar()
    )
    # Splitters below the pair, found by halving: plain expressions that stay in generated code. The
    # range is never null, or joins on it would push a null test on it below the counting.
    ranged = counts.withColumns({"_splitters": splitters, "_pair": pair, "_range": F.lit(0)})
    for bit in reversed(range(limit.bit_length())):
        probe = F.get("_splitters", F.col("_range") + ((1 << bit) - 1))
        ranged = ranged.withColumn(
            "_range", F.col("_range") + F.when(probe < F.col("_pair"), 1 << bit).otherwise(0)
        )
    return ranged.drop("_splitters", "_pair")


def _range_totals(counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per (keys, range): rows of the key before the range, in it, and in all."""
    per_key = Window.partitionBy(*keys)
    earlier = per_key.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    return (
        counts.groupBy(*keys, "_range")
        .agg(F.sum("_n").alias("_in_range"))
        .select(
            *keys,
            "_range",
            "_in_range",
            F.coalesce(F.sum("_in_range").over(earlier), F.lit(0)).alias("_offset"),
            F.sum("_in_range").over(per_key).alias("_total"),
        )
    )


def _positions(counts: DataFrame, totals: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    inside = (
        Window.partitionBy(*keys, "_range")
        .orderBy(value)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return counts.join(totals, [*keys, "_range"]).withColumn(
        "_before", F.col("_offset") + F.coalesce(F.sum("_n").over(inside), F.lit(0))
    )


def ranked_values(
    df: DataFrame, keys: Sequence[str], value: str, ranges: int | None = None
) -> DataFrame:
    """One row per distinct non-null ``(keys, value)``.

    ``n`` rows hold the value, ``n_before`` rows of the same key sort strictly before it and
    ``n_after`` strictly after it. ``n_before + 1`` is the SQL ``RANK`` in ascending order,
    ``n_after + 1`` in descending order.
    """
    counts = _ranged_counts(df, keys, value, ranges)
    placed = _positions(counts, _range_totals(counts, keys), keys, value)
    return placed.select(
        *keys,
        value,
        F.col("_n").alias("n"),
        F.col("_before").alias("n_before"),
        (F.col("_total") - F.col("_before") - F.col("_n")).alias("n_after"),
    )


def grouped_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    probs: dict[str, float],
    ranges: int | None = None,
    weight: str | None = None,
) -> DataFrame:
    """Exact linearly interpolated quantiles, one row per key and one column per entry of ``probs``.

    Only the ranges that hold a wanted position are sorted. ``weight`` names a column with the
    number of rows each input row stands for.
    """
    counts = _ranged_counts(df, keys, value, ranges, weight)
    totals = _range_totals(counts, keys)

    def low(p: float):
        return F.floor(F.lit(p) * (F.col("_total") - 1))

    def high(p: float):
        return F.ceil(F.lit(p) * (F.col("_total") - 1))

    def holds(position, start, length):
        return (position >= F.col(start)) & (position < F.col(start) + F.col(length))

    wanted = F.lit(False)
    for p in probs.values():
        wanted = wanted | holds(low(p), "_offset", "_in_range")
        wanted = wanted | holds(high(p), "_offset", "_in_range")
    placed = _positions(counts, totals.where(wanted), keys, value)

    bounds = []
    for name, p in probs.items():
        bounds.append(F.max(F.when(holds(low(p), "_before", "_n"), F.col(value))).alias(f"_lo_{name}"))
        bounds.append(F.max(F.when(holds(high(p), "_before", "_n"), F.col(value))).alias(f"_hi_{name}"))
    found = placed.groupBy(*keys).agg(F.max("_total").alias("_total"), *bounds)
    outputs = []
    for name, p in probs.items():
        share = F.lit(p) * (F.col("_total") - 1) - low(p)
        lower, upper = F.col(f"_lo_{name}"), F.col(f"_hi_{name}")
        outputs.append((lower + (upper - lower) * share).alias(name))
    return found.select(*keys, *outputs)
