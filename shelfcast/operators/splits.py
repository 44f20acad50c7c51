"""Chronological splits. A fold is computed from the distance to the last date, without a join."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.functions.timegrid import latest

HOLDOUT_DAYS = 60
FOLDS = 4
FOLD_DAYS = 60
BENCHMARK_HORIZON = 28
BENCHMARK_FOLDS = 4


@dataclass(frozen=True)
class Fold:
    fold: int
    train_end: dt.date
    test_start: dt.date
    test_end: dt.date

    def train(self, df: DataFrame, day: str = "date") -> DataFrame:
        return df.where(F.col(day) <= F.lit(self.train_end))

    def test(self, df: DataFrame, day: str = "date") -> DataFrame:
        return df.where(F.col(day).between(F.lit(self.test_start), F.lit(self.test_end)))


def _age(last: Column, day: str) -> Column:
    """Days before the last date: 0 on the last date."""
    return F.datediff(last, F.col(day))


def holdout_split(
    df: DataFrame, days: int = HOLDOUT_DAYS, day: str = "date", last: Column | None = None
) -> DataFrame:
    """Add ``split``: the last ``days`` days are ``test``, everything earlier ``development``.

    ``last`` names the last date when a cheaper table than ``df`` knows it.
    """
    age = _age(latest(df, day) if last is None else last, day)
    return df.withColumn("split", F.when(age < days, "test").otherwise("development"))


def holdout_frames(
    df: DataFrame, days: int = HOLDOUT_DAYS, day: str = "date"
) -> tuple[DataFrame, DataFrame]:
    """Development and test rows; raises if either side is empty.

    The two date bounds are fetched first, so that the filters are literals a scan can use.
    """
    bounds = df.agg(F.min(day).alias("first"), F.max(day).alias("last")).first()
    if bounds["last"] is None:
        raise ValueError("The table holds no dates, so there is no holdout.")
    start = bounds["last"] - dt.timedelta(days=days - 1)
    if bounds["first"] >= start:
        raise ValueError(f"All dates fall into the last {days} days, so no development rows remain.")
    return df.where(F.col(day) < F.lit(start)), df.where(F.col(day) >= F.lit(start))


def time_series_folds(
    df: DataFrame, n_folds: int = FOLDS, days: int = FOLD_DAYS, day: str = "date"
) -> list[Fold]:
    """Expanding folds that end at the last date, oldest first."""
    facts = df.agg(F.count_distinct(day).alias("dates"), F.max(day).alias("last")).first()
    needed = (n_folds + 1) * days
    if facts["dates"] < needed:
        raise ValueError(
            f"Not enough dates for {n_folds} folds of {days} days: "
            f"{needed} unique dates needed, {facts['dates']} found."
        )
    folds = []
    for number in range(1, n_folds + 1):
        end = facts["last"] - dt.timedelta(days=days * (n_folds - number))
        start = end - dt.timedelta(days=days - 1)
        folds.append(Fold(number, start - dt.timedelta(days=1), start, end))
    for fold in folds:
        if fold.test(df, day).isEmpty() or fold.train(df, day).isEmpty():
            raise ValueError(f"No training or no validation rows in {fold}")
    return folds


def fold_table(
    df: DataFrame, n_folds: int = FOLDS, days: int = FOLD_DAYS, day: str = "date"
) -> DataFrame:
    """The folds as rows: number, training end, test start, test end."""
    number = F.explode(F.sequence(F.lit(1), F.lit(n_folds))).alias("fold")
    ends = df.agg(F.max(day).alias("last")).select("last", number)
    end = F.date_sub("last", F.lit(days) * (F.lit(n_folds) - F.col("fold")))
    return ends.select(
        "fold",
        F.date_sub(end, days).alias("train_end"),
        F.date_sub(end, days - 1).alias("test_start"),
        end.alias("test_end"),
    )


def assign_folds(
    df: DataFrame,
    n_folds: int = FOLDS,
    days: int = FOLD_DAYS,
    day: str = "date",
    last: Column | None = None,
) -> DataFrame:
    """Validation rows with their fold number; earlier rows, which only ever train, drop out."""
    age = _age(latest(df, day) if last is None else last, day)
    return df.where(age < n_folds * days).withColumn(
        "fold", (F.lit(n_folds) - F.floor(age / days)).cast("int")
    )


def benchmark_windows(
    df: DataFrame,
    horizon: int = BENCHMARK_HORIZON,
    n_folds: int = BENCHMARK_FOLDS,
    day: str = "date",
) -> DataFrame:
    """Windows of ``horizon`` days walking back from the holdout; window 1 is the newest."""
    number = F.explode(F.sequence(F.lit(1), F.lit(n_folds))).alias("fold")
    ends = df.agg(F.max(day).alias("last")).select("last", number)
    end = F.date_sub("last", F.lit(horizon) * F.col("fold"))
    return ends.select(
        "fold",
        F.date_sub(end, horizon).alias("train_end"),
        F.date_sub(end, horizon - 1).alias("validation_start"),
        end.alias("validation_end"),
    )


def benchmark_folds(
    df: DataFrame,
    horizon: int = BENCHMARK_HORIZON,
    n_folds: int = BENCHMARK_FOLDS,
    day: str = "date",
) -> list[Fold]:
    rows = benchmark_windows(df, horizon, n_folds, day).orderBy("fold").collect()
    return [Fold(r.fold, r.train_end, r.validation_start, r.validation_end) for r in rows]


def final_flag(
    df: DataFrame,
    horizon: int = BENCHMARK_HORIZON,
    day: str = "date",
    last: Column | None = None,
) -> DataFrame:
    """Mark the last ``horizon`` days with ``is_final_test`` = 1."""
    age = _age(latest(df, day) if last is None else last, day)
    return df.withColumn("is_final_test", F.when(age < horizon, 1).otherwise(0))
