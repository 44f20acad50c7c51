"""Small numeric column helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def fixed(value: Column | str, places: int) -> Column:
    """Round half-up on the decimal digits, as a double.

    Going through a DECIMAL with three more places drops the noise a distributed sum leaves in the
    last bits, so a value on a rounding edge comes out the same whatever the order of summation was.
    """
    column = F.col(value) if isinstance(value, str) else value
    return F.round(column.cast(f"decimal(38,{places + 3})"), places).cast("double")


def numeric(value: Column | str) -> Column:
    """A double where the value is a finite number, null otherwise (also for NaN and infinities)."""
    column = F.col(value) if isinstance(value, str) else value
    number = column.try_cast("double")
    return F.when(F.abs(number) < F.lit(float("inf")), number)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division that gives null for a zero denominator."""
    return F.try_divide(numerator, denominator)
