"""Rounding that does not depend on the order in which a sum was taken."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_up(x: Column, places: int = 2) -> Column:
    """Round on ten decimals, so that noise in the last bits of a double cannot tip a tie.

    A value no decimal can hold (NaN, infinity) becomes null.
    """
    return F.round(x.try_cast("decimal(28,10)"), places).cast("double")


def rounded_mean(c: Column | str) -> Column:
    """Mean of the non-null values to two places."""
    return round_half_up(F.avg(c))


def count_true(c: Column | str) -> Column:
    """Rows where a flag is set; null counts as not set."""
    return F.sum(F.when(F.col(c) if isinstance(c, str) else c, 1).otherwise(0))


def exact_tenths(x: Column) -> Column:
    """Nearest tenth of the exact binary value of ``x``, ties away from zero, as a number.

    20x is taken as a sum of two exact products, with the sum's own rounding error kept apart,
    so that 12.35 (which is stored just below 12.35) gives 12.3.
    """
    a = F.abs(x)
    high, low = a * 16.0, a * 4.0
    total = high + low
    tail = total - high
    error = (high - (total - tail)) + (low - tail)
    twentieths = F.floor(total) - F.when((total == F.floor(total)) & (error < 0), 1).otherwise(0)
    tenths = F.floor((twentieths + 1) / 2)
    return F.when(x < 0, -tenths / 10.0).otherwise(tenths / 10.0)
