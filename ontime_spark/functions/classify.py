"""Classes and labels of a row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ontime_spark.functions.numeric import exact_tenths
from ontime_spark.schemas import CAUSE_DELAYS


def delay_category(arr_delay: Column) -> Column:
    """Class of an arrival delay. A missing delay is on time; NaN is severe."""
    return (
        F.when(arr_delay.isNull() | (arr_delay <= 0), "OnTime")
        .when(arr_delay < 30, "Minor")
        .when(arr_delay <= 120, "Major")
        .otherwise("Severe")
    )


def is_delayed(arr_del15: Column) -> Column:
    return F.coalesce(arr_del15 == 1, F.lit(False))


def total_cause_delay(causes: tuple[str, ...] = CAUSE_DELAYS) -> Column:
    """Sum of the cause delays, a missing one counting zero."""
    total = F.lit(0.0)
    for cause in causes:
        total = total + F.coalesce(F.col(cause), F.lit(0.0))
    return total


def severity_tag(avg_delay: Column) -> Column:
    """Tag of an average delay on the board. Not the scale of :func:`delay_category`."""
    return (
        F.when(avg_delay > 20, "SEVERE")
        .when(avg_delay > 10, "MODERATE")
        .when(avg_delay > 0, "MINOR")
        .otherwise("ON TIME")
    )


def severity_colour(avg_delay: Column) -> Column:
    """Bar colour of an average delay, by the cut-offs of :func:`severity_tag`."""
    return (
        F.when(avg_delay > 20, "#ef4444")
        .when(avg_delay > 10, "#f59e0b")
        .when(avg_delay > 0, "#3b82f6")
        .otherwise("#10b981")
    )


def accuracy_tag(actual: Column, predicted: Column) -> Column:
    """How close a prediction came; a missing number counts as zero."""
    miss = F.abs(F.coalesce(actual, F.lit(0)) - F.coalesce(predicted, F.lit(0)))
    return (
        F.when(miss <= 5, "ACCURATE")
        .when(miss <= 15, "CLOSE")
        .when(miss <= 30, "FAIR")
        .otherwise("OFF")
    )


def medal(rank: Column) -> Column:
    return F.when(rank == 1, "gold").when(rank == 2, "silver").when(rank == 3, "bronze").otherwise("")


def flight_label(carrier: Column, flight_number: Column) -> Column:
    return F.concat(carrier, F.lit(" "), flight_number)


def route_label(origin: Column, dest: Column) -> Column:
    return F.concat(origin, F.lit(" → "), dest)


def _signed(x: Column, text: Column) -> Column:
    return F.concat(F.when(x > 0, "+").otherwise(""), text, F.lit(" min"))


def minutes_label(x: Column) -> Column:
    """Minutes with at most two decimals and a plus sign when late, e.g. ``+12.5 min``."""
    text = F.regexp_replace(x.try_cast("decimal(18,2)").cast("string"), r"\.?0+$", "")
    return _signed(x, text)


def minutes_label_tenths(x: Column) -> Column:
    """As :func:`minutes_label`, with exactly one decimal."""
    tenths = F.abs(exact_tenths(x.cast("double"))).cast("decimal(18,1)").cast("string")
    return _signed(x, F.concat(F.when(x < 0, "-").otherwise(""), tenths))


def late_flag(x: Column) -> Column:
    """Shown as late when above zero; zero is not late."""
    return F.coalesce(x > 0, F.lit(False))
