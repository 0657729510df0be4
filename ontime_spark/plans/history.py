"""Summaries of stored records, without windows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ontime_spark.functions import classify
from ontime_spark.functions.numeric import count_true, round_half_up, rounded_mean

# The classes of an arrival delay.
CATEGORIES = ("OnTime", "Minor", "Major", "Severe")


def delay_summary(records: DataFrame, *keys: str) -> DataFrame:
    """Per key: flights, cancellations, late flights, flights per delay class, cause minutes."""
    rows = records.select(
        *keys,
        "cancelled",
        "arrDelay",
        classify.is_delayed(F.col("arrDel15")).alias("late"),
        classify.delay_category(F.col("arrDelay")).alias("category"),
        classify.total_cause_delay().alias("cause_minutes"),
    )
    return rows.groupBy(*keys).agg(
        F.count("*").alias("total_flights"),
        count_true("cancelled").alias("cancellations"),
        F.count_if("late").alias("delayed_flights"),
        *(
            F.count_if(F.col("category") == name).alias(f"{name.lower()}_flights")
            for name in CATEGORIES
        ),
        rounded_mean("arrDelay").alias("avg_arr_delay"),
        round_half_up(F.sum("cause_minutes")).alias("cause_minutes"),
    )
