"""The dashboard's questions, answered from the mart tables.

Averages come in two kinds. By default a mean over windows weighs every window alike, as the
dashboard shows it. With ``weighted`` each window counts by its flights.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ontime_spark.functions import classify
from ontime_spark.functions.numeric import exact_tenths, round_half_up, rounded_mean


def _mean_delay(weighted: bool, delay: str = "avg_arr_delay") -> Column:
    if not weighted:
        return rounded_mean(F.col(delay).cast("double"))
    flights = F.when(F.col(delay).isNotNull(), F.col("total_flights"))
    return round_half_up(
        F.try_divide(
            F.sum(F.col(delay).cast("double") * F.col("total_flights")), F.sum(flights)
        )
    )


def kpi_stats(carrier_mart: DataFrame, weighted: bool = False) -> DataFrame:
    """One row of totals; a missing figure is 0."""
    return carrier_mart.agg(
        F.coalesce(_mean_delay(weighted), F.lit(0.0)).alias("overall_avg_delay"),
        F.coalesce(F.sum("total_flights"), F.lit(0)).alias("total_flights"),
        F.coalesce(F.sum("cancellations"), F.lit(0)).alias("total_cancellations"),
        F.countDistinct("carrier").alias("carriers_tracked"),
    )


def _worst(mart: DataFrame, key: str, measures: list[Column], k: int, weighted: bool) -> DataFrame:
    # A key without any delay sorts first; the key itself breaks ties.
    return (
        mart.groupBy(key)
        .agg(_mean_delay(weighted).alias("avg_delay"), *measures)
        .orderBy(F.desc_nulls_first("avg_delay"), key)
        .limit(k)
    )


def top_carriers(carrier_mart: DataFrame, k: int = 10, weighted: bool = False) -> DataFrame:
    """The carriers with the highest mean delay."""
    measures = [
        F.sum("total_flights").alias("total_flights"),
        F.sum("cancellations").alias("cancellations"),
    ]
    return _worst(carrier_mart, "carrier", measures, k, weighted)


def top_airports(
    airport_mart: DataFrame, k: int = 10, weighted: bool = False, overlap: int = 1
) -> DataFrame:
    """The origins with the highest mean delay.

    Sliding windows overlap, so summing their flights counts each flight once per window. Give
    ``overlap`` (window length over slide, 3 for 15 and 5 minutes) to count each flight once.
    """
    flights = F.sum("total_flights")
    if overlap != 1:
        flights = F.floor(flights / overlap)
    return _worst(airport_mart, "origin", [flights.alias("total_flights")], k, weighted)


def _exact_mean(delay: str = "arrDelay") -> Column:
    """The mean over flights, from the sums that a mart keeps."""
    return round_half_up(F.try_divide(F.sum(f"{delay}_sum"), F.sum(f"{delay}_n")))


def kpi_totals(carrier_mart: DataFrame) -> DataFrame:
    """As :func:`kpi_stats`, with the mean over flights; the mart is read with its sums."""
    return carrier_mart.agg(
        F.coalesce(_exact_mean(), F.lit(0.0)).alias("overall_avg_delay"),
        F.coalesce(F.sum("flights"), F.lit(0)).alias("total_flights"),
        F.coalesce(F.sum("cancels"), F.lit(0)).alias("total_cancellations"),
        F.countDistinct("carrier").alias("carriers_tracked"),
    )


def top_totals(mart: DataFrame, key: str, k: int = 10) -> DataFrame:
    """The keys with the highest mean over their flights; the mart is read with its sums."""
    return (
        mart.groupBy(key)
        .agg(_exact_mean().alias("avg_delay"), F.sum("flights").alias("total_flights"), F.sum("cancels").alias("cancellations"))
        .orderBy(F.desc_nulls_first("avg_delay"), key)
        .limit(k)
    )


# The causes on the chart, with their mart columns. Security is not shown.
CHART_CAUSES = (
    ("Carrier", "avg_carrier_delay"),
    ("Weather", "avg_weather_delay"),
    ("NAS", "avg_nas_delay"),
    ("Late Aircraft", "avg_late_aircraft_delay"),
)


def delay_causes(cause_mart: DataFrame) -> DataFrame:
    """Mean minutes of each cause shown, one row per cause; a missing mean is 0."""
    means = cause_mart.agg(
        *(
            F.coalesce(rounded_mean(F.col(column).cast("double")), F.lit(0.0)).alias(label)
            for label, column in CHART_CAUSES
        )
    )
    return means.unpivot([], [F.col(f"`{label}`") for label, _ in CHART_CAUSES], "cause", "minutes")


# The columns of a listed prediction.
PREDICTION_COLUMNS = (
    "carrier",
    "flight_number",
    "origin",
    "dest",
    "dep_delay",
    "actual_delay",
    "predicted_delay",
    "processed_at",
)


LATEST = 20  # predictions shown


def latest_predictions(predictions: DataFrame, k: int = LATEST) -> DataFrame:
    """The newest predictions. Rows of one batch share a time, so the rest of the row orders them."""
    rest = [c for c in PREDICTION_COLUMNS if c != "processed_at"]
    return (
        predictions.select(*PREDICTION_COLUMNS)
        .orderBy(F.desc_nulls_first("processed_at"), *rest)
        .limit(k)
    )


def airport_leaderboard(
    airport_mart: DataFrame, k: int = 10, weighted: bool = False, overlap: int = 1
) -> DataFrame:
    """The worst airports with rank, medal, bar length, colour and tag.

    The windows without partition run over the k rows of the list only.
    """
    top = top_airports(airport_mart, k, weighted, overlap)
    ranked = Window.orderBy(F.desc_nulls_first("avg_delay"), "origin")
    longest = F.greatest(F.max("avg_delay").over(Window.partitionBy()), F.lit(1.0))
    rank = F.row_number().over(ranked)
    delay = F.coalesce(F.col("avg_delay"), F.lit(0.0))
    share = exact_tenths(F.greatest(F.lit(0.0), delay / longest * 100.0))
    return top.select(
        rank.alias("rank"),
        classify.medal(rank).alias("medal"),
        "origin",
        "avg_delay",
        share.alias("bar_share"),
        classify.severity_colour(F.col("avg_delay")).alias("bar_colour"),
        "total_flights",
        classify.severity_tag(F.col("avg_delay")).alias("severity"),
    )


def prediction_board(predictions: DataFrame, k: int = LATEST) -> DataFrame:
    """The newest predictions as shown: labels, late flags and how close each one came."""
    c = F.col
    return latest_predictions(predictions, k).select(
        classify.flight_label(c("carrier"), c("flight_number")).alias("flight"),
        classify.route_label(c("origin"), c("dest")).alias("route"),
        classify.minutes_label(c("dep_delay")).alias("departure"),
        classify.late_flag(c("dep_delay")).alias("departure_late"),
        classify.minutes_label_tenths(c("predicted_delay")).alias("predicted"),
        classify.minutes_label(c("actual_delay")).alias("actual"),
        classify.late_flag(c("actual_delay")).alias("actual_late"),
        classify.accuracy_tag(c("actual_delay"), c("predicted_delay")).alias("accuracy"),
        "processed_at",
    )


def airport_count(airport_mart: DataFrame, k: int = 10) -> DataFrame:
    """Airports listed, at most ``k``, and beside it the number there are."""
    return (
        airport_mart.groupBy("origin")
        .agg(F.lit(1).alias("one"))
        .agg(
            F.least(F.count("*"), F.lit(k)).alias("airports_listed"),
            F.count("origin").alias("airports_tracked"),
        )
    )
