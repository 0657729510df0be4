"""The three windowed aggregates, for batch and streaming frames.

All measures are sums and counts at heart, so Spark combines them before the shuffle and a hot
carrier, airport or window sends one row per task. ``time_col`` is ``processingTime`` for a live
stream or any event-time column. Without ``watermark`` a stream keeps every window for ever.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ontime_spark.functions.numeric import count_true, round_half_up, rounded_mean

TUMBLING = "5 minutes"
SLIDING = "15 minutes"


def _sums(df: DataFrame, group: list[Column | str], delays: tuple[str, ...], flights: bool = True) -> DataFrame:
    """The sum and number of each delay, and flights, by ``group``: what any two groups add up from."""
    measures = [m for d in delays for m in (F.sum(d).alias(f"{d}_sum"), F.count(d).alias(f"{d}_n"))]
    if flights:
        measures += [F.count("*").alias("flights"), count_true("cancelled").alias("cancels")]
    return df.groupBy(*group).agg(*measures)


def _mean(delay: str) -> Column:
    return round_half_up(F.try_divide(F.col(f"{delay}_sum"), F.col(f"{delay}_n")))


CARRIER_MEANS = {
    "avg_arr_delay": "arrDelay", "avg_dep_delay": "depDelay",
    "avg_weather_delay": "weatherDelay", "avg_carrier_delay": "carrierDelay",
}
AIRPORT_MEANS = {"avg_arr_delay": "arrDelay"}
CAUSE_MEANS = {
    "avg_carrier_delay": "carrierDelay", "avg_weather_delay": "weatherDelay", "avg_nas_delay": "nasDelay",
    "avg_security_delay": "securityDelay", "avg_late_aircraft_delay": "lateAircraftDelay",
}


def _tumbling_sums(df: DataFrame, time_col: str, window: str, key: list[str], delays, flights: bool) -> DataFrame:
    sums = _sums(df.where(F.col(time_col).isNotNull()), [F.window(time_col, window), *key], tuple(delays), flights)
    return sums.select(*_bounds(), *key, *(c for c in sums.columns if c not in ("window", *key)))


def carrier_sums(df: DataFrame, time_col: str = "processingTime", window: str = TUMBLING) -> DataFrame:
    """What :func:`carrier_delays` is made from, per window and carrier; rows without carrier are left out."""
    return _tumbling_sums(df.where("carrier is not null"), time_col, window, ["carrier"], CARRIER_MEANS.values(), True)


def cause_sums(df: DataFrame, time_col: str = "processingTime", window: str = TUMBLING) -> DataFrame:
    """What :func:`cause_delays` is made from, per window."""
    return _tumbling_sums(df, time_col, window, [], CAUSE_MEANS.values(), False)


def airport_sums(
    df: DataFrame, time_col: str = "processingTime", window: str = SLIDING, slide: str = TUMBLING
) -> DataFrame:
    """What :func:`airport_delays` is made from, per sliding window and origin; rows without origin are left out.

    A flight is summed into its slide first where windows are made of whole slides, and the sums are copied.
    """
    rows = df.where(F.col("origin").isNotNull() & F.col(time_col).isNotNull())
    if is_multiple(window, slide):
        panes = _sums(rows, [F.window(time_col, slide).alias("pane"), "origin"], ("arrDelay",))
        measures = [c for c in panes.columns if c not in ("pane", "origin")]
        panes = panes.select(F.col("pane.start").alias("pane_start"), "origin", *measures)
        sums = panes.groupBy(F.window("pane_start", window, slide), "origin").agg(*(F.sum(m).alias(m) for m in measures))
    else:
        sums = _sums(rows, [F.window(time_col, window, slide), "origin"], ("arrDelay",))
    return sums.select(*_bounds(), "origin", *(c for c in sums.columns if c not in ("window", "origin")))


def _with_means(sums: DataFrame, means: dict[str, str]) -> DataFrame:
    made = {name: _mean(delay) for name, delay in means.items()}
    if "flights" in sums.columns:
        made |= {"total_flights": F.col("flights"), "cancellations": F.col("cancels")}
    return sums.withColumns(made)


def carrier_means(sums: DataFrame) -> DataFrame:
    return _with_means(sums, CARRIER_MEANS)


def airport_means(sums: DataFrame) -> DataFrame:
    return _with_means(sums, AIRPORT_MEANS)


def cause_means(sums: DataFrame) -> DataFrame:
    return _with_means(sums, CAUSE_MEANS)


def with_watermark(df: DataFrame, time_col: str, watermark: str | None) -> DataFrame:
    """Let a stream drop windows this far behind. Time without zone is read as session time."""
    if watermark is None:
        return df
    return df.withColumn(time_col, F.col(time_col).cast("timestamp")).withWatermark(
        time_col, watermark
    )


def _bounds() -> tuple[Column, Column]:
    return F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end")


def carrier_delays(
    df: DataFrame,
    time_col: str = "processingTime",
    window: str = TUMBLING,
    watermark: str | None = None,
) -> DataFrame:
    """Per tumbling window and carrier: mean delays, flights, cancellations."""
    return (
        with_watermark(df, time_col, watermark)
        .groupBy(F.window(time_col, window), "carrier")
        .agg(
            rounded_mean("arrDelay").alias("avg_arr_delay"),
            rounded_mean("depDelay").alias("avg_dep_delay"),
            F.count("*").alias("total_flights"),
            count_true("cancelled").alias("cancellations"),
            rounded_mean("weatherDelay").alias("avg_weather_delay"),
            rounded_mean("carrierDelay").alias("avg_carrier_delay"),
        )
        .select(
            *_bounds(),
            "carrier",
            "avg_arr_delay",
            "avg_dep_delay",
            "total_flights",
            "cancellations",
            "avg_weather_delay",
            "avg_carrier_delay",
        )
    )


SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}


def seconds_of(span: str) -> int | None:
    """The seconds of a span such as ``1 hour 30 minutes``; None for one in other units."""
    words = span.lower().removeprefix("interval ").split()
    total = 0
    for number, unit in zip(words[::2], words[1::2]):
        unit = unit.removesuffix("s")
        if not number.isdigit() or unit not in SECONDS:
            return None
        total += int(number) * SECONDS[unit]
    return total if words and len(words) % 2 == 0 else None


def is_multiple(window: str, slide: str) -> bool:
    whole, part = seconds_of(window), seconds_of(slide)
    return bool(whole and part) and whole % part == 0


def airport_delays(
    df: DataFrame,
    time_col: str = "processingTime",
    window: str = SLIDING,
    slide: str = TUMBLING,
    watermark: str | None = None,
) -> DataFrame:
    """Per sliding window and origin: mean delay, flights, cancellations.

    A flight is in window/slide windows. In batch the flights are first summed per slide, so that
    only those sums are copied into the windows and not the flights; a stream can stack no second
    aggregate in update mode and copies the flights. So does a batch whose window is no multiple of
    its slide: there a slide's flights may be in different windows.
    """
    if df.isStreaming or not is_multiple(window, slide):
        return (
            with_watermark(df, time_col, watermark)
            .groupBy(F.window(time_col, window, slide), "origin")
            .agg(
                rounded_mean("arrDelay").alias("avg_arr_delay"),
                F.count("*").alias("total_flights"),
                count_true("cancelled").alias("cancellations"),
            )
            .select(*_bounds(), "origin", "avg_arr_delay", "total_flights", "cancellations")
        )
    panes = (
        df.groupBy(F.window(time_col, slide).alias("pane"), "origin")
        .agg(
            F.sum("arrDelay").alias("delay"),
            F.count("arrDelay").alias("delays"),
            F.count("*").alias("flights"),
            count_true("cancelled").alias("cancels"),
        )
        .select(F.col("pane.start").alias("pane_start"), "origin", "delay", "delays", "flights", "cancels")
    )
    return (
        panes.groupBy(F.window("pane_start", window, slide), "origin")
        .agg(
            round_half_up(F.try_divide(F.sum("delay"), F.sum("delays"))).alias("avg_arr_delay"),
            F.sum("flights").alias("total_flights"),
            F.sum("cancels").alias("cancellations"),
        )
        .select(*_bounds(), "origin", "avg_arr_delay", "total_flights", "cancellations")
    )


def cause_delays(
    df: DataFrame,
    time_col: str = "processingTime",
    window: str = TUMBLING,
    watermark: str | None = None,
) -> DataFrame:
    """Per tumbling window: mean of each of the five cause delays."""
    return (
        with_watermark(df, time_col, watermark)
        .groupBy(F.window(time_col, window))
        .agg(
            rounded_mean("carrierDelay").alias("avg_carrier_delay"),
            rounded_mean("weatherDelay").alias("avg_weather_delay"),
            rounded_mean("nasDelay").alias("avg_nas_delay"),
            rounded_mean("securityDelay").alias("avg_security_delay"),
            rounded_mean("lateAircraftDelay").alias("avg_late_aircraft_delay"),
        )
        .select(
            *_bounds(),
            "avg_carrier_delay",
            "avg_weather_delay",
            "avg_nas_delay",
            "avg_security_delay",
            "avg_late_aircraft_delay",
        )
    )
