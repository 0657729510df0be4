"""On-time records derived from the driver's ``events`` table, lazily and row by row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ontime_spark.schemas import RAW_COLUMNS, RAW_FIELDS

EVENTS = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")


def stream_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        spark.readStream.schema(EVENTS).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    )


def as_flights(events: DataFrame) -> DataFrame:
    """Events as typed records, with ``eventId`` and ``eventTime`` in front."""
    c = F.col
    base = events.select(
        "event_id",
        "ts",
        "user_id",
        "event_type",
        "value",
        F.get_json_object("props", "$.k").cast("int").alias("k"),
        (c("event_id") % 40 == 0).alias("cancelled"),
    )
    departed = base.withColumn(
        "depDelay", F.when(~c("cancelled"), F.round(c("value") - 40.0, 2) + 0.0)
    )
    arrived = departed.withColumn(
        "arrDelay", F.round(c("depDelay") + (c("k") - 50) / 10.0, 2) + 0.0
    )
    late = c("arrDelay") >= 15

    def cause(mine: Column) -> Column:
        return F.when(late, F.when(mine, c("arrDelay")).otherwise(0.0))

    quarter = c("k") % 4
    return arrived.select(
        c("event_id").alias("eventId"),
        c("ts").alias("eventTime"),
        c("ts").cast("date").alias("flightDate"),
        F.month("ts").alias("month"),
        (F.weekday("ts") + 1).alias("dayOfWeek"),
        F.upper(F.substring("event_type", 1, 2)).alias("carrier"),
        (c("user_id") + 100).cast("string").alias("flightNumber"),
        F.concat(F.lit("O"), (c("user_id") % 25).cast("string")).alias("origin"),
        F.concat(F.lit("City O"), (c("user_id") % 25).cast("string"), F.lit(", ST")).alias("originCity"),
        F.lit("ST").alias("originState"),
        F.concat(F.lit("D"), _dest_no().cast("string")).alias("dest"),
        F.concat(F.lit("City D"), _dest_no().cast("string"), F.lit(", ST")).alias("destCity"),
        F.lit("ST").alias("destState"),
        F.lit(800).alias("crsDepTime"),
        F.when(~c("cancelled"), F.lit(800) + c("k") % 60).alias("depTime"),
        "depDelay",
        F.when(c("depDelay") >= 15, 1).when(c("depDelay").isNotNull(), 0).alias("depDel15"),
        F.lit(1100).alias("crsArrTime"),
        F.when(~c("cancelled"), F.lit(1100) + c("k") % 60).alias("arrTime"),
        "arrDelay",
        F.when(late, 1).when(c("arrDelay").isNotNull(), 0).alias("arrDel15"),
        "cancelled",
        F.when(c("cancelled"), "B").alias("cancellationCode"),
        (F.lit(200) + (c("user_id") * 37) % 2500).cast("double").alias("distance"),
        cause(quarter == 0).alias("carrierDelay"),
        cause(quarter == 1).alias("weatherDelay"),
        cause(quarter == 2).alias("nasDelay"),
        cause(c("k") == 99).alias("securityDelay"),
        cause((quarter == 3) & (c("k") != 99)).alias("lateAircraftDelay"),
    )


def _dest_no() -> Column:
    return (F.col("user_id") * 7 + F.col("event_id")) % 25


def flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_flights(events(spark, sf_dir))


def raw_columns(records: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Records as the 27 text columns of the file, written the way the file writes them."""

    def text(field: str, kind: str) -> Column:
        c = F.col(field)
        if kind == "date":
            return F.concat(F.date_format(c, "M/d/yyyy"), F.lit(" 12:00:00 AM"))
        if kind == "flag":
            return F.when(c, "1.00").otherwise("0.00")
        if kind.endswith("double") or field.endswith("Del15"):
            return F.when(c.isNull(), "").otherwise(F.format_string("%.2f", c.cast("double")))
        if field.endswith("Time"):
            return F.when(c.isNull(), "").otherwise(F.lpad(c.cast("string"), 4, "0"))
        return F.coalesce(c.cast("string"), F.lit(""))

    return records.select(*(text(f, kind).alias(h) for h, f, kind in RAW_FIELDS), *keep)


def raw_lines(records: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Records as lines of the file (column ``value``), cities quoted."""
    parts = [
        F.concat(F.lit('"'), F.col(h), F.lit('"')) if h.endswith("CITY_NAME") else F.col(h)
        for h in RAW_COLUMNS
    ]
    return raw_columns(records, keep).select(F.concat_ws(",", *parts).alias("value"), *keep)
