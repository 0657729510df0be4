"""Records as keyed JSON messages and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ontime_spark.schemas import EVENT, PUBLISHED_DELAYS

# Averages over a stream depend on what a missing delay is sent as.
NULL_POLICIES = ("zero", "keep")


def fill_delays(df: DataFrame, null_policy: str = "zero") -> DataFrame:
    """Missing delays as the stream sees them: ``zero`` sends 0.0, ``keep`` leaves them out."""
    if null_policy not in NULL_POLICIES:
        raise ValueError(f"null_policy is one of {NULL_POLICIES}, not {null_policy!r}")
    return df.na.fill(0.0, list(PUBLISHED_DELAYS)) if null_policy == "zero" else df


def message_key() -> Column:
    """``carrier-flightNumber-flightDate``, the date as ISO text."""
    return F.concat_ws("-", "carrier", "flightNumber", F.col("flightDate").cast("string"))


def message_value(null_policy: str = "zero") -> Column:
    """The JSON text of a record. Numbers keep all their digits; text is escaped."""
    if null_policy not in NULL_POLICIES:
        raise ValueError(f"null_policy is one of {NULL_POLICIES}, not {null_policy!r}")
    fields = []
    for field in EVENT.fields:
        value = F.col(field.name).cast(field.dataType)
        if null_policy == "zero" and field.name in PUBLISHED_DELAYS:
            value = F.coalesce(value, F.lit(0.0))
        fields.append(value.alias(field.name))
    return F.to_json(F.struct(*fields))


def encode_events(records: DataFrame, null_policy: str = "zero", keep: tuple[str, ...] = ()) -> DataFrame:
    """Records as ``key`` and ``value``, with the columns in ``keep`` beside them."""
    return records.select(
        message_key().alias("key"), message_value(null_policy).alias("value"), *keep
    )


def route_records(
    typed: DataFrame, topic: str, rejected: str, null_policy: str = "zero", keep: tuple[str, ...] = ()
) -> DataFrame:
    """Parsed lines, good and bad, as messages for two topics, in one pass: ``key``, ``value``, ``topic``.

    A record goes to ``topic`` as its JSON. A line that is none goes to ``rejected`` as it is, with what is
    wrong with it for a key.
    """
    good = F.col("fault").isNull()
    return typed.select(
        F.when(good, message_key()).otherwise(F.col("fault")).alias("key"),
        F.when(good, message_value(null_policy)).otherwise(F.col("value")).alias("value"),
        F.when(good, topic).otherwise(rejected).alias("topic"),
        *keep,
    )


def decode_events(messages: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Messages as typed event columns.

    Text that is no JSON gives a row of nulls, which the marts' key check sets aside; a single
    unreadable field gives a single null.
    """
    data = F.from_json(F.col("value").cast("string"), EVENT).alias("data")
    return messages.select(data, *keep).select("data.*", *keep)


# Where a message came from, as far as its source says so.
ORIGIN = (("key", "string"), ("topic", "string"), ("partition", "bigint"), ("offset", "bigint"))


def judge_messages(messages: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Messages as typed event columns, with what is wrong with each and where it came from.

    ``fault`` is null for a sound message, else the first of: ``no value``, ``no JSON``, ``null carrier``,
    ``null origin``, or ``field`` where a field did not read. ``message`` holds key, topic, partition, offset
    and the raw text. Each message gives one row, so nothing is counted twice.
    """
    text = F.col("value").cast("string")
    columns = [F.col(n).cast(t) if n in messages.columns else F.lit(None).cast(t) for n, t in ORIGIN]
    origin = F.struct(*(c.alias(n) for c, (n, _) in zip(columns, ORIGIN)), text.alias("value"))
    schema = T.StructType([*EVENT.fields, T.StructField("unreadable", T.StringType())])
    data = F.from_json(text, schema, {"columnNameOfCorruptRecord": "unreadable"})
    rows = messages.select(data.alias("data"), origin.alias("message"), *keep).select(
        "data.*", "message", *keep
    )
    nothing = F.coalesce(*(F.col(n).cast("string") for n in EVENT.names)).isNull()
    fault = (
        F.when(F.col("message.value").isNull(), "no value")
        .when(nothing, "no JSON")
        .when(F.col("carrier").isNull(), "null carrier")
        .when(F.col("origin").isNull(), "null origin")
        .when(F.col("unreadable").isNotNull(), "field")
    )
    return rows.withColumn("fault", fault).drop("unreadable")


def stamp_processing_time(df: DataFrame) -> DataFrame:
    """The time of the micro-batch, the same for all of its rows and on a replay."""
    return df.withColumn("processingTime", F.current_timestamp())
