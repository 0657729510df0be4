"""The stream of keyed messages, from Kafka or from files that stand in for a topic."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

TOPIC = "flight-events"

# A topic written to files: key and value, and the time the broker would have stamped.
MESSAGE = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("value", T.StringType()),
    T.StructField("timestamp", T.TimestampType()),
])


def kafka_options(
    servers: str, topic: str = TOPIC, starting: str = "earliest", **more: str
) -> dict[str, str]:
    """Options of the Kafka reader; ``more`` adds e.g. maxOffsetsPerTrigger or minPartitions."""
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
        **more,
    }


def read_events(
    spark: SparkSession,
    kind: str = "kafka",
    options: dict[str, str] | None = None,
    path: str | None = None,
    stream: bool = True,
    topic: str | None = None,
) -> DataFrame:
    """Undecoded messages: at least ``value``, and ``timestamp`` where the source has one.

    ``kind`` is ``kafka`` (the connector must be on the class path) or a file format such as
    ``parquet`` or ``json``, which reads :data:`MESSAGE` rows below ``path``, of one ``topic`` if given.
    """
    reader = (spark.readStream if stream else spark.read).format(kind).options(**(options or {}))
    if kind == "kafka":
        return reader.load()
    if path is None:
        raise ValueError(f"a {kind} source needs a path")
    return reader.schema(MESSAGE).load(path if topic is None else f"{path}/topic={topic}")
