"""Publishing keyed messages."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ontime_spark.sources.events import TOPIC


def kafka_options(servers: str, topic: str | None = TOPIC, **more: str) -> dict[str, str]:
    """Options of the Kafka writer; without ``topic`` each message names its own."""
    # One acknowledgement, three retries.
    named = {} if topic is None else {"topic": topic}
    return {
        "kafka.bootstrap.servers": servers,
        **named,
        "kafka.acks": "1",
        "kafka.retries": "3",
        **more,
    }


def publish(
    messages: DataFrame,
    kind: str = "kafka",
    options: dict[str, str] | None = None,
    path: str | None = None,
) -> None:
    """Write ``key`` and ``value`` to Kafka, or to files that stand in for it, in one pass.

    To Kafka all tasks send at once; the topic's partitioner keeps equal keys together. Messages with a
    column ``topic`` go to that topic; in files, to a folder ``topic=<name>`` below ``path``.
    """
    routed = ["topic"] if "topic" in messages.columns else []
    if kind == "kafka":
        messages.select("key", "value", *routed).write.format("kafka").options(**(options or {})).save()
        return
    if path is None:
        raise ValueError(f"a {kind} sink needs a path")
    writer = messages.write.format(kind).options(**(options or {})).mode("append")
    (writer.partitionBy("topic") if routed else writer).save(path)
