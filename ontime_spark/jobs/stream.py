"""Keep the mart tables up to date from the message stream, and score it when there is a model."""

from __future__ import annotations

import argparse
import os

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ontime_spark.functions.messages import decode_events, stamp_processing_time
from ontime_spark.jobs.options import add_marts, add_topic, jdbc_of, need_one
from ontime_spark.ml.forest import load_model
from ontime_spark.session import build_session
from ontime_spark.sinks import database
from ontime_spark.sources.events import kafka_options, read_events
from ontime_spark.streaming.queries import OnBatch, run_queries, start_aggregates, start_marts, start_scoring


def preview(rows: int) -> OnBatch:
    """Prints the size of each batch and its first rows."""

    def show(table: str, batch: DataFrame, batch_id: int) -> None:
        print(f"{table}, batch {batch_id}: {batch.count()} rows")
        batch.show(rows, truncate=False)

    return show


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    add_topic(parser)
    add_marts(parser)
    parser.add_argument("--checkpoints", required=True, help="folder of the queries' progress")
    parser.add_argument("--quarantine", help="folder for scored rows no mart takes (default: --marts)")
    parser.add_argument("--starting-offsets", default="earliest")
    parser.add_argument("--max-per-batch", help="messages (Kafka) or files a batch may take")
    parser.add_argument("--model", help="saved model; without one nothing is scored")
    parser.add_argument("--model-optional", action="store_true", help="go on if it cannot be loaded")
    parser.add_argument("--cap", type=int, default=0, help="scored rows kept per batch, 0 for all")
    parser.add_argument("--watermark", help="with a database: e.g. '1 hour', windows older than that are dropped")
    parser.add_argument("--preview", type=int, default=0, help="rows of each batch to print")
    parser.add_argument("--restarts", type=int, default=0, help="how often failed queries start again")
    parser.add_argument("--event-time", action="store_true", help="window by the message's time")
    parser.add_argument("--available-now", action="store_true", help="stop at the end of the topic")
    args = parser.parse_args(argv)
    need_one(parser, args, "servers", "messages")
    need_one(parser, args, "marts", "jdbc_url")

    spark = build_session("stream")
    if args.servers:
        limit = {"maxOffsetsPerTrigger": args.max_per_batch} if args.max_per_batch else {}
        options = kafka_options(args.servers, args.topic, args.starting_offsets, **limit)
        messages = read_events(spark, "kafka", options)
    else:
        limit = {"maxFilesPerTrigger": args.max_per_batch} if args.max_per_batch else {}
        messages = read_events(spark, args.format, limit, args.messages, topic=args.topic)
    stamped = messages if args.event_time else stamp_processing_time(messages)
    time_col = "timestamp" if args.event_time else "processingTime"
    events = decode_events(stamped, keep=(time_col,))

    jdbc = jdbc_of(args, os.environ)
    if jdbc is not None:
        database.create_tables(spark, jdbc)
    trigger = {"availableNow": True} if args.available_now else None
    on_batch = preview(args.preview) if args.preview else None
    model = load_model(args.model, required=bool(args.model) and not args.model_optional)
    print("Scoring the stream" if model else "Not scoring: no model")

    def start() -> list[StreamingQuery]:
        if jdbc is None:
            running = [start_marts(stamped, args.marts, args.checkpoints, time_col, trigger, on_batch)]
        else:
            watermark = {"watermark": args.watermark} if args.watermark else {}
            running = start_aggregates(
                events, None, args.checkpoints, time_col, trigger=trigger, jdbc=jdbc, on_batch=on_batch,
                quarantine=args.quarantine, **watermark,
            )
        scoring = start_scoring(
            events, model, args.marts, args.checkpoints, cap=args.cap or None, trigger=trigger, jdbc=jdbc,
            on_batch=on_batch, quarantine=args.quarantine,
        )
        return running + ([scoring] if scoring else [])

    run_queries(spark, start, args.restarts)


if __name__ == "__main__":
    main()
