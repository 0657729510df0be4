"""Read on-time files and publish their records as keyed JSON messages, and what is no record beside them."""

from __future__ import annotations

import argparse

from pyspark.sql import Observation

from ontime_spark.functions.messages import NULL_POLICIES, route_records
from ontime_spark.jobs.options import add_topic, need_one
from ontime_spark.operators.records import type_records
from ontime_spark.session import build_session
from ontime_spark.sinks.publish import kafka_options, publish
from ontime_spark.sources.raw_csv import read_raw


def main(argv: list[str] | None = None) -> dict[str, int]:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("input", nargs="+", help="files or folders")
    add_topic(parser)
    parser.add_argument("--null-policy", choices=NULL_POLICIES, default="zero")
    parser.add_argument("--strict-int", action="store_true", help="read 1.00 as no whole number")
    parser.add_argument("--rejected-topic", help="for lines that are no records (default: the topic's name and -rejected)")
    args = parser.parse_args(argv)
    need_one(parser, args, "servers", "messages")

    spark = build_session("publish")
    seen = Observation()
    typed = type_records(read_raw(spark, args.input), args.strict_int, seen)
    messages = route_records(typed, args.topic, args.rejected_topic or f"{args.topic}-rejected", args.null_policy)
    if args.servers:
        publish(messages, "kafka", kafka_options(args.servers, None))
    else:
        publish(messages, args.format, path=args.messages)
    counts = dict(seen.get)
    print(f"{counts['published']} messages sent, {counts['skipped']} lines rejected")
    return counts


if __name__ == "__main__":
    main()
