"""Train the delay model on on-time files and store it with its quality."""

from __future__ import annotations

import argparse
import os

from pyspark.sql import functions as F

from ontime_spark.jobs.options import add_marts, jdbc_of
from ontime_spark.ml.forest import build_pipeline
from ontime_spark.ml.training import Training, store_results, train
from ontime_spark.session import build_session
from ontime_spark.sinks import database
from ontime_spark.sources.raw_csv import read_by_name


def main(argv: list[str] | None = None) -> Training:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("input", nargs="+", help="files or folders with a header")
    parser.add_argument("--model", required=True, help="folder to save the model to")
    add_marts(parser)
    parser.add_argument("--run", help="names this training among the results; by default a new name")
    parser.add_argument("--preview", type=int, default=0, help="held-out flights to show, the furthest off first")
    parser.add_argument("--fraction", type=float, default=0.2)
    parser.add_argument("--trees", type=int, default=100)
    parser.add_argument("--depth", type=int, default=10)
    parser.add_argument("--bins", type=int, default=400)
    parser.add_argument("--seed", type=int, default=42)
    args = parser.parse_args(argv)

    spark = build_session("train")
    pipeline = build_pipeline(trees=args.trees, depth=args.depth, bins=args.bins, seed=args.seed)
    done = train(read_by_name(spark, args.input), pipeline, fraction=args.fraction, seed=args.seed)
    print(f"Rows: {done.counts}")
    done.metrics.show()
    done.importance.show(truncate=False)
    if args.preview:
        error = F.abs(F.col("prediction") - F.col("arrDelay")).alias("minutes_off")
        done.predictions.select("origin", "dest", error).orderBy(F.desc("minutes_off")).show(args.preview)
    jdbc = jdbc_of(args, os.environ)
    if jdbc is not None:
        database.create_tables(spark, jdbc, "ml_results", "ml_feature_importance")
    store_results(done, args.model, args.marts, jdbc, args.run)
    return done


if __name__ == "__main__":
    main()
