"""Print the dashboard's reports from the mart tables."""

from __future__ import annotations

import argparse
import os

from pyspark.sql import DataFrame

from ontime_spark.jobs.options import add_marts, jdbc_of, need_one
from ontime_spark.plans import dashboard
from ontime_spark.session import build_session
from ontime_spark.sources.marts import predictions_or_none, read_mart


def reports(spark, **where) -> dict[str, DataFrame]:
    """Every report, over marts at ``root`` or over ``jdbc``."""
    carriers = read_mart(spark, "carrier_delay_agg", **where)
    airports = read_mart(spark, "airport_delay_agg", **where)
    predictions = predictions_or_none(spark, newest=dashboard.LATEST, **where)
    return {
        "stats": dashboard.kpi_stats(carriers),
        "carrier-delays": dashboard.top_carriers(carriers),
        "airport-delays": dashboard.top_airports(airports),
        "delay-causes": dashboard.delay_causes(read_mart(spark, "delay_cause_agg", **where)),
        "predictions": dashboard.latest_predictions(predictions),
        "airport-board": dashboard.airport_leaderboard(airports),
        "airport-count": dashboard.airport_count(airports),
        "prediction-board": dashboard.prediction_board(predictions),
    }


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("report", nargs="*", help="names of reports; all when none is given")
    add_marts(parser)
    args = parser.parse_args(argv)
    need_one(parser, args, "marts", "jdbc_url")

    spark = build_session("report")
    known = reports(spark, root=args.marts, jdbc=jdbc_of(args, os.environ))
    for name in args.report or known:
        print(name)
        known[name].show(truncate=False)


if __name__ == "__main__":
    main()
