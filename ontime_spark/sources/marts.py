"""Mart tables as frames."""

from __future__ import annotations

import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ontime_spark.schemas import TABLES
from ontime_spark.sinks import manifest
from ontime_spark.sinks.conform import day_column, stored_schema
from ontime_spark.sinks.manifest import NO_DATE, Manifest, Part


def _entry(spark: SparkSession, path: str, version: int | None) -> Manifest:
    entry = manifest.current(spark, path, version)
    if entry is None:
        raise FileNotFoundError(f"no table at {path}" + ("" if version is None else f" of version {version}"))
    return entry


def read_mart(
    spark: SparkSession,
    table: str,
    root: str | None = None,
    jdbc: dict[str, str] | None = None,
    with_batch: bool = False,
    with_sums: bool = False,
    since: datetime.date | None = None,
    until: datetime.date | None = None,
    version: int | None = None,
) -> DataFrame:
    """A mart from parquet below ``root``, or from a database over ``jdbc`` options.

    The frame is of one version of the table, the newest or the one with that number, whatever is written
    meanwhile; it can be read as long as the log keeps that entry. Only dates from ``since`` to before
    ``until`` are looked at, where given; a filter on ``window_date`` reads only those dates, too. For a
    large table over JDBC give partitionColumn, lowerBound, upperBound and numPartitions among the options.
    """
    mart = TABLES[table]
    if jdbc is not None:
        stored = spark.read.format("jdbc").options(dbtable=table, **jdbc).load().select(*mart.names)
        stamp = "window_start" if mart.windowed else mart.stamp
        for bound, keep in ((since, lambda c, b: c >= b), (until, lambda c, b: c < b)):
            if bound is not None and stamp:
                stored = stored.where(keep(F.col(stamp), F.lit(bound).cast("timestamp")))
        return stored
    if root is None:
        raise ValueError("give root for parquet marts or jdbc for a database")
    path, day = f"{root}/{table}", day_column(mart)
    parts = _entry(spark, path, version).parts
    if since is not None or until is not None:
        low, high = str(since or datetime.date.min), str(until or datetime.date.max)
        parts = tuple(p for p in parts if p.day not in (None, NO_DATE) and low <= p.day < high)
    stored = manifest.read(spark, path, stored_schema(mart), parts, day)
    if with_batch:
        return stored.drop(*(name for name, _ in mart.sums), *([] if mart.windowed else [day or ""]))
    extra = ["window_date"] if mart.windowed else []
    return stored.select(*mart.names, *(name for name, _ in mart.sums if with_sums), *extra)


def _newest(parts: tuple[Part, ...], k: int) -> list[Part]:
    """The parts of the newest dates that hold ``k`` rows together, and of rows without date."""
    taken = [p for p in parts if p.day == NO_DATE]
    held = sum(p.rows or 0 for p in taken)
    for day in sorted({p.day for p in parts if p.day != NO_DATE}, reverse=True):
        if held >= k:
            break
        own = [p for p in parts if p.day == day]
        taken += own
        held += sum(p.rows or 0 for p in own)
    return taken


def newest_rows(spark: SparkSession, table: str, root: str, k: int) -> DataFrame:
    """Rows of a stamped table that hold its ``k`` newest, ties included: those of as few dates as it takes.

    The log knows the rows of each date, so older dates are not even listed.
    """
    mart = TABLES[table]
    path, day = f"{root}/{table}", day_column(mart)
    parts = _newest(_entry(spark, path, None).parts, k)
    return manifest.read(spark, path, stored_schema(mart), parts, day).select(*mart.names)


def predictions_or_none(spark: SparkSession, newest: int | None = None, **where) -> DataFrame:
    """The predictions table, or no rows while there is none to read.

    With ``newest`` only the dates that hold so many of its newest rows are read, where it is stored in files.
    """
    table = "flight_predictions"
    try:
        if newest is not None and where.get("jdbc") is None and where.get("root") is not None:
            return newest_rows(spark, table, where["root"], newest)
        return read_mart(spark, table, **where)
    except FileNotFoundError:
        pass
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "TABLE_OR_VIEW_NOT_FOUND"):
            raise  # a table that is there and cannot be read is no empty table
    mart = TABLES[table]
    return spark.createDataFrame([], stored_schema(mart)).select(*mart.names)
