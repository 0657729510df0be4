"""Mart tables as parquet: merge by key, add up by key, and append by batch.

Tables are stored by date, of their windows or of their stamp, in folders that a log names (see
:mod:`ontime_spark.sinks.manifest`). A merge reads the dates in its batch and writes each of them once; an
append writes its rows, and from time to time merges a date's small files into larger ones. A batch and
the note that it is there become visible together, so repeating it changes nothing.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ontime_spark.schemas import TABLES, Mart
from ontime_spark.sinks import files, manifest
from ontime_spark.sinks.cached import cached
from ontime_spark.sinks.conform import conform, day_column, fitted, stored_schema
from ontime_spark.sinks.manifest import NO_DATE, Manifest, Part

FAN_IN = 8  # folders of one size that a date may have before they become one


def create_mart(spark: SparkSession, root: str, table: str) -> str:
    """The table's path, made as an empty table if it is not there."""
    path = f"{root}/{table}"
    if manifest.current(spark, path) is None:
        manifest.commit(spark, path, Manifest(0))
    return path


def _dated(rows: DataFrame, mart: Mart) -> DataFrame:
    """``rows`` with the date they are stored under."""
    day = day_column(mart)
    return rows if day is None else rows.withColumn(day, F.to_date("window_start" if mart.windowed else mart.stamp))


def _days(rows: DataFrame, mart: Mart) -> dict[str | None, int]:
    """The dates in a batch, with their rows; as many as there are dates."""
    day = day_column(mart)
    if day is None:
        return {None: rows.count()}
    return {NO_DATE if d is None else str(d): n for d, n in rows.groupBy(day).count().collect()}


def _commit_until_done(
    spark: SparkSession, path: str, run: str | None, batch_id: int, make: Callable[[Manifest, str], tuple[Part, ...]]
) -> None:
    """Write a version and make it part of the table; anew from what is there if another writer was first."""
    while True:
        before = manifest.current(spark, path)
        if before.has(run, batch_id):
            return
        version = manifest.new_version()
        parts = make(before, version)
        done = before.done if run is None else {**before.done, run: batch_id}
        if manifest.commit(spark, path, Manifest(before.number + 1, parts, done)):
            return
        files.delete(spark, f"{path}/data/version={version}")


def _merge(
    batch: DataFrame, path: str, mart: Mart, batch_id: int, run: str | None,
    combine: Callable[[DataFrame, DataFrame], DataFrame],
) -> bool:
    """Replace the dates in ``batch`` by what ``combine`` makes of them and it; False for no rows."""
    spark, schema, day = batch.sparkSession, stored_schema(mart), day_column(mart)
    days = _days(batch, mart)
    if not any(days.values()):
        return False

    def make(before: Manifest, version: str) -> tuple[Part, ...]:
        touched = before.of_days(days)
        merged = combine(manifest.read(spark, path, schema, touched, day), batch).select(*schema.names)
        if day is not None:
            # Few files per date, and several where a date is large.
            merged = merged.hint("rebalance", day)
        manifest.write(merged, path, version, day)
        rest = [p for p in before.parts if p not in touched]
        return (*rest, *(Part(d, version) for d in days))

    _commit_until_done(spark, path, run, batch_id, make)
    return True


def upsert(
    df: DataFrame,
    root: str,
    table: str,
    batch_id: int = 0,
    run: str | None = None,
    unique: bool = False,
) -> DataFrame | None:
    """Merge a batch into a keyed table; a row with a stored key replaces the stored one.

    Only the dates in the batch are read and written, each of them once. With ``run`` a batch whose number
    that run has reached already is left out; without, every call merges.

    Returns the report of rows the table cannot take, or None for an empty batch.
    """
    mart = TABLES[table]
    path = create_mart(df.sparkSession, root, table)
    with cached(df):
        good, report = conform(df, table, unique)
        batch = _dated(good.withColumn("batch_id", F.lit(batch_id).cast("bigint")), mart)
        for name, kind in mart.sums:
            batch = batch.withColumn(name, F.lit(None).cast(kind))

        def replace(stored: DataFrame, new: DataFrame) -> DataFrame:
            return stored.join(new, list(mart.keys), "left_anti").unionByName(new.select(*stored.columns))

        if not _merge(batch, path, mart, batch_id, run, replace) and df.isEmpty():
            return None
        return report


def add(
    sums: DataFrame, root: str, table: str, means: Callable[[DataFrame], DataFrame], batch_id: int = 0, run: str | None = None
) -> None:
    """Add a batch of sums by key to a windowed table: the table's measures are made from the totals.

    ``sums`` has the table's keys, ``window_end`` and its sums, one row a key, without null keys; ``means``
    adds the measures. Rows may belong to windows of any age, so nothing is ever late. A measure that its
    column cannot hold is null, while its sums go on.
    """
    mart = TABLES[table]
    path = create_mart(sums.sparkSession, root, table)
    names = [name for name, _ in mart.sums]

    def total(stored: DataFrame, new: DataFrame) -> DataFrame:
        columns = [*mart.keys, "window_end", *names]
        both = stored.select(*columns).unionByName(new.select(*columns))
        added = both.groupBy(*mart.keys).agg(F.max("window_end").alias("window_end"), *(F.sum(n).alias(n) for n in names))
        return _dated(fitted(means(added), mart).withColumn("batch_id", F.lit(batch_id).cast("bigint")), mart)

    with cached(sums):
        _merge(_dated(sums, mart), path, mart, batch_id, run, total)


def append_batch(
    df: DataFrame, root: str, table: str, batch_id: int = 0, run: str = "default"
) -> DataFrame | None:
    """Add a batch to an append-only table, stamped with the time of writing.

    The log knows the last batch of each run, so repeating one adds nothing. Batch numbers start again
    with a new checkpoint: give that a new run. When a date has :data:`FAN_IN` folders of one size, the
    write that adds the last of them writes them as one; so their number grows with the logarithm of the
    batches, and a row is written as often.

    Returns the report of rows the table cannot take, or None for an empty batch.
    """
    spark, mart = df.sparkSession, TABLES[table]
    path, schema, day = create_mart(spark, root, table), stored_schema(mart), day_column(mart)
    with cached(df):
        if df.isEmpty():
            return None
        good, report = conform(df, table)
        rows = good.withColumn("run", F.lit(run)).withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        rows = _dated(rows, mart).select(*schema.names)
        with cached(rows):  # its stamp is taken once
            days = _days(rows, mart)

            def make(before: Manifest, version: str) -> tuple[Part, ...]:
                parts, merged = list(before.parts), []
                for d, n in days.items():
                    new = Part(d, version, n)
                    while len(same := [p for p in parts if (p.day, p.level) == (d, new.level)]) >= FAN_IN - 1:
                        new = dataclasses.replace(new, rows=new.rows + sum(p.rows for p in same), level=new.level + 1)
                        parts = [p for p in parts if p not in same]
                        merged += same
                    parts.append(new)
                whole = rows if not merged else rows.unionByName(manifest.read(spark, path, schema, merged, day))
                if merged and day is not None:
                    whole = whole.hint("rebalance", day)
                manifest.write(whole, path, version, day)
                return tuple(parts)

            if any(days.values()):
                _commit_until_done(spark, path, run, batch_id, make)
        return report


def write_report(report: DataFrame, root: str, table: str, batch_id: int, run: str = "default") -> None:
    """Keep the rows a table could not take in ``<table>_quarantine``, a partition per batch."""
    rows = report.withColumn("run", F.lit(run)).withColumn(
        "batch_id", F.lit(batch_id).cast("bigint")
    )
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("run", "batch_id").parquet(f"{root}/{table}_quarantine")
