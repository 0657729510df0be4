"""Fitting frames to the mart tables' columns, types and keys."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ontime_spark.schemas import TABLES, Mart


def spark_type(sql_type: str) -> T.DataType:
    """The Spark type of a mart column's SQL type."""
    if sql_type == "TIMESTAMP":
        return T.TimestampType()
    if sql_type == "BIGINT":
        return T.LongType()
    if sql_type == "TEXT" or sql_type.startswith("VARCHAR"):
        return T.StringType()
    precision, scale = map(int, re.findall(r"\d+", sql_type))
    return T.DecimalType(precision, scale)


def day_column(mart: Mart) -> str | None:
    """The column of the date that a table's rows are stored under."""
    if mart.windowed:
        return "window_date"
    return f"{mart.stamp}_date" if mart.stamp else None


def stored_schema(mart: Mart) -> T.StructType:
    """A mart's columns on disk: its own, its sums, the batch that wrote the row, and its date last."""
    fields = [T.StructField(name, spark_type(kind)) for name, kind in mart.columns]
    fields += [T.StructField(name, T._parse_datatype_string(kind)) for name, kind in mart.sums]
    if not mart.keys:
        fields.append(T.StructField("run", T.StringType()))
    fields.append(T.StructField("batch_id", T.LongType()))
    day = day_column(mart)
    if day is not None:
        fields.append(T.StructField(day, T.DateType()))
    return T.StructType(fields)


def fitted(df: DataFrame, mart: Mart) -> DataFrame:
    """``df`` with the mart's columns in their types; a value that a column cannot hold becomes null."""
    return df.withColumns({name: F.col(name).try_cast(spark_type(kind)) for name, kind in mart.columns})


def fit(df: DataFrame, table: str) -> DataFrame:
    """``df`` in the table's columns and types, plus ``fault``: null for a row that may be stored.

    A null key is a fault, and so is a value the column cannot hold. Doubles are rounded half up
    to the column's decimals. A missing stamp column is filled with the time of writing.
    """
    mart = TABLES[table]
    given = [(n, t) for n, t in mart.columns if n in df.columns or n != mart.stamp]
    kinds = {name: field.dataType for name, field in zip(df.columns, df.schema.fields)}
    faults = [(F.col(key).isNull(), f"null {key}") for key in mart.keys]
    held = []
    for name, sql_type in given:
        kind = spark_type(sql_type)
        if kinds[name] == kind:
            held.append(F.col(name))
        else:
            # Next to the value as given, so that the cast is worked out once for both its uses.
            held.append(F.struct(F.col(name).alias("given"), F.col(name).try_cast(kind).alias("fit")))
            lost = F.col(f"{name}.given").isNotNull() & F.col(f"{name}.fit").isNull()
            faults.append((lost, f"value of {name}"))
        if sql_type.startswith("VARCHAR"):
            limit = int(re.findall(r"\d+", sql_type)[0])
            text = F.col(name) if kinds[name] == kind else F.col(f"{name}.fit")
            faults.append((F.length(text) > limit, f"value of {name}"))
    fault = F.lit(None).cast("string")
    for wrong, text in reversed(faults):
        fault = F.when(wrong, text).otherwise(fault)
    columns = [
        (F.col(n) if kinds[n] == spark_type(t) else F.col(f"{n}.fit")).alias(n) for n, t in given
    ]
    if mart.stamp and mart.stamp not in df.columns:
        columns.append(F.current_timestamp().alias(mart.stamp))
    named = [c.alias(n) for c, (n, _) in zip(held, given)]
    return df.select(*named).select(*columns, fault.alias("fault"))


def conform(df: DataFrame, table: str, unique: bool = False) -> tuple[DataFrame, DataFrame]:
    """Rows the table can take, and a report of the others: values, ``fault`` and ``rows``.

    Of rows with the same key the one lowest in its other columns is taken, found by an aggregate
    that combines before its shuffle, so many copies of one key do no harm; the report counts the
    others. Pass ``unique`` for a frame that has one row per key already, such as an aggregate by
    that key: it saves the shuffle.
    """
    mart = TABLES[table]
    judged = fit(df, table)
    good = judged.where(F.col("fault").isNull()).select(*mart.names)
    report = judged.where(F.col("fault").isNotNull()).withColumn("rows", F.lit(1).cast("bigint"))
    if unique or not mart.keys:
        return good, report
    others = [n for n in mart.names if n not in mart.keys]
    lowest = good.groupBy(*mart.keys).agg(
        F.min(F.struct(*others)).alias("row"), F.count("*").alias("copies")
    )
    names = [F.col(n) if n in mart.keys else F.col(f"row.{n}") for n in mart.names]
    copies = lowest.where(F.col("copies") > 1).select(
        *names, F.lit("duplicate key").alias("fault"), (F.col("copies") - 1).alias("rows")
    )
    return lowest.select(*names), report.unionByName(copies)
