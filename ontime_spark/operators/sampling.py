"""Samples, splits and caps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


RUN_LENGTH = 10_000  # occurrences that one row is unfolded to at once


def draw_number(df: DataFrame, seed: int = 42, purpose: str = "sample", name: str = "draw") -> DataFrame:
    """Every row with a number from 0 to 1 by the seed, the purpose, the row, and which of its equals it is.

    Equal rows are counted and unfolded again, so the numbers are the same for any order and number of
    partitions. A frequent row travels as one row a task and is unfolded in runs.
    """
    counted = df.groupBy(*(F.col(f"`{c}`") for c in df.columns)).agg(F.count(F.lit(1)).alias("__times"))
    first = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("__times"), F.lit(RUN_LENGTH).cast("bigint")))
    runs = counted.withColumn("__from", first)
    last = F.least(F.col("__from") + (RUN_LENGTH - 1), F.col("__times"))
    single = runs.withColumn("__nth", F.explode(F.sequence("__from", last)))
    return single.select(*(F.col(f"`{c}`") for c in df.columns), _draw(df, seed, purpose).alias(name))


def row_text(df: DataFrame) -> Column:
    """A row's values as one text; null and empty text differ."""
    parts = [F.coalesce(F.concat(F.lit("="), F.col(f"`{c}`").cast("string")), F.lit("-")) for c in df.columns]
    return F.concat_ws("|", *parts)


def _draw(df: DataFrame, seed: int, purpose: str) -> Column:
    text = F.concat_ws("|", F.lit(str(seed)), F.lit(purpose), F.col("__nth").cast("string"), row_text(df))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("bigint") / float(1 << 52)


def bernoulli_sample(df: DataFrame, fraction: float = 0.2, seed: int = 42) -> DataFrame:
    """Each row with the same chance, the same rows however the input is laid out."""
    return draw_number(df, seed, "sample", "__draw").where(F.col("__draw") < fraction).drop("__draw")


def random_split(
    df: DataFrame, weights: Sequence[float] = (0.8, 0.2), seed: int = 42
) -> list[DataFrame]:
    """Disjoint random parts that make up ``df``, the same ones however it is laid out."""
    total, low, parts = sum(weights), 0.0, []
    drawn = draw_number(df, seed, "split", "__draw")
    for i, weight in enumerate(weights):
        high = low + weight / total
        inside = F.col("__draw") >= low
        parts.append(drawn.where(inside & (F.col("__draw") < high) if i + 1 < len(weights) else inside).drop("__draw"))
        low = high
    return parts


def hash_percent(key: Column) -> Column:
    """A number from 0 to 99 that depends on the key alone, not on partitions or order."""
    digits = F.substr(F.md5(key.cast("string").cast("binary")), F.lit(1), F.lit(7))
    return (F.conv(digits, 16, 10).cast("bigint") % 100).cast("int")


def hash_sample(df: DataFrame, key: str, percent: int = 20) -> DataFrame:
    """The rows whose key hashes below ``percent``: the same rows on every run and cluster."""
    return df.where(hash_percent(F.col(key)) < percent)


def hash_split(
    df: DataFrame, key: str, train_percent: int = 80, salt: str = "split"
) -> DataFrame:
    """Adds ``split``, ``train`` or ``test``, by a hash apart from the one that samples."""
    salted = F.concat(F.lit(salt), F.col(key).cast("string"))
    return df.withColumn(
        "split", F.when(hash_percent(salted) < train_percent, "train").otherwise("test")
    )


def cap_rows(df: DataFrame, n: int, order: Sequence[Column | str] | None = None) -> DataFrame:
    """At most ``n`` rows: the first in ``order``, or any when no order is asked for."""
    return (df.orderBy(*order) if order else df).limit(n)
