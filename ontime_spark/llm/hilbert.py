"""Sharding along a Hilbert curve over several metadata dimensions.

Each dimension is quantised to the same number of bits; rows are ordered by their cell's index on the
curve and cut into runs of equal numbers of rows. Neighbours on the curve are neighbours in every
dimension, so a shard spans a small range of each and a filter on any of them leaves most shards out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ontime_spark.llm.common import keep, with_arrow

SLICES = 64  # parts that one cell's rows are dealt to while they are numbered


def curve_index(points: np.ndarray, bits: int) -> np.ndarray:
    """Index on the Hilbert curve of points (n, dimensions) with coordinates below 2**bits (Skilling, 2004)."""
    x = points.astype(np.int64).T.copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:  # undo the excess work of the levels, from the top
        p = q - 1
        for i in range(n):
            high = (x[i] & q) != 0
            t = np.where(high, 0, (x[0] ^ x[i]) & p)
            x[0] ^= np.where(high, p, t)
            x[i] ^= t
        q >>= 1
    for i in range(1, n):  # Gray code
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        t ^= np.where((x[n - 1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= t
    out = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            out = (out << 1) | ((x[i] >> b) & 1)
    return out


def by_name(column: Column, bits: int) -> Column:
    """A text's bucket: the highest bits of its md5; null is the empty text."""
    digits = F.substring(F.md5(F.coalesce(column.cast("string"), F.lit("")).cast("binary")), 1, 8)
    return F.shiftright(F.conv(digits, 16, 10).cast("long"), 32 - bits).cast("int")


def by_magnitude(column: Column, bits: int) -> Column:
    """A positive number's bucket: twice its binary logarithm, as far as the bits go; null is 1."""
    grown = F.greatest(F.coalesce(column.cast("long"), F.lit(1)), F.lit(1))
    # exact for whole numbers: the number of binary digits, and whether the next one is set
    digits = F.length(F.bin(grown))
    half = F.when(F.substring(F.bin(grown), 2, 1) == "1", 1).otherwise(0)
    return F.least((digits - 1) * 2 + half, F.lit((1 << bits) - 1)).cast("int")


def hilbert_shards(
    df: DataFrame, dimensions: dict[str, Column], id_col: str, shards: int, bits: int
) -> DataFrame:
    """``df`` with its coordinates (named by ``dimensions``), hilbert, shard and slot.

    ``dimensions`` gives each coordinate, a whole number below 2**bits. Rows are ordered by curve
    index and id; shard s holds ranks ceil(s * n / shards) and on, so counts differ by one at most and
    slots have no gaps. Null ids come first; rows equal in id and index are in any order. An empty
    table gives no rows. Columns of the new names are replaced.

    Only bounded tables are numbered in one task: the counts by cell (2**(bits * dimensions) at most).
    A cell's rows are dealt by id to 64 slices, which are numbered apart, so that a cell with a
    third of all rows is no task's business alone.
    """
    names = list(dimensions)
    placed = df.drop("hilbert", "shard", "slot").withColumns(dimensions)

    def make():
        def one(*columns):
            points = np.stack([c.to_numpy(zero_copy_only=False) for c in columns], axis=1)
            return [pa.array(curve_index(points, bits))]

        return one

    indexed = with_arrow(placed, names, [T.StructField("hilbert", T.LongType())], make)
    part = F.pmod(F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(0)), F.lit(SLICES)).alias("__slice")
    rows = keep(indexed.withColumn("__slice", part), "hilbert")

    counts = rows.groupBy("hilbert", "__slice").agg(F.count(F.lit(1)).alias("n"))
    cells = counts.groupBy("hilbert").agg(F.sum("n").alias("n"))
    before = Window.orderBy("hilbert").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.select(
        "hilbert", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("cell_start"), F.sum("n").over(Window.partitionBy()).alias("all")
    )
    inside = Window.partitionBy("hilbert").orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("hilbert", "__slice", F.coalesce(F.sum("n").over(inside), F.lit(0)).alias("slice_start")).join(cells, "hilbert")
    starts = keep(
        starts.select("hilbert", "__slice", (F.col("cell_start") + F.col("slice_start")).alias("__start"), F.col("all").alias("__all")), "starts"
    )
    number = F.row_number().over(Window.partitionBy("hilbert", "__slice").orderBy(F.col(f"`{id_col}`").asc_nulls_first())) - 1
    ranked = rows.join(starts, ["hilbert", "__slice"]).withColumn("__rank", F.col("__start") + number)
    shard = F.expr(f"(__rank * {shards}) div __all")
    first = F.expr(f"(shard * __all + {shards} - 1) div {shards}")
    return (
        ranked.withColumn("shard", shard.cast("int"))
        .withColumn("slot", (F.col("__rank") - first).cast("long"))
        .select(*[F.col(f"`{c}`") for c in indexed.columns], "shard", "slot")
    )


def manifest(sharded: DataFrame, dimensions: list[str]) -> DataFrame:
    """(shard, rows, and the least and greatest coordinate of each dimension): what a reader prunes by."""
    ends = [f(c).alias(f"{f.__name__}_{c}") for c in dimensions for f in (F.min, F.max)]
    return sharded.groupBy("shard").agg(F.count(F.lit(1)).alias("rows"), *ends)


def prune(shard_manifest: DataFrame, ranges: dict[str, tuple[int, int]]) -> DataFrame:
    """The shards that can hold rows with every coordinate inside its (low, high), ends included."""
    for name, (low, high) in ranges.items():
        shard_manifest = shard_manifest.filter((F.col(f"min_{name}") <= high) & (F.col(f"max_{name}") >= low))
    return shard_manifest.select("shard")
