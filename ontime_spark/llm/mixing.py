"""Mixing sources to target weights by Poisson replication.

Every document is repeated a number of times that is Poisson distributed, with its source's target
rate of repetition as mean. The number comes from a hash of the document's id and a seed, through the
inverse of the distribution, so it is the same on any cluster and in any order. The copies are dealt
out by hash and sorted by it: one global shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ontime_spark.llm.common import keep

HEX_DIGITS = 13  # 52 bits of a hash: whole numbers that a double holds exactly


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) from the md5 of the parts joined by |; null parts are empty."""
    text = F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    digits = F.substring(F.md5(text.cast("binary")), 1, HEX_DIGITS)
    return F.conv(digits, 16, 10).cast("long") / F.lit(float(1 << 4 * HEX_DIGITS))


def rates(
    docs: DataFrame, source_col: str, weights: dict[str, float] | None = None,
    temperature: float = 0.5, epochs: float = 1.0,
) -> DataFrame:
    """(source, rate): how often each document of a source is to be repeated on average.

    With ``weights`` a source's share of the mixture is its weight over the sum of weights of the
    sources present, and sources without a weight are left out; else its share goes with its number
    of documents to the power ``temperature``. The mixture has ``epochs`` times as many documents as
    ``docs``. A null source is the empty name.
    """
    source = F.coalesce(F.col(f"`{source_col}`").cast("string"), F.lit("")).alias("source")
    sizes = docs.select(source).groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    if weights is None:
        weighed = sizes.withColumn("w", F.pow("n", F.lit(temperature)))
    else:
        # a mixture's weights are a setting: as many as there are names in it
        table = docs.sparkSession.createDataFrame([(k, float(v)) for k, v in weights.items()], "source string, w double")
        weighed = sizes.join(table, "source")
    all_weights = weighed.agg(F.sum("w")).first()[0] or 1.0
    all_rows = sizes.agg(F.sum("n")).first()[0] or 0
    return weighed.select("source", (F.col("w") / all_weights * all_rows * epochs / F.col("n")).alias("rate"))


def distributions(rate_table: DataFrame) -> DataFrame:
    """(source, rate, cdf): cdf[k] is the chance of at most k, up to where the rest is below 2**-52."""
    most = (F.col("rate") + 12 * F.sqrt("rate") + 40).cast("int")
    steps = rate_table.filter("rate > 0").select("source", "rate", F.explode(F.sequence(F.lit(0), most)).alias("k"))
    up_to = Window.partitionBy("source").orderBy("k")
    log_factorial = F.sum(F.log(F.greatest("k", F.lit(1)))).over(up_to)
    mass = steps.withColumn("mass", F.exp(F.col("k") * F.log("rate") - F.col("rate") - log_factorial))
    chance = mass.withColumn("cdf", F.sum("mass").over(up_to))
    return chance.groupBy("source").agg(
        F.first("rate").alias("rate"), F.array_sort(F.collect_list("cdf")).alias("cdf")
    )


def mix(
    docs: DataFrame, id_col: str = "doc_id", source_col: str = "source",
    weights: dict[str, float] | None = None, temperature: float = 0.5, epochs: float = 1.0, seed: int = 17,
) -> DataFrame:
    """``docs`` with every document repeated, and copy (from 1) and place: the order of the shuffle.

    Documents drawn 0 times are left out. Rows with equal ids, or null ones, draw alike. Texts may be
    null, empty or long: they are only carried. An empty table gives an empty mixture. Columns named
    copy and place are replaced.

    A document's number of copies is the number of entries of its source's cdf that its draw reaches.
    The table of distributions is written first: its size then decides whether Spark sends it to all
    tasks, which saves the join's shuffle, or joins by source and splits a hot one.
    """
    table = keep(distributions(rates(docs, source_col, weights, temperature, epochs)), "distributions")
    table = table.select(F.col("source").alias("__source"), F.col("cdf").alias("__cdf"))
    drawn = docs.drop("copy", "place").withColumns({
        "__source": F.coalesce(F.col(f"`{source_col}`").cast("string"), F.lit("")),
        "__u": uniform(F.lit(seed), F.col(f"`{id_col}`")),
    })
    copies = F.size(F.filter("__cdf", lambda c: c <= F.col("__u")))
    repeated = drawn.join(table, "__source").withColumn("__copies", copies).filter("__copies > 0")
    out = repeated.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("__copies"))))
    out = out.drop("__source", "__u", "__cdf", "__copies")
    out = out.withColumn("place", uniform(F.lit(seed), F.col(f"`{id_col}`"), F.col("copy")))
    return out.repartition(F.col("place"), F.col("copy")).sortWithinPartitions("place", f"`{id_col}`", "copy")
