"""Connected components of a table of links, by large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ontime_spark.llm.common import keep


def _star(links: DataFrame, large: bool) -> DataFrame:
    """One star round: each node's neighbours are tied to the least of them.

    The minimum is a combining aggregate and the join back may be split by adaptive execution, so
    no node's neighbours meet in one task.
    """
    if large:
        near = links.union(links.select("v", "u")).toDF("u", "v")
    else:
        near = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = near.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    joined = near.join(least, "u")
    if large:
        out = joined.filter(F.col("v") > F.col("u")).select("v", "m")
    else:
        out = joined.select("v", "m").union(least.select("u", "m"))
    return out.toDF("u", "v").filter("u != v").distinct()


def components(links: DataFrame) -> DataFrame:
    """Rows (node, root) for every node of ``links`` (u, v): root is the least node it reaches.

    Nodes without links have no row; loops, repeated and two-way links are allowed. Every round is
    written to the shared folder; the number of rounds is about the logarithm of a component's size.
    """
    links = keep(links.select("u", "v").filter("u != v").distinct(), "links")
    before = None
    while True:
        state = links.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(u, v))")).first()
        if state[0] == 0 or tuple(state) == before:
            break
        before = tuple(state)
        links = keep(_star(_star(links, True), False), "links")
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        links.select("v", "v").distinct()
    )
