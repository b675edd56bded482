"""Connected components of a link table, by alternating large and small stars, all in DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartsight.sources.tables import settle


def _digest(links: DataFrame) -> tuple:
    row = links.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)")).alias("s")).first()
    return row["n"], row["s"]


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node with a link to another; the root is the smallest node of its component.

    Links are long pairs in any order, repeats and loops allowed, nulls dropped. Each round is stored in the
    shared folder. The node in the middle of a large star is the key of a join whose other side has one row per
    node, so Spark can split it; minima are combined before they are shuffled.
    """
    now = settle(
        links.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo"))
        .where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
        .distinct()
    )
    before = _digest(now)
    while before[0]:
        both = now.unionByName(now.select(F.col("lo").alias("hi"), F.col("hi").alias("lo")))
        least = both.groupBy("hi").agg(F.min("lo").alias("low"))
        large = (
            both.join(least, "hi")
            .where("lo > hi")
            .select(F.col("lo").alias("hi"), F.least("hi", "low").alias("lo"))
            .distinct()
        )
        down = large.groupBy("hi").agg(F.min("lo").alias("low"))
        small = large.join(down, "hi").select(
            F.when(F.col("lo") == F.col("low"), F.col("hi")).otherwise(F.col("lo")).alias("hi"), F.col("low").alias("lo")
        )
        ends = down.select("hi", F.col("low").alias("lo"))
        now = settle(small.unionByName(ends).distinct())
        after = _digest(now)
        if after == before:
            break
        before = after
    return now.select(F.col("hi").alias("node"), F.col("lo").alias("root")).unionByName(
        now.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct()
    )
