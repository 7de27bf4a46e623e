"""Connected components over a table of links, by alternating stars; nothing but counts comes to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmill.llm.texts import keep
from starmill.operators.spread import spread_join


def connected(links: DataFrame, a: str, b: str) -> DataFrame:
    """node, component (the smallest node reachable) for every end of a link; ids are longs.

    A step ties the larger neighbours of each node to its smallest neighbour (large star), then the smaller ones (small
    star). Components stay as they are and the links become stars from the smallest node, in a logarithmic number of
    steps. Hot nodes are split in the joins, minima are partly taken before the shuffle.
    """
    pairs = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct()
    pairs = keep(pairs, "components")
    seen = _mark(pairs)
    while True:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("low"))
        large = _tie(both.filter("v > u"), low).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("low"))
        small = _tie(large, low).unionByName(low.withColumnRenamed("low", "v")).filter("u <> v").distinct()
        pairs = keep(small, "components")
        now = _mark(pairs)
        if now == seen:
            break
        seen = now
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        pairs.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _tie(pairs: DataFrame, low: DataFrame) -> DataFrame:
    return spread_join(pairs, low, ["u"], "left", ["u"]).select(F.col("v").alias("u"), F.col("low").alias("v"))


def _mark(pairs: DataFrame) -> tuple:
    """Count and order-free checksum."""
    return tuple(pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
