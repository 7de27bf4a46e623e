"""Sets of integer keys as merged intervals: what was loaded, and the gaps that rows may still come into."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKET_BITS = 20  # keys, or interval starts, that a task sorts together
PART_BITS = 16    # keys of a bucket in the join of rows with many gaps
MOST_RANGES = 100  # gaps that become literal ranges of the scan; all others are joined


def islands(df: DataFrame, key: str) -> DataFrame:
    """low, high: the runs of consecutive keys in ``df``; NULL is no key.

    Keys are sorted bucket by bucket, so a table of any size is many tasks; runs over a bucket's end are joined after.
    """
    keys = df.select(F.col(key).cast("bigint").alias("k")).filter("k IS NOT NULL").distinct()
    keys = keys.withColumn("bucket", F.shiftright("k", BUCKET_BITS))
    place = F.row_number().over(Window.partitionBy("bucket").orderBy("k"))
    runs = keys.withColumn("run", F.col("k") - place).groupBy("bucket", "run").agg(F.min("k").alias("low"), F.max("k").alias("high"))
    return merged(runs.select("low", "high"))


def merged(intervals: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The fewest intervals that hold the same keys, for each ``by``; overlapping and touching ones become one.

    First within buckets of starts, then over what is left, which is a row for each gap and bucket.
    """
    near = _merged(intervals.withColumn("bucket", F.shiftright("low", BUCKET_BITS)), [*by, "bucket"])
    return _merged(near.drop("bucket"), list(by))


def _merged(intervals: DataFrame, by: list[str]) -> DataFrame:
    group = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    before = F.max("high").over(group.orderBy("low", "high").rowsBetween(Window.unboundedPreceding, -1))
    starts = intervals.withColumn("starts", (before.isNull() | (F.col("low") - 1 > before)).cast("int"))
    island = F.sum("starts").over(group.orderBy("low", "high").rowsBetween(Window.unboundedPreceding, 0))
    return starts.withColumn("island", island).groupBy(*by, "island").agg(
        F.min("low").alias("low"), F.max("high").alias("high")).drop("island")


def gaps(intervals: DataFrame, low: int, top: int) -> DataFrame:
    """low, high: the keys from ``low`` to ``top`` that no interval holds."""
    inside = intervals.select("low", "high").filter((F.col("high") >= low) & (F.col("low") <= top))
    ends = intervals.sparkSession.createDataFrame([(low - 1, low - 1), (top + 1, top + 1)], "low bigint, high bigint")
    whole = merged(inside.unionByName(ends))
    after = F.lead("low").over(Window.partitionBy(F.lit(0)).orderBy("low"))
    return whole.select((F.col("high") + 1).alias("low"), (after - 1).alias("high")).filter("high >= low")


def in_gaps(df: DataFrame, key: str, open_gaps: DataFrame, most: int = MOST_RANGES) -> DataFrame:
    """The rows of ``df`` whose key lies in a gap.

    The widest gaps are literal ranges, which reach the scan or the database. If there are more, their rows are found by a join on
    parts of the key space, so any number of gaps is read exactly.
    """
    wide = open_gaps.withColumn("width", F.col("high") - F.col("low"))
    widest = [(r.low, r.high) for r in wide.orderBy(F.desc("width"), "low").limit(most + 1).collect()]
    ranges = widest[:most]
    out = df.filter(_within(F.col(key), ranges))
    if len(widest) <= most:
        return out
    rest = open_gaps.filter(~F.struct("low", "high").isin(*[F.struct(F.lit(a).cast("bigint").alias("low"), F.lit(b).cast("bigint").alias("high")) for a, b in ranges]))
    rest = rest.select(F.col("low").alias("__low"), F.col("high").alias("__high"), F.explode(F.sequence(
        F.shiftright("low", PART_BITS), F.shiftright("high", PART_BITS))).alias("__part"))
    value = F.col(key).cast("bigint")
    found = df.withColumn("__part", F.shiftright(value, PART_BITS)).join(rest, "__part").filter(value.between(F.col("__low"), F.col("__high")))
    return out.unionByName(found.select(*df.columns))


def _within(key: Column, ranges: Sequence[tuple[int, int]]) -> Column:
    return reduce(Column.__or__, [(key >= a) & (key <= b) for a, b in ranges], F.lit(False))
