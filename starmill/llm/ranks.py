"""Places of rows within their group, however large a group is: dealt out by range, counted part by part."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmill.llm.texts import keep

ROW_BITS = 33  # fixed value: monotonically_increasing_id holds the part above that many bits


def ranked(frame: DataFrame, group: Sequence[str], order: Sequence[Column], rank: str = "rank", rows: str = "rows") -> DataFrame:
    """``frame`` with the place of each row in its group (from 0) and the group's number of rows, both longs.

    Rows are dealt out and sorted by group and order, so a hot group takes many tasks; the first place and the rows of each
    (group, part), which are about as few as parts and groups together, say where each part goes on. Rows that tie get
    different places, in an order that may be another in another run. Group columns must not be null; columns called
    ``__tie``, ``__at`` and ``__part`` are taken. An empty frame stays empty.
    """
    group = list(group)
    tied = frame.withColumn("__tie", F.monotonically_increasing_id())
    by = [*(F.col(c) for c in group), *order, F.col("__tie")]
    placed = tied.repartitionByRange(*by).sortWithinPartitions(*by).drop("__tie")
    placed = keep(placed.withColumn("__at", F.monotonically_increasing_id()), "ranks").withColumn(
        "__part", F.shiftright("__at", ROW_BITS))
    parts = placed.groupBy(*group, "__part").agg(F.min("__at").alias("__first"), F.count("*").alias("__n"))
    whole = Window.partitionBy(*group)
    before = F.sum("__n").over(whole.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.select(*group, "__part", (F.coalesce(before, F.lit(0)) - F.col("__first")).alias("__shift"),
                         F.sum("__n").over(whole).alias(rows))
    return placed.join(parts, [*group, "__part"]).withColumn(rank, F.col("__at") + F.col("__shift")).drop(
        "__at", "__part", "__shift")


def null_first(column: Column) -> Column:
    """A text that is never null and sorts as the column does, null before all."""
    return F.coalesce(F.concat(F.lit("="), column.cast("string")), F.lit(""))


def null_last(column: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), column.cast("string")), F.lit(">"))
