"""Duplicate removal with repeatable survivors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_RANK = "__rank"


def distinct_rows(df: DataFrame) -> DataFrame:
    """One copy of each row. Copies are merged within every map task before the shuffle."""
    return df.dropDuplicates()


def distinct_values(df: DataFrame, **exprs: Column) -> DataFrame:
    return df.select(*[c.alias(n) for n, c in exprs.items()]).distinct()


def survivor_order(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> list[Column]:
    """Newest first, then all other columns, so that equal times still give the same survivor."""
    newest = [c for c in order_by if c in df.columns and c not in keys]
    rest = [f.name for f in df.schema.fields
            if f.name not in keys and f.name not in newest
            and not isinstance(f.dataType, (T.MapType, T.VariantType))]
    return [F.col(c).desc_nulls_last() for c in newest] + [F.col(c).asc_nulls_last() for c in rest]


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] = ()) -> DataFrame:
    """One row per key: the newest by ``order_by``.

    The rank filter lets Spark keep only the best row of a key in each map task, so a key that holds
    a third of the table sends one row per task through the shuffle.
    """
    order = survivor_order(df, keys, order_by)
    if not order:
        return df.select(*keys).distinct()
    by_key = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(_RANK, F.row_number().over(by_key)).filter(F.col(_RANK) == 1).drop(_RANK)


def dedup_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows in, after exact dedup, after key dedup, and the rows each step removes, in one pass.

    Copies collapse first, keys collapse over the collapsed copies; both are counted partially
    before their shuffle, and nothing is sorted.
    """
    copies = df.groupBy(*df.columns).agg(F.count("*").alias("n"))
    per_key = copies.groupBy(*keys).agg(F.sum("n").alias("n"), F.count("*").alias("d"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows_in"),
        F.coalesce(F.sum("d"), F.lit(0)).alias("rows_exact"),
        F.count("*").alias("rows_out"),
    ).select(
        "rows_in", "rows_exact", "rows_out",
        (F.col("rows_in") - F.col("rows_exact")).alias("exact_removed"),
        (F.col("rows_exact") - F.col("rows_out")).alias("key_removed"),
    )
