"""Equi joins whose missing and hot keys do not end up in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SPREAD = "__spread"


def spread_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str,
                spread_by: Sequence[str]) -> DataFrame:
    """Left outer or left anti join on ``keys`` that keeps the rows of ``left`` spread out.

    A second join column is added: the hash of the key, or, where the key is NULL and cannot match,
    the hash of ``spread_by``. So rows without a key go to all tasks instead of one. As neither side
    is partitioned by that column beforehand, both are shuffled for this join alone, which is what
    Spark needs to split a hot key of ``left`` at run time (adaptive skew join). A small ``right`` is
    broadcast as in any join.
    """
    if how not in ("left", "left_anti"):
        raise ValueError("only joins that keep or test the left rows can be spread")
    if not all(_same_hash(left.schema[k].dataType, right.schema[k].dataType) for k in keys):
        return left.join(right, on=list(keys), how=how)
    whole = F.lit(True)
    for k in keys:
        whole = whole & F.col(k).isNotNull()
    left = left.withColumn(SPREAD, F.when(whole, _key_hash(left, keys)).otherwise(F.hash(*spread_by)))
    right = right.withColumn(SPREAD, _key_hash(right, keys))
    return left.join(right, on=[*keys, SPREAD], how=how).drop(SPREAD)


def _key_hash(df: DataFrame, keys: Sequence[str]) -> Column:
    return F.hash(*[_plain(F.col(k), df.schema[k].dataType) for k in keys])


def _plain(col: Column, data_type: T.DataType) -> Column:
    """Integers of any width hash alike."""
    return col.cast("bigint") if isinstance(data_type, T.IntegralType) else col


def _same_hash(a: T.DataType, b: T.DataType) -> bool:
    return a == b or (isinstance(a, T.IntegralType) and isinstance(b, T.IntegralType))
