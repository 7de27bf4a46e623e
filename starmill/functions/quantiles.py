"""Exact order statistics of columns of any size, by radix selection: only counts move."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DIGIT_BITS = 16
DIGIT = 1 << DIGIT_BITS
# The first digit is the sign and a sixteenth of a power of two; doubles have powers from -1074 to 1023.
PARTS, LOWEST = 16, 1075


def number(col: Column) -> Column:
    """The column as double; NaN, and a text that is no number, as NULL."""
    value = col.try_cast("double")
    return F.when(~F.isnan(value), value)


@dataclass(frozen=True)
class Summary:
    """Moments and quantiles of a column; all but the count are None for a column without values."""

    count: int = 0
    mean: float | None = None
    std: float | None = None
    low: float | None = None
    high: float | None = None
    quantiles: tuple[float | None, ...] = ()


def summaries(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float]) -> dict[str, Summary]:
    """Count, mean, sample deviation, range and linearly interpolated quantiles of numeric columns, NULL and NaN left out.

    A value's first digit comes from its logarithm, its next ones from where it lies between the least and the largest
    value of the same digit so far; both never fall as the value rises, and each digit has 16 bits, so four of them tell any
    two doubles apart. A pass counts the rows of each digit, with its least and largest value; the digits that hold a wanted
    rank and more than one value are cut again in the next pass, mostly there is none after the second. Rows are neither shuffled
    nor written: a task passes on a line for each digit, and the driver gets one row for each wanted rank. The moments of all
    digits, merged, are those of the column, so they need no pass of their own.
    """
    values = df.select(F.inline(F.array(*[
        F.struct(F.lit(i).alias("place"), number(F.col(c)).alias("value")) for i, c in enumerate(columns)])))
    values = values.filter("value IS NOT NULL")
    first = picked = _pass(values, _first_digit(F.col("value")), probabilities)
    found: dict[tuple[int, int], float] = {}
    while picked:
        found |= {(r["place"], r["rank"]): r["low"] for r in picked if r["low"] == r["high"]}
        picked = _again(values, [r for r in picked if r["low"] != r["high"]])
    moments = {r["place"]: r for r in first}
    none = Summary(quantiles=(None,) * len(probabilities))
    return {c: none if i not in moments else Summary(
        moments[i]["total"], moments[i]["mean"], moments[i]["std"], moments[i]["least"], moments[i]["most"],
        tuple(_interpolate(p, moments[i]["total"], i, found) for p in probabilities)) for i, c in enumerate(columns)}


def exact_quantiles(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float]) -> dict[str, list[float | None]]:
    return {c: list(s.quantiles) for c, s in summaries(df, columns, probabilities).items()}


def _first_digit(value: Column) -> Column:
    size = F.floor((F.log2(F.abs(value)) + LOWEST) * PARTS)
    size = F.when(F.abs(value) == float("inf"), DIGIT).otherwise(size)
    return F.when(value > 0, size + 1).when(value < 0, -size - 1).otherwise(0).cast("int")


def _ends() -> list[Column]:
    return [F.count("*").alias("n"), F.min("value").alias("low"), F.max("value").alias("high")]


def _pass(values: DataFrame, digit: Column, probabilities: Sequence[float]) -> list:
    """place, its moments (total, mean, std, least, most), rank, before, low, high: the digit of each wanted rank."""
    whole = Window.partitionBy("place")
    counts = values.withColumn("digit", digit).groupBy("place", "digit").agg(
        *_ends(), F.avg("value").alias("centre"), (F.var_pop("value") * F.count("*")).alias("spread"))
    counts = counts.withColumns({"upto": F.sum("n").over(whole.orderBy("digit")), "total": F.sum("n").over(whole),
                                 "least": F.min("low").over(whole), "most": F.max("high").over(whole)})
    counts = counts.withColumn("mean", F.sum(F.col("n") * F.col("centre")).over(whole) / F.col("total"))
    squares = F.sum(F.col("spread") + F.col("n") * F.pow(F.col("centre") - F.col("mean"), F.lit(2))).over(whole)
    counts = counts.withColumn("std", F.sqrt(F.try_divide(squares, F.col("total") - 1)))
    wanted = F.array_distinct(F.flatten(F.array(*[F.array(F.floor(p * (F.col("total") - 1)), F.ceil(p * (F.col("total") - 1)))
                                                  for p in map(F.lit, map(float, probabilities))])))
    ranks = F.filter(wanted, lambda r: (r >= F.col("upto") - F.col("n")) & (r < F.col("upto")))
    return counts.select("place", "total", "mean", "std", "least", "most", (F.col("upto") - F.col("n")).alias("before"), "low", "high",
                         F.explode(ranks).alias("rank")).collect()


def _again(values: DataFrame, picked: list) -> list:
    """The next digit of ranks whose digit so far holds more than one value."""
    if not picked:
        return []
    spans = sorted({(r["place"], r["before"], r["low"], r["high"]) for r in picked})
    span = F.coalesce(*[F.when((F.col("place") == place) & F.col("value").between(low, high), i)
                        for i, (place, _, low, high) in enumerate(spans)])
    low, high = (F.element_at(F.array(*[F.lit(s[k]) for s in spans]), F.col("span") + 1) for k in (2, 3))
    part = (F.col("value") - low) / (high - low)  # same sign, a sixteenth of a power of two: no overflow, no zero
    cut = values.withColumn("span", span).filter("span IS NOT NULL").withColumn(
        "digit", F.least(F.floor(part * DIGIT), F.lit(DIGIT - 1)).cast("int"))
    counts = cut.groupBy("span", "digit").agg(*_ends()).withColumn("upto", F.sum("n").over(Window.partitionBy("span").orderBy("digit")))
    wanted = F.element_at(F.array(*[
        F.array(*[F.lit(r["rank"]) for r in picked if (r["place"], r["before"], r["low"], r["high"]) == s]) for s in spans]), F.col("span") + 1)
    base = F.element_at(F.array(*[F.lit(s[1]) for s in spans]), F.col("span") + 1)
    counts = counts.withColumn("before", base + F.col("upto") - F.col("n"))
    ranks = F.filter(wanted, lambda r: (r >= F.col("before")) & (r < F.col("before") + F.col("n")))
    place = F.element_at(F.array(*[F.lit(s[0]) for s in spans]), F.col("span") + 1)
    return counts.select(place.alias("place"), "before", "low", "high", F.explode(ranks).alias("rank")).collect()


def _ranks(p: float, n: int) -> tuple[int, int]:
    position = p * (n - 1)
    return math.floor(position), math.ceil(position)


def _interpolate(p: float, n: int, place: int, found: dict[tuple[int, int], float]) -> float:
    below, above = (found[place, r] for r in _ranks(p, n))
    if below == above:  # infinite ones have no difference
        return below
    return below + (above - below) * (p * (n - 1) - math.floor(p * (n - 1)))
