"""Profile reports: shape, columns, statistics, counts, histograms, top-k."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmill import fixed
from starmill.functions.quantiles import number, summaries

DESCRIBE_SCHEMA = ("column string, count bigint, mean double, std double, min double, "
                   "p25 double, p50 double, p75 double, max double")


def shape(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows and columns per table; the count reads no column."""
    frames = [df.agg(F.count("*").alias("rows")).select(
        F.lit(name).alias("table"), "rows", F.lit(len(df.columns)).alias("columns")) for name, df in tables.items()]
    return reduce(DataFrame.unionByName, frames)


def column_profile(df: DataFrame, table: str) -> DataFrame:
    """Position, name, type, rows and missing values of every column, in one pass."""
    counts = df.agg(F.count("*").alias("rows"),
                    *[F.count_if(F.col(f.name).isNull()).alias(f"c{i}") for i, f in enumerate(df.schema.fields)])
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(table).alias("table"), F.lit(i + 1).alias("position"), F.lit(f.name).alias("column"),
                 F.lit(f.dataType.simpleString()).alias("type"), F.col("rows").alias("rows"),
                 F.col(f"c{i}").alias("missing"))
        for i, f in enumerate(df.schema.fields)])))


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, mean, std, min, quartiles, max per numeric column.

    The first pass over the rows gives the moments of all columns and the first digit of the quartiles, which are exact at
    any size (``summaries``). The report has one row per column.
    """
    found = summaries(df, columns, (0.25, 0.5, 0.75))
    lines = [(c, s.count, s.mean, s.std, s.low, *s.quantiles, s.high) for c, s in found.items()]
    return df.sparkSession.createDataFrame(lines, DESCRIBE_SCHEMA)


def total_and_mean(df: DataFrame, column: str, mean_of: str | None = None) -> DataFrame:
    """Sum (0 for no values) and mean, which may be taken of another form of the column, in one scan."""
    return df.agg(F.coalesce(F.sum(column), F.lit(0)).alias("total"), F.avg(mean_of or column).alias("mean"))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, most frequent first; NULL is left out and ties are in value order."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    return counts.orderBy(F.desc("n"), F.asc(column))


def group_sum(df: DataFrame, key: str, value: str, name: str = "total") -> DataFrame:
    return df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.coalesce(F.sum(value), F.lit(0)).alias(name))


def top_k(df: DataFrame, by: str, tie_break: Sequence[str], k: int = fixed.TOP_K,
          columns: Sequence[str] | None = None) -> DataFrame:
    """The ``k`` rows with the largest ``by``; every task keeps only its own best ``k``."""
    out = df.orderBy(F.desc_nulls_last(by), *[F.asc(c) for c in tie_break]).limit(k)
    return out.select(*columns) if columns else out


def top_sums(df: DataFrame, key: str, value: str, k: int = fixed.TOP_K, name: str = "total") -> DataFrame:
    return top_k(group_sum(df, key, value, name), name, [key], k)


def bin_edges(low: float, high: float, bins: int) -> list[float]:
    """Edges of equal-width bins; a single value gets a bin width around it."""
    if low == high:
        low, high = low - 0.5, high + 0.5
    step = (high - low) / bins
    return [low + i * step for i in range(bins)] + [high]


def histogram(df: DataFrame, column: str, bins: int = fixed.AMOUNT_BINS) -> DataFrame:
    """Rows per equal-width bin, empty bins included; the last bin contains the maximum.

    Two scans of one column: the range, then the counts, which are merged per task to at most one
    row per bin.
    """
    values = df.select(number(F.col(column)).alias("v")).filter(F.col("v").isNotNull())
    low, high = values.agg(F.min("v"), F.max("v")).first()
    if low is None:
        return df.sparkSession.createDataFrame([], "bin int, lower double, upper double, n bigint")
    edges = bin_edges(low, high, bins)
    bin_no = reduce(lambda a, b: a + b, [(F.col("v") >= F.lit(e)).cast("int") for e in edges[1:-1]], F.lit(1))
    counted = values.groupBy(bin_no.alias("bin")).agg(F.count("*").alias("n"))
    # One struct per bin with a zero, so that empty bins show up after the second, tiny aggregate.
    frame = F.array(*[F.struct(F.lit(i + 1).alias("bin"), F.lit(edges[i]).alias("lower"),
                               F.lit(edges[i + 1]).alias("upper")) for i in range(bins)])
    counts = counted.agg(F.map_from_entries(F.collect_list(F.struct("bin", "n"))).alias("m"))
    return counts.select("m", F.inline(frame)).select(
        "bin", "lower", "upper", F.coalesce(F.try_element_at("m", F.col("bin")), F.lit(0)).cast("bigint").alias("n"))
