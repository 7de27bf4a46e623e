"""Types of text columns from all their values: one pass, mergeable counts, and the values that speak against a type.

Each value has a narrowest kind; kinds are ordered ``int < bigint < decimal < double`` and ``date < timestamp``, everything else
only meets in ``string``. Counts by (column, kind) merge map-side, so a column's type is the least kind above all kinds that
occur, whatever the order or number of files. Blank cells are missing and say nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Kinds in the order of their family; a kind holds the values of those before it in the family.
NUMBERS, TIMES = ("int", "bigint", "decimal", "double"), ("date", "timestamp")
KINDS = ("boolean", *NUMBERS, *TIMES, "string")
DIGITS = 38  # fixed value: what a decimal can have

INTEGER = r"^[+-]?[0-9]+$"
REAL = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"
DAY = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
TIME = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}:[0-9]{2}([.][0-9]{1,6})?$"


def digits(value: Column) -> Column:
    return F.length(F.regexp_replace(value, "^[+-]?0*", ""))


def kind(value: Column) -> Column:
    """The narrowest kind that holds a text."""
    whole = value.rlike(INTEGER)
    return (F.when(whole & value.try_cast("int").isNotNull(), "int")
            .when(whole & value.try_cast("bigint").isNotNull(), "bigint")
            .when(whole & (digits(value) <= DIGITS), "decimal")
            .when(value.rlike(REAL), "double")
            .when(value.rlike(DAY) & value.try_cast("date").isNotNull(), "date")
            .when(value.rlike(TIME) & value.try_cast("timestamp").isNotNull(), "timestamp")
            .when(F.lower(value).isin("true", "false"), "boolean")
            .otherwise("string"))


def kind_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """position, column, kind, rows, example (the least text of that kind), digits; kind is null for missing values."""
    columns = df.columns if columns is None else columns
    cells = df.select(F.inline(F.array(*[
        F.struct(F.lit(i).alias("position"), F.lit(c).alias("column"), F.nullif(F.col(c).cast("string"), F.lit("")).alias("value"))
        for i, c in enumerate(columns, 1)])))
    cells = cells.withColumn("kind", F.when(F.col("value").isNotNull(), kind(F.col("value"))))
    return cells.groupBy("position", "column", "kind").agg(
        F.count("*").alias("rows"), F.min("value").alias("example"),
        F.max(F.when(F.col("kind").isin("int", "bigint", "decimal"), digits(F.col("value")))).alias("digits"))


def _has(kinds: Column, *names: str) -> Column:
    return F.arrays_overlap(kinds, F.array(*map(F.lit, names)))


def least_type(kinds: Column, most_digits: Column) -> Column:
    """The least type above a set of kinds; text where nothing is known."""
    only = lambda family: F.size(F.array_except(kinds, F.array(*map(F.lit, family)))) == 0
    number = F.when(_has(kinds, "double"), "double").when(
        _has(kinds, "decimal"), F.concat(F.lit("decimal("), most_digits.cast("string"), F.lit(",0)"))).when(
        _has(kinds, "bigint"), "bigint").otherwise("int")
    return (F.when(F.size(kinds) == 0, "string").when(only(NUMBERS), number)
            .when(only(TIMES), F.when(_has(kinds, "timestamp"), "timestamp").otherwise("date"))
            .when(only(("boolean",)), "boolean").otherwise("string"))


def type_report(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """position, column, type, rows, missing, usual, misfits, counter_example.

    ``usual`` is the kind that most values have; ``misfits`` are the values that it does not hold, with the least of them as an
    example: what made the type wider, or a text of it.
    """
    found = kind_counts(df, columns)
    order = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    filled = F.col("kind").isNotNull()
    lines = found.groupBy("position", "column").agg(
        F.sum("rows").alias("rows"), F.coalesce(F.sum(F.when(~filled, F.col("rows"))), F.lit(0)).alias("missing"),
        F.collect_set("kind").alias("kinds"), F.max("digits").alias("digits"),
        F.max(F.when(filled, F.struct("rows", (-order).alias("order"), "kind")))["kind"].alias("usual"),
        F.collect_list(F.when(filled, F.struct("kind", "rows", "example"))).alias("each"))
    holds = F.array(*[F.struct(F.lit(k).alias("kind"), F.array(*map(F.lit, _held(k))).alias("held")) for k in KINDS])
    held = F.filter(holds, lambda h: h["kind"] == F.col("usual"))[0]["held"]
    misfits = F.filter("each", lambda e: ~F.array_contains(held, e["kind"]))
    return lines.withColumn("misfit", F.when(F.col("usual").isNotNull(), misfits)).select(
        "position", "column", least_type(F.col("kinds"), F.col("digits")).alias("type"), "rows", "missing", "usual",
        F.coalesce(F.aggregate("misfit", F.lit(0).cast("bigint"), lambda a, e: a + e["rows"]), F.lit(0)).alias("misfits"),
        F.array_min(F.transform("misfit", lambda e: e["example"])).alias("counter_example"))


def _held(kind: str) -> tuple[str, ...]:
    """The kinds whose values a kind holds."""
    for family in (NUMBERS, TIMES):
        if kind in family:
            return family[:family.index(kind) + 1]
    return KINDS if kind == "string" else (kind,)


def inferred_types(df: DataFrame, columns: Sequence[str] | None = None) -> dict[str, str]:
    """Column to type; the report has one row for each column of the frame."""
    return {r["column"]: r["type"] for r in type_report(df, columns).orderBy("position").collect()}


def with_inferred_types(df: DataFrame) -> DataFrame:
    """Text columns in the narrowest type that holds all their values."""
    text = [c for c, t in df.dtypes if t == "string"]
    types = inferred_types(df, text)
    return df.select(*(F.nullif(F.col(c), F.lit("")).try_cast(types[c]).alias(c) if c in types else F.col(c) for c in df.columns))
