"""Table rules for ``TableSpec.rules``; each skips a table that lacks its column."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Rule = Callable[[DataFrame], DataFrame]


def _on(column: str, change: Callable[[DataFrame], DataFrame]) -> Rule:
    return lambda df: change(df) if column in df.columns else df


def keep_where(column: str, test: Callable[[Column], Column]) -> Rule:
    return _on(column, lambda df: df.filter(test(F.col(column))))


def rewrite(column: str, change: Callable[[Column], Column]) -> Rule:
    return _on(column, lambda df: df.withColumn(column, change(F.col(column))))


def keep_positive(column: str) -> Rule:
    return keep_where(column, lambda c: c > 0)


def keep_not_negative(column: str) -> Rule:
    return keep_where(column, lambda c: c >= 0)


def rounded(column: str, digits: int = 2) -> Rule:
    return rewrite(column, lambda c: F.round(c, digits))


def lowered(column: str) -> Rule:
    return rewrite(column, F.lower)


# The usual rules per source table.
PAYMENT_RULES = (keep_positive("amount"), rounded("amount"))
CUSTOMER_RULES = (lowered("email"),)
FILM_RULES = (keep_not_negative("rental_rate"),)
