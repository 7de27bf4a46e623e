"""Refreshing a star by what changed: only the rows that a change can reach are built again.

A change in a lookup reaches the tables that look it up, level by level: a city its addresses, those their customers. The keys of
the changed rows are carried through the lookups of a star table (semi joins on keys, from the far end to the base); the base rows
they reach are built as always, from lookups cut to the keys that these rows use, and take the place of their old forms.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmill.operators.lookup import Lookup
from starmill.operators.star import SHAPES, Shape, Tables, date_dimension
from starmill.session import work_folder

TIMES, SKIPPED = "__times", "__skipped"  # columns that exist only while states are compared
RUN = 10_000


def changed_rows(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows that only one of two states has, each as often as the states differ: what was added, taken away, or changed (in both
    forms). Extracts that already know their changes give them instead; both forms of a row are needed.

    Both states are shuffled once, equal rows counted against each other. What a row is repeated by comes in ``RUN`` at a time.
    """
    columns = [F.col(f"`{c}`") for c in old.columns]
    both = old.withColumn(TIMES, F.lit(1)).union(new.select(*columns).withColumn(TIMES, F.lit(-1)))
    diff = both.groupBy(*columns).agg(F.abs(F.sum(TIMES)).alias(TIMES)).filter(F.col(TIMES) > 0)
    runs = diff.withColumn(SKIPPED, F.explode(F.sequence(F.lit(0), F.col(TIMES) - 1, F.lit(RUN))))
    return runs.withColumn(TIMES, F.explode(F.sequence(F.lit(1), F.least(F.lit(RUN), F.col(TIMES) - F.col(SKIPPED))))).select(*columns)


def touched_keys(look: Lookup, changed: Lookup) -> DataFrame:
    """Keys of a lookup, under the names of its base, that a change reaches."""
    keys = list(look.on.values())
    found = [changed.table.select(*keys)]
    for below, changed_below in zip(look.then, changed.then, strict=True):
        found.append(look.table.join(touched_keys(below, changed_below), list(below.on), "left_semi").select(*keys))
    every = reduce(DataFrame.unionByName, found).distinct()
    return every.select(*[F.col(key).alias(base) for base, key in look.on.items()])


def touched(shape: Shape, changed: Shape) -> DataFrame:
    """Keys of a star table whose row may differ; NULL is a key here."""
    found = [changed.base.select(shape.key)]
    for look, changed_look in zip(shape.lookups, changed.lookups, strict=True):
        found.append(shape.base.join(touched_keys(look, changed_look), list(look.on), "left_semi").select(shape.key))
    return reduce(DataFrame.unionByName, found).distinct()


def _staged(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to the work folder and read back, for what is used several times."""
    path = work_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _with_keys(df: DataFrame, keys: DataFrame, column: str) -> DataFrame:
    """Rows whose key is in ``keys``. Rows without key, where these are asked for, come apart: a plain equality lets the join share
    the shuffle of what else goes by key."""
    found = df.join(keys, column, "left_semi")
    return found.unionByName(df.filter(F.col(column).isNull())) if _lost(keys, column) else found


def _without_keys(df: DataFrame, keys: DataFrame, column: str) -> DataFrame:
    df = df.filter(F.col(column).isNotNull()) if _lost(keys, column) else df
    return df.join(keys, column, "left_anti")


def _lost(keys: DataFrame, column: str) -> bool:
    return bool(keys.filter(F.col(column).isNull()).head(1))


def narrowed(look: Lookup, base: DataFrame) -> Lookup:
    """The lookup with the rows that ``base`` uses, and so on for what starts from it."""
    used = base.select(*[F.col(b).alias(k) for b, k in look.on.items()]).distinct()
    table = look.table.join(used, list(look.on.values()), "left_semi")
    return replace(look, table=table, then=tuple(narrowed(below, table) for below in look.then))


def refreshed(old: DataFrame, shape: Shape, changed: Shape) -> DataFrame:
    """The star table ``old`` as it is after the changes; ``shape`` holds the sources as they are now, ``changed`` the changed rows."""
    keys = _staged(touched(shape, changed), "refresh-keys")
    base = _staged(_with_keys(shape.base, keys, shape.key).select(*shape.base.columns), "refresh-base")
    again = replace(shape, base=base, lookups=tuple(narrowed(look, base) for look in shape.lookups)).build()
    stale = keys.select(F.col(shape.key).cast(old.schema[shape.key].dataType).alias(shape.key))
    return _without_keys(old, stale, shape.key).select(*old.columns).unionByName(again.select(*old.columns))


def refreshed_calendar(old: DataFrame, rows: DataFrame, changed: DataFrame, column: str) -> DataFrame:
    """A calendar after changes: days of changed rows are looked for again, all others stay."""
    day = F.to_date(column)
    days = changed.select(day.alias("__day")).filter("__day IS NOT NULL").distinct()
    held = rows.select(day.alias(column)).distinct()  # before the join, so that days meet and not rows
    again = date_dimension(held.join(days, F.col(column) == F.col("__day"), "left_semi"), column, ordered=False)
    return old.join(days, F.col("full_date") == F.col("__day"), "left_anti").unionByName(again)


def refresh(name: str, old: DataFrame, tables: Tables, changes: Mapping[str, DataFrame]) -> DataFrame:
    """One table of the rental star. ``tables`` are the cleaned sources now, ``changes`` the cleaned changed rows (old and new
    forms) of those that changed."""
    changed = {t: changes.get(t, df.limit(0)) for t, df in tables.items()}
    if name == "dim_date":
        return refreshed_calendar(old, tables["payment"], changed["payment"], "payment_date")
    return refreshed(old, SHAPES[name](tables), SHAPES[name](changed))

