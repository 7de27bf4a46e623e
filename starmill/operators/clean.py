"""Composite cleaners: names, trim, blanks, types, empty rows, fills, dedup, table rules."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmill.functions.columns import blank_to_null, parsed_time, trimmed
from starmill.functions.names import normalise_columns
from starmill.operators.dedup import distinct_rows, latest_per_key
from starmill.specs import TableSpec


# Columns that exist only while a table is cleaned.
UNREAD, RAW_KEY = "__unread", "__raw_key"
# Holds the digits that a money text may have, to see whether a narrower type keeps them all.
WIDE = "decimal(38,12)"


@dataclass(frozen=True)
class Profile:
    drop_empty: bool = True
    exact: bool = True
    per_key: bool = False


PROFILES = {
    "incremental": Profile(),
    "historical": Profile(per_key=True),
    "warehouse": Profile(per_key=True),
    "star": Profile(drop_empty=False),
    # For builders that reduce every table to one row per key themselves: copies need no own pass.
    "star_sources": Profile(drop_empty=False, exact=False),
}


@cache
def type_of(name: str) -> T.DataType:
    return T.DataType.fromDDL(name)


def column_classes(df: DataFrame, spec: TableSpec) -> dict[str, list[str]]:
    """Columns by class; the spec decides first, the type of the data second."""
    out: dict[str, list[str]] = {"text": [], "numeric": [], "time": [], "other": []}
    for f in df.schema.fields:
        out[_class(type_of(spec.types[f.name]) if f.name in spec.types else f.dataType)].append(f.name)
    return out


def _class(data_type: T.DataType) -> str:
    if isinstance(data_type, (T.StringType, T.CharType, T.VarcharType)):
        return "text"
    if isinstance(data_type, T.NumericType):
        return "numeric"
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return "time"
    return "other"


def typed(col: Column, source: T.DataType, target: str | None) -> Column:
    """Cast to the spec's type; what cannot be cast, or is too large, becomes NULL. Decimals are rounded."""
    if target is None or source == type_of(target):
        return col
    if target == "timestamp" and isinstance(source, T.StringType):
        return parsed_time(col)
    return col.try_cast(target)


def tidy(df: DataFrame, spec: TableSpec, *, whitespace: bool = False, markers: Sequence[str] = (),
         unread: bool = False) -> DataFrame:
    """Trim, blank to NULL and type every column in one projection.

    ``unread`` adds the values that were there and are NULL now, as an array of column and value, where
    there can be such values. A text that is no time is as good as none.
    """
    out, lost = [], []
    for f in df.schema.fields:
        col, target = F.col(f.name), spec.types.get(f.name)
        if isinstance(f.dataType, T.StringType):
            col = blank_to_null(trimmed(col, whitespace=whitespace), markers)
        value = typed(col, f.dataType, target)
        out.append(value.alias(f.name))
        if target not in (None, "timestamp") and f.dataType != type_of(target):
            lost.append(F.when(col.isNotNull() & value.isNull(), F.struct(
                F.lit(f.name).alias("column"), col.cast("string").alias("value"))))
    if unread and lost:
        out.append(F.filter(F.array(*lost), lambda x: x.isNotNull()).alias(UNREAD))
    return df.select(*out)


def is_unread(column: str) -> Column:
    return F.exists(UNREAD, lambda x: x["column"] == column)


def rejects(df: DataFrame, spec: TableSpec, **options) -> DataFrame:
    """Values that the spec's types cannot hold, by column, with the number of their rows: those that cannot be read or
    are too large (``unread``) and decimals with more digits than are kept (``rounded``)."""
    df = normalise_columns(df)
    raw = tidy(df, TableSpec(spec.name), **options)
    found = []
    for f in raw.schema.fields:
        target = spec.types.get(f.name)
        if target is None or f.dataType == type_of(target):
            continue
        col, value = F.col(f.name), typed(F.col(f.name), f.dataType, target)
        kind = F.when(col.isNotNull() & value.isNull(), "unread")
        if isinstance(type_of(target), T.DecimalType):
            kind = kind.when(value != col.try_cast(WIDE), "rounded")
        found.append(F.when(kind.isNotNull(), F.struct(
            F.lit(f.name).alias("column"), kind.alias("kind"), col.cast("string").alias("value"))))
    if not found:
        return df.sparkSession.createDataFrame([], "column string, kind string, value string, rows bigint")
    lost = raw.select(F.explode(F.filter(F.array(*found), lambda x: x.isNotNull())).alias("x"))
    return lost.select("x.*").groupBy("column", "kind", "value").agg(F.count("*").alias("rows"))


def drop_empty_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Drop rows that hold nothing but their key. A value that cannot be read is something."""
    values = [c for c in df.columns if c not in keys and c != UNREAD]
    if UNREAD in df.columns and values:
        some = F.size(UNREAD) > 0
        for c in values:
            some = some | F.col(c).isNotNull()
        return df.filter(some)
    return df.dropna(how="all", subset=values) if values else df


def fill_defaults(df: DataFrame, spec: TableSpec, carry: Sequence[str] = ()) -> DataFrame:
    """Numeric NULL to 0 and text NULL to "", never in a primary or foreign key, nor where a value could
    not be read: it stays NULL."""
    out = []
    for f in df.schema.fields:
        col = F.col(f.name)
        if f.name not in spec.unfilled and f.name not in carry:
            if isinstance(f.dataType, T.NumericType):
                zero = F.lit(0).cast(f.dataType)
                if UNREAD in df.columns and f.name in spec.types:
                    zero = F.when(~is_unread(f.name), zero)
                col = F.coalesce(col, zero)
            elif isinstance(f.dataType, T.StringType):
                col = F.coalesce(col, F.lit(""))
        out.append(col.alias(f.name))
    return df.select(*out)


def clean(spec: TableSpec, profile: str = "historical", *, whitespace: bool = False,
          markers: Sequence[str] = (), fill: bool = True, empty_after_fill: bool = False,
          carry: Sequence[str] = ()) -> Callable[[DataFrame], DataFrame]:
    """Cleaner for ``df.transform``.

    ``carry`` names columns that describe the load (such as the run date) and not the row: they are
    never filled and do not make an empty row count as full.

    Empty rows are found before the fills, because afterwards no text or number is NULL any more;
    ``empty_after_fill`` gives the other order. Where rows are reduced to one per key, the pass over
    exact copies is left out: the survivor is chosen by a total order, so copies of it cannot change
    the result, and the shuffle of whole rows is saved.

    Values that cannot be read are NULL and never filled (``rejects`` lists them). Rows differ if such
    values differ: a key that cannot be read is not merged with another one.
    """
    steps = PROFILES[profile]

    def run(df: DataFrame) -> DataFrame:
        df = tidy(normalise_columns(df), spec, whitespace=whitespace, markers=markers, unread=True)
        if steps.drop_empty and not empty_after_fill:
            df = drop_empty_rows(df, [*spec.keys, *spec.names, *carry])
        if fill:
            df = fill_defaults(df, spec, carry)
        if steps.drop_empty and empty_after_fill:
            df = drop_empty_rows(df, [*spec.keys, *spec.names, *carry])
        keyed = steps.per_key and spec.keys and set(spec.keys) <= set(df.columns)
        if keyed:
            df = _latest(df, spec)
        elif steps.exact:
            df = distinct_rows(df)
        df = df.drop(UNREAD)
        for rule in spec.rules:
            df = df.transform(rule)
        return df

    return run


def _latest(df: DataFrame, spec: TableSpec) -> DataFrame:
    if UNREAD not in df.columns:
        return latest_per_key(df, spec.keys, spec.order_by)
    raw = F.filter(UNREAD, lambda x: x["column"].isin(*spec.keys))
    df = df.withColumn(RAW_KEY, F.when(F.size(raw) > 0, F.to_json(raw)))
    return latest_per_key(df, [*spec.keys, RAW_KEY], spec.order_by).drop(RAW_KEY)
