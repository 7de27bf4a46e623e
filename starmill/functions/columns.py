"""Column expressions shared by the operators. All are built-in Spark expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from starmill import fixed


# --- text -------------------------------------------------------------------------------------

def trimmed(col: Column, *, whitespace: bool = False) -> Column:
    """Trim spaces; with ``whitespace`` also tabs, newlines and the like."""
    return F.regexp_replace(col, r"^\s+|\s+$", "") if whitespace else F.trim(col)


def blank_to_null(col: Column, markers: Iterable[str] = ()) -> Column:
    """NULL for an empty text and for every marker text (such as ``NaT`` or ``None``)."""
    out = F.nullif(col, F.lit(""))
    for marker in markers:
        out = F.nullif(out, F.lit(marker))
    return out


def is_blank(col: Column) -> Column:
    """True for a text of whitespace only; NULL is missing, not blank."""
    return F.coalesce(trimmed(col, whitespace=True) == "", F.lit(False))


def lacks_at_sign(col: Column) -> Column:
    """True for an e-mail without ``@``; a missing e-mail counts too."""
    return ~F.coalesce(col.contains("@"), F.lit(False))


def money_text(col: Column) -> Column:
    """Thousands separators and two decimals."""
    return F.format_number(col, 2)


def chunk_label(col: Column) -> Column:
    """Chunk number with four digits; longer numbers keep all theirs."""
    text = col.cast("string")
    return F.when(F.length(text) >= 4, text).otherwise(F.lpad(text, 4, "0"))


# --- time -------------------------------------------------------------------------------------

def parsed_time(col: Column, fmt: str | None = None) -> Column:
    """Timestamp of a text; a text that is none becomes NULL, also in ANSI mode."""
    return F.try_to_timestamp(col, F.lit(fmt)) if fmt else F.try_to_timestamp(col)


def date_id(col: Column) -> Column:
    """Calendar key ``yyyyMMdd`` as an int, by arithmetic: no text is built per row."""
    day = F.to_date(col)
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def time_text(col: Column, pattern: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """Text for a text sink; NULL stays NULL."""
    return F.date_format(col, pattern)


def day_label(col: Column) -> Column:
    """Partition label of a row: its day, or ``no-date``."""
    return F.coalesce(F.date_format(F.to_date(col), fixed.DAY_PATTERN), F.lit(fixed.NO_DATE))


def in_days(col: Column, first: str, last: str | None = None) -> Column:
    """Half-open range over whole days, from ``first`` through ``last`` (default: one day).

    Both bounds are literals of the column's own kind, so the filter reaches the scan.
    """
    lower = F.lit(first).cast("date")
    upper = F.lit(last or first).cast("date") + F.expr("INTERVAL 1 DAY")
    return (col >= lower) & (col < upper)


# --- paths ------------------------------------------------------------------------------------

def path_part(path: Column, index: int) -> Column:
    """Folder or file name of a path by position; negative positions count from the end."""
    return F.try_element_at(F.split(path, "/"), F.lit(index + 1 if index >= 0 else index))


def is_csv(path: Column) -> Column:
    return path.endswith(fixed.CSV_SUFFIX)


def valid_day(text: Column) -> Column:
    """The text when it is a calendar day, else NULL."""
    day = F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_date(text, fixed.DAY_PATTERN))
    return F.when(day.isNotNull(), text)
