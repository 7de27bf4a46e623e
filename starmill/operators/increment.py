"""Increment selection, high-water marks, progress ledger and load plans."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmill import fixed
from starmill.functions.columns import day_label, in_days

STATE_SCHEMA = "table string, last_id bigint, bootstrapped boolean"
LEDGER_SCHEMA = ("table string, status string, rows_uploaded bigint, max_pk bigint, error string, "
                 "seconds double, saved_at timestamp")
CATALOG_SCHEMA = "table string, keys array<string>, has_change boolean"


# --- what to extract and how --------------------------------------------------------------------

def plan_extract(catalog: DataFrame) -> DataFrame:
    """Strategy per table: by day if it has a change column, else by its key, else in full.

    Only a key of one column gives a range to read along. An incremental run skips the tables that
    have neither a key nor a change column.
    """
    keys = F.size("keys")
    return catalog.withColumn(
        "strategy", F.when(F.col("has_change"), "date").when(keys == 1, "key").otherwise("full")
    ).withColumn("in_increment", F.col("has_change") | (keys > 0)).orderBy("table")


def split_by_change(catalog: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Tables with and without a change column."""
    return catalog.filter("has_change"), catalog.filter("NOT has_change")


def key_range(df: DataFrame, key: str) -> DataFrame:
    """Rows, smallest and largest key; an empty table has largest key 0."""
    return df.agg(F.count("*").alias("rows"), F.min(key).cast("bigint").alias("min_id"),
                  F.coalesce(F.max(key).cast("bigint"), F.lit(0)).alias("max_id"))


def day_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per day of a column, in order; rows without a day are one line with NULL."""
    return df.groupBy(F.to_date(column).alias("day")).agg(F.count("*").alias("rows")).orderBy("day")


def key_ranges(tables: Mapping[str, tuple[DataFrame, str]], chunk: int = fixed.CHUNK_ROWS) -> DataFrame:
    """Key range and number of chunks per table, from which a partitioned read takes its bounds."""
    frames = [key_range(df, key).select(
        F.lit(name).alias("table"), "rows", "min_id", "max_id",
        F.ceil(F.col("rows") / chunk).cast("bigint").alias("chunks")) for name, (df, key) in tables.items()]
    return reduce(DataFrame.unionByName, frames)


# --- increments ---------------------------------------------------------------------------------

def day_window(df: DataFrame, column: str, first: str, last: str | None = None) -> DataFrame:
    """Rows of one day, or of ``first`` through ``last`` when days were missed."""
    return df.filter(in_days(F.col(column), first, last))


def key_increment(df: DataFrame, key: str, last_id: int) -> DataFrame:
    return df.filter(F.col(key) > F.lit(last_id))


# --- high-water marks ---------------------------------------------------------------------------

def bootstrap_state(tables: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """First marks: the largest key of each table, so that the next run loads only what is new."""
    frames = [key_range(df, key).select(F.lit(name).alias("table"), F.col("max_id").alias("last_id"),
                                        F.lit(True).alias("bootstrapped")) for name, (df, key) in tables.items()]
    return reduce(DataFrame.unionByName, frames)


def written_mark(written: DataFrame, table: str, key: str, last_id: int) -> DataFrame:
    """New mark: the largest key of the rows that were written, or the old mark if there were none."""
    return written.agg(F.coalesce(F.max(key).cast("bigint"), F.lit(last_id)).alias("last_id")).select(
        F.lit(table).alias("table"), "last_id", F.lit(True).alias("bootstrapped"))


def current_state(log: DataFrame) -> DataFrame:
    """Marks only grow, so the state of an append-only log is the maximum per table."""
    return log.groupBy("table").agg(F.max("last_id").alias("last_id"), F.max("bootstrapped").alias("bootstrapped"))


# --- progress -----------------------------------------------------------------------------------

def current_ledger(log: DataFrame) -> DataFrame:
    """Newest entry per table."""
    fields = [c for c in log.columns if c != "table"]
    newest = F.max_by(F.struct(*fields), F.struct("saved_at", "status")).alias("e")
    return log.groupBy("table").agg(newest).select("table", *[f"e.{c}" for c in fields])


def work_list(units: DataFrame, ledger: DataFrame, on: str | Sequence[str] = "table") -> DataFrame:
    """Units of work that the ledger does not list as done."""
    keys = [on] if isinstance(on, str) else list(on)
    done = ledger.filter(F.col("status") == "done").select(*keys).distinct()
    return units.join(done, on=keys, how="left_anti")


def ledger_totals(ledger: DataFrame) -> DataFrame:
    return ledger.agg(F.count("*").alias("tables"),
                      F.count_if(F.col("status") == "done").alias("done"),
                      F.count_if(F.col("status") == "error").alias("failed"),
                      F.coalesce(F.sum("rows_uploaded"), F.lit(0)).alias("rows_uploaded"),
                      F.coalesce(F.sum("seconds"), F.lit(0.0)).alias("seconds"))


# --- load plan ----------------------------------------------------------------------------------

def with_run_date(df: DataFrame, column: str | None) -> DataFrame:
    """Add the partition label of each row; a table without the column is all ``no-date``."""
    label = day_label(F.col(column)) if column and column in df.columns else F.lit(fixed.NO_DATE)
    return df.withColumn("run_date", label)


def load_manifest(df: DataFrame, table: str, column: str | None, chunk: int = fixed.CHUNK_ROWS) -> DataFrame:
    """Dry run: rows and chunk files per partition that a load would write."""
    days = with_run_date(df, column).groupBy("run_date").agg(F.count("*").alias("rows"))
    return days.select(F.lit(table).alias("table"), "run_date", "rows",
                       F.ceil(F.col("rows") / chunk).cast("bigint").alias("files"))
