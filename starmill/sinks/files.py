"""File sinks: partitioned, repeatable, without a single-file bottleneck."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmill import fixed
from starmill.operators.dedup import latest_per_key
from starmill.operators.increment import with_run_date

# What ``sources.files`` reads back unchanged: embedded quotes are doubled, texts are always quoted
# so that leading spaces and line breaks survive. CSV has no empty text: it comes back as NULL.
CSV_WRITE = {"header": "true", "quote": '"', "escape": '"', "quoteAll": "true",
             "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
CURRENT = "snapshot"


def write_files(df: DataFrame, path: str, *, mode: str = "append", partition_by: Sequence[str] = (),
                constant: Mapping[str, object] | None = None, fmt: str = "parquet",
                max_records: int | None = None, rebalance: bool = False) -> int:
    """Write and return the number of rows written.

    The count is observed in the tasks that write, so it costs no second job. Overwriting with
    partitions replaces only those that occur in ``df``: repeating a load gives the same files, and
    an empty frame replaces nothing. ``rebalance`` gathers the rows of a partition before the write;
    Spark merges small partitions and splits a hot one into files of ordinary size. ``constant``
    gives partition columns one value for all rows: added last, they are known to be constant and the
    rows are not sorted by them.
    """
    rows, constant = Observation(), constant or {}
    varying = [c for c in partition_by if c not in constant]
    if rebalance and varying:
        df = df.hint("rebalance", *varying)
    df = df.observe(rows, F.count(F.lit(1)).alias("rows"))
    for name, value in constant.items():
        df = df.withColumn(name, F.lit(value))
    writer = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        writer = writer.options(**CSV_WRITE)
    if partition_by:
        writer = writer.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
    if max_records:
        writer = writer.option("maxRecordsPerFile", max_records)
    writer.save(path)
    return rows.get["rows"]


def replace_partitions(df: DataFrame, path: str, partition_by: Sequence[str], **options) -> int:
    return write_files(df, path, mode="overwrite", partition_by=partition_by, **{"rebalance": True, **options})


def replace_table(df: DataFrame, path: str, **options) -> int:
    """Replace a whole table, unless ``df`` is empty: then the old rows stay.

    The table is one constant partition, which makes that test part of the write itself instead of
    a second run of the plan.
    """
    return write_files(df, path, mode="overwrite", partition_by=[CURRENT], constant={CURRENT: "current"}, **options)


def write_chunks(df: DataFrame, path: str, column: str | None, *, fmt: str = "csv",
                 chunk: int = fixed.CHUNK_ROWS) -> int:
    """Extract chunks by run date of each row, at most ``chunk`` rows per file."""
    return replace_partitions(with_run_date(df, column), path, ["run_date"], fmt=fmt, max_records=chunk)


def write_increment(df: DataFrame, path: str, run_date: str, run_id: str, *, fmt: str = "csv") -> int:
    """Rows of one run, beside those of earlier runs on the same day; repeating a run replaces it."""
    run = {"run_date": run_date, "run_id": run_id}
    return write_files(df, path, mode="overwrite", partition_by=list(run), constant=run, fmt=fmt)


def read_table(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame | None:
    """The table at ``path``, or None if nothing was written there yet."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    try:
        df = reader.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise
    return df.drop(CURRENT)


def new_rows(df: DataFrame, existing: DataFrame | None, keys: Sequence[str]) -> DataFrame:
    """One row of ``df`` for each key that the table does not hold yet.

    Of repeats in ``df`` the same one stays each time. Of the table only the key columns are read, all of
    them: a key may return with another day.
    """
    df = latest_per_key(df, keys)
    if existing is None:
        return df
    held = existing.select(*keys)
    marks = [df[k].eqNullSafe(held[k]) for k in keys]
    test = marks[0]
    for mark in marks[1:]:
        test = test & mark
    return df.join(held, test, "left_anti")


def append_new(df: DataFrame, path: str, keys: Sequence[str], *, partition_by: Sequence[str] = ()) -> int:
    """Append the rows whose key is new, so that loading a batch twice adds nothing."""
    return write_files(new_rows(df, read_table(df.sparkSession, path), keys), path, partition_by=partition_by,
                       rebalance=bool(partition_by))
