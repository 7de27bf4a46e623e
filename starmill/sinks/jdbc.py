"""Warehouse sink over JDBC."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from starmill.sinks.files import new_rows
from starmill.sources.jdbc import JdbcSource
from starmill.specs import TableSpec

BATCH_ROWS = 10_000
CONNECTIONS = 16


def jdbc_options(url: str, table: str, options: Mapping[str, str] | None = None) -> dict[str, str]:
    """Batched inserts over a bounded number of connections; replacing keeps the table's definition."""
    return {"batchsize": str(BATCH_ROWS), "numPartitions": str(CONNECTIONS), "truncate": "true",
            **(options or {}), "url": url, "dbtable": table}


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append",
               options: Mapping[str, str] | None = None) -> str:
    """Write with the given mode; returns ``written`` or ``empty``."""
    return _status(load_jdbc(df, url, table, mode, options))


def load_jdbc(df: DataFrame, url: str, table: str, mode: str = "append",
              options: Mapping[str, str] | None = None) -> int:
    """Write with the given mode and return the rows, counted in the tasks that write.

    An empty frame must not truncate its target, so a replacing write asks for one row first.
    """
    if mode == "overwrite" and df.isEmpty():
        return 0
    rows = Observation()
    df.observe(rows, F.count(F.lit(1)).alias("rows")).write.format("jdbc").options(
        **jdbc_options(url, table, options)).mode(mode).save()
    return rows.get["rows"]


def _status(rows: int) -> str:
    return "written" if rows else "empty"


def append_new_jdbc(df: DataFrame, existing: DataFrame | None, keys: Sequence[str], url: str, table: str,
                    options: Mapping[str, str] | None = None) -> str:
    """Append only rows whose key the target lacks, so a repeated load or a retry adds nothing."""
    return write_jdbc(new_rows(df, existing, keys), url, table, "append", options)


def held_rows(spark: SparkSession, url: str, schema: str, table: str,
              options: Mapping[str, str] | None = None) -> DataFrame | None:
    """The warehouse table, or None while it does not exist."""
    source = JdbcSource(spark, url, schema, options or {})
    known = source.query(f"{source.tables_sql()} AND table_name = {source.text(table)}")
    if known.isEmpty():
        return None
    return spark.read.format("jdbc").options(**jdbc_options(url, f"{schema}.{table}", options)).load()


def write_spec_jdbc(df: DataFrame, spec: TableSpec, url: str, schema: str,
                    options: Mapping[str, str] | None = None) -> str:
    """Write as the spec says; returns ``written`` or ``empty``."""
    return _status(load_spec_jdbc(df, spec, url, schema, options, replace=spec.mode == "overwrite"))


def load_spec_jdbc(df: DataFrame, spec: TableSpec, url: str, schema: str, options: Mapping[str, str] | None = None, *,
                   replace: bool) -> int:
    """Replace the table, or append the keys that are new, and return the rows. Without a key all rows are new."""
    table = f"{schema}.{spec.name}"
    if replace:
        return load_jdbc(df, url, table, "overwrite", options)
    if spec.keys and set(spec.keys) <= set(df.columns):
        df = new_rows(df, held_rows(df.sparkSession, url, schema, spec.name, options), spec.keys)
    return load_jdbc(df, url, table, "append", options)
