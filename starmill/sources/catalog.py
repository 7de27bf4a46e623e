"""Tables that Spark itself knows: a registry of frames as an extract source."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from starmill import fixed
from starmill.operators.increment import CATALOG_SCHEMA, day_counts, key_range


def has_column(df: DataFrame, column: str) -> bool:
    return column in df.columns


def list_tables(spark: SparkSession, database: str | None = None) -> list[str]:
    return sorted(t.name for t in spark.catalog.listTables(database) if t.tableType != "TEMPORARY")


@dataclass(frozen=True)
class FrameSource:
    """Extract source over named frames (files, Spark tables), with the same interface as JDBC."""

    spark: SparkSession
    frames: Mapping[str, DataFrame]
    keys: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    change: str = fixed.CHANGE_COLUMN

    def catalog(self) -> DataFrame:
        rows = [(t, list(self.keys.get(t, ())), has_column(df, self.change)) for t, df in self.frames.items()]
        return self.spark.createDataFrame(rows, CATALOG_SCHEMA).orderBy("table")

    def read(self, table: str) -> DataFrame:
        return self.frames[table]

    def key_range(self, table: str, key: str) -> DataFrame:
        return key_range(self.frames[table], key)

    def day_counts(self, table: str, column: str) -> DataFrame:
        return day_counts(self.frames[table], column)

    def read_by_key(self, table: str, key: str, rows: int, min_id: int | None, max_id: int) -> DataFrame:
        return self.frames[table]

    def read_by_day(self, table: str, column: str, days: Mapping[str | None, int],
                    key: str | None = None) -> DataFrame:
        return self.frames[table]


def spark_tables(spark: SparkSession, database: str | None = None) -> FrameSource:
    prefix = f"{database}." if database else ""
    return FrameSource(spark, {t: spark.table(prefix + t) for t in list_tables(spark, database)})
