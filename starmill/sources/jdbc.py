"""Relational source over JDBC. Connection data come from the caller's options only."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmill import fixed
from starmill.operators.increment import CATALOG_SCHEMA

# Rows one partition of a relational read should fetch.
PARTITION_ROWS = 1_000_000


@dataclass(frozen=True)
class JdbcSource:
    """Tables of one schema. ``options`` holds user, password, driver, fetchsize and the like.

    Reads are split into partitions that the executors fetch in parallel: key ranges or days, never
    pages with an offset, which skip or repeat rows when the table changes meanwhile.
    """

    spark: SparkSession
    url: str
    schema: str
    options: Mapping[str, str] = field(default_factory=dict, repr=False)
    quote: str = '"'

    # --- pieces of SQL ---

    def name(self, column: str) -> str:
        return f"{self.quote}{column.replace(self.quote, self.quote * 2)}{self.quote}"

    def table(self, table: str) -> str:
        return f"{self.name(self.schema)}.{self.name(table)}"

    @staticmethod
    def text(value: str) -> str:
        return "'" + value.replace("'", "''") + "'"

    def tables_sql(self) -> str:
        return ("SELECT table_name FROM information_schema.tables "
                f"WHERE table_schema = {self.text(self.schema)} AND table_type = 'BASE TABLE'")

    def columns_sql(self) -> str:
        return ("SELECT table_name, column_name FROM information_schema.columns "
                f"WHERE table_schema = {self.text(self.schema)}")

    def keys_sql(self) -> str:
        """Key columns of all tables: joined to the constraints, because only some databases call
        every primary key by the same name."""
        return ("SELECT k.table_name, k.column_name, k.ordinal_position "
                "FROM information_schema.key_column_usage k JOIN information_schema.table_constraints c "
                "ON c.constraint_name = k.constraint_name AND c.table_schema = k.table_schema "
                "AND c.table_name = k.table_name "
                f"WHERE k.table_schema = {self.text(self.schema)} AND c.constraint_type = 'PRIMARY KEY'")

    def day_predicates(self, column: str, days: Mapping[str | None, int], key: str | None = None,
                       chunk: int = PARTITION_ROWS) -> list[str]:
        """One predicate per day, and one for rows without a day.

        ``days`` gives the rows of each day. With a numeric ``key`` a day of more than ``chunk`` rows
        is cut into several predicates, so one heavy day is not one long query.
        """
        col, out = self.name(column), []
        for day, rows in {None: 0, **days}.items():
            test = (f"{col} IS NULL" if day is None else
                    f"{col} >= DATE {self.text(day)} AND {col} < DATE {self.text(day)} + INTERVAL '1' DAY")
            parts = max(1, -(-rows // chunk)) if key else 1
            out += [test] if parts == 1 else [f"{test} AND ABS(MOD({self.name(key)}, {parts})) = {i}" for i in range(parts)]
        return out

    def key_range_sql(self, table: str, key: str) -> str:
        """Rows, smallest and largest key, added up by the database."""
        col = self.name(key)
        return (f"SELECT COUNT(*) AS row_count, MIN({col}) AS min_id, COALESCE(MAX({col}), 0) AS max_id "
                f"FROM {self.table(table)}")

    def day_counts_sql(self, table: str, column: str) -> str:
        """Rows per day, cut in the database's own time zone, as the predicates of the days are."""
        day = f"CAST({self.name(column)} AS DATE)"
        return f"SELECT {day} AS day_of_row, COUNT(*) AS row_count FROM {self.table(table)} GROUP BY {day}"

    # --- catalog ---

    def _read(self, **options: str) -> DataFrame:
        return self.spark.read.format("jdbc").options(url=self.url, **self.options, **options).load()

    def query(self, sql: str) -> DataFrame:
        return self._read(query=sql)

    def catalog(self) -> DataFrame:
        """Base tables with all key columns in order and whether they have a change column."""
        tables = self.query(self.tables_sql()).toDF("table")
        return build_catalog(tables, self.query(self.columns_sql()).toDF("table", "column"),
                             self.query(self.keys_sql()).toDF("table", "column", "position"))

    # --- scans ---

    def read(self, table: str) -> DataFrame:
        """Whole table; filters and columns are pushed into the query by Spark."""
        return self._read(dbtable=self.table(table))

    def key_range(self, table: str, key: str) -> DataFrame:
        found = self.query(self.key_range_sql(table, key)).toDF("rows", "min_id", "max_id")
        return found.select(*(F.col(c).cast("bigint").alias(c) for c in found.columns))

    def day_counts(self, table: str, column: str) -> DataFrame:
        return self.query(self.day_counts_sql(table, column)).toDF("day", "rows").orderBy("day")

    def read_by_key(self, table: str, key: str, rows: int, min_id: int | None, max_id: int,
                    chunk: int = PARTITION_ROWS) -> DataFrame:
        return self._read(dbtable=self.table(table), **key_options(key, rows, min_id, max_id, chunk))

    def read_by_day(self, table: str, column: str, days: Mapping[str | None, int],
                    key: str | None = None) -> DataFrame:
        """One or more partitions per day, plus those for rows without a day."""
        properties = {k: str(v) for k, v in self.options.items()}
        return self.spark.read.jdbc(self.url, self.table(table), properties=properties,
                                    predicates=self.day_predicates(column, days, key))


def key_options(key: str, rows: int, min_id: int | None, max_id: int, chunk: int = PARTITION_ROWS) -> dict[str, str]:
    """Range partitions over the key, about ``chunk`` rows each. The bounds only place the cuts: keys
    outside them belong to the first and last partition, so no row is lost."""
    parts = max(1, -(-rows // chunk))
    if parts == 1 or min_id is None:
        return {}
    return {"partitionColumn": key, "lowerBound": str(min_id), "upperBound": str(max_id + 1),
            "numPartitions": str(parts)}


def build_catalog(tables: DataFrame, columns: DataFrame, keys: DataFrame) -> DataFrame:
    """Catalog rows (table, keys, has_change) from the three listings of a schema."""
    change = columns.filter(F.lower("column") == fixed.CHANGE_COLUMN).select("table").distinct()
    ordered = keys.groupBy("table").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("position", "column"))), lambda k: k["column"]).alias("keys"))
    out = (tables.join(ordered, "table", "left")
           .join(change.withColumn("has_change", F.lit(True)), "table", "left"))
    typed = out.select("table", F.coalesce("keys", F.array().cast("array<string>")).alias("keys"),
                       F.coalesce("has_change", F.lit(False)).alias("has_change"))
    return typed.to(tables.sparkSession.createDataFrame([], CATALOG_SCHEMA).schema).orderBy("table")
