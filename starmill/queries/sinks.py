"""Queries that write and read back, in the shared work folder."""

from __future__ import annotations

from pyspark.sql import functions as F

from starmill.functions.columns import time_text
from starmill.operators.clean import clean
from starmill.operators.increment import with_run_date
from starmill.queries.base import query, table
from starmill.session import work_folder
from starmill.sinks.files import (append_new, read_table, replace_partitions, replace_table, write_chunks, write_files,
                                  write_increment)
from starmill.sinks.keyindex import append_indexed
from starmill.sources.files import read_csv, text_schema
from starmill.specs import TableSpec


@query("csv_roundtrip", "SELECT doc_id, text, lang, source, n_chars FROM documents")
def csv_roundtrip(spark, root):
    """Whole texts with quotes, commas and line breaks survive a CSV file."""
    documents, path = table(spark, root, "documents"), work_folder(spark, "csv")
    write_files(documents, path, fmt="csv")
    return read_csv(spark, path, documents.schema)


@query("csv_chunks", """SELECT event_id, user_id, event_type, value, props, strftime(ts, '%Y-%m-%d %H:%M:%S') AS last_update
FROM events""")
def csv_chunks(spark, root):
    """Extract to text chunks by day, read all chunks as one table, clean and type it.

    Some rows were first extracted without their time: they lie under ``no-date`` and again under
    their day, and the dated version is kept.
    """
    events = table(spark, root, "events").withColumnRenamed("ts", "last_update")
    events = events.withColumn("last_update", time_text(F.col("last_update")))
    columns, path = ["event_id", "user_id", "event_type", "value", "props", "last_update"], work_folder(spark, "chunks")
    undated = events.filter(F.col("event_id") % 25 == 0).withColumn("last_update", F.lit(None).cast("string"))
    write_chunks(events.select(columns), f"{path}/first", "last_update", chunk=1000)
    write_chunks(undated.select(columns), f"{path}/second", "last_update", chunk=1000)
    spec = TableSpec("events", ("event_id",), types={
        "event_id": "bigint", "user_id": "bigint", "value": "double", "last_update": "timestamp"})
    rows = read_csv(spark, [f"{path}/first/*", f"{path}/second/*"], text_schema(columns))
    return rows.transform(clean(spec, "historical")).withColumn("last_update", time_text(F.col("last_update")))


@query("sink_roundtrip", """SELECT event_id, event_type, value, strftime(ts, '%Y-%m-%d') AS run_date FROM events""")
def sink_roundtrip(spark, root):
    """Partitioned files, written twice: the second load replaces the first."""
    events, path = table(spark, root, "events"), work_folder(spark, "events")
    dated = with_run_date(events, "ts").select("event_id", "event_type", "value", "run_date")
    for _ in range(2):
        replace_partitions(dated, path, ["run_date"])
    return spark.read.schema(dated.schema).parquet(path)


@query("replace_table", "SELECT p_partkey, p_name, p_retailprice FROM part")
def replace_table_query(spark, root):
    """A table is replaced as a whole; an empty frame leaves it as it is."""
    part, path = table(spark, root, "part").select("p_partkey", "p_name", "p_retailprice"), work_folder(spark, "part")
    replace_table(part.withColumn("p_name", F.lit("old")), path)
    replace_table(part, path)
    replace_table(part.filter(F.col("p_partkey").isNull()), path)
    return read_table(spark, path)


@query("idempotent_append", """SELECT o_orderkey, o_custkey, o_totalprice, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders""")
def idempotent_append(spark, root):
    """Two overlapping batches, the second one twice, and keys that return with another year, without one
    and twice in a batch: every key is there once, as it came first."""
    orders = table(spark, root, "orders").select("o_orderkey", "o_custkey", "o_totalprice", F.year("o_orderdate").alias("year"))
    path = work_folder(spark, "fact")
    early, late = orders.filter("year <= 1998"), orders.filter("year >= 1997")
    moved = orders.withColumn("year", F.when(F.col("o_orderkey") % 3 == 0, F.col("year") + 1))
    for batch in (early, late, late, moved.union(moved), late.union(late)):
        append_new(batch, path, ["o_orderkey"], partition_by=["year"])
    return spark.read.schema(orders.schema).parquet(path)


@query("indexed_append", """SELECT o_orderkey, o_custkey, o_totalprice, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders
UNION ALL SELECT NULL, -1, NULL, NULL""")
def indexed_append(spark, root):
    """The same through the key index: overlapping batches, keys that return with another year, keys and years that are missing."""
    orders = table(spark, root, "orders").select("o_orderkey", "o_custkey", "o_totalprice", F.year("o_orderdate").alias("year"))
    path = work_folder(spark, "fact")
    lost = orders.limit(1).select(F.lit(None).cast("bigint").alias("o_orderkey"), F.lit(-1).cast("bigint").alias("o_custkey"),
                                  F.lit(None).cast("double").alias("o_totalprice"), F.lit(None).cast("int").alias("year"))
    early, late = orders.filter("year <= 1998").union(lost), orders.filter("year >= 1997")
    moved = orders.withColumn("year", F.when(F.col("o_orderkey") % 3 == 0, F.col("year") + 1)).union(lost)
    for batch in (early, late, late, moved.union(moved)):
        append_indexed(batch, path, ["o_orderkey"], partition_by=["year"])
    return spark.read.schema(orders.schema).parquet(path)


@query("increment_runs", """SELECT CASE WHEN user_id % 2 = 0 THEN 'run-a' ELSE 'run-b' END AS run_id, '2024-01-31' AS run_date,
  count(*) AS n FROM events GROUP BY 1""")
def increment_runs(spark, root):
    """Two runs on one day stay beside each other; a repeated run replaces itself."""
    events, path = table(spark, root, "events").select("event_id", "user_id"), work_folder(spark, "increment")
    even = F.col("user_id") % 2 == 0
    for run_id, rows in (("run-a", events.filter(even)), ("run-b", events.filter(~even)), ("run-a", events.filter(even))):
        write_increment(rows, path, "2024-01-31", run_id, fmt="parquet")
    schema = "event_id bigint, user_id bigint, run_date string, run_id string"
    return spark.read.schema(schema).parquet(path).groupBy("run_id", "run_date").agg(F.count("*").alias("n"))
