"""Streaming queries: the events table as a file stream, taken until nothing is left."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmill.functions.columns import time_text
from starmill.queries.base import query, table
from starmill.queries.loads import EVENT_OUT, events_out
from starmill.session import work_folder
from starmill.sinks.files import write_files
from starmill.specs import TableSpec
from starmill.streaming import daily, ingest, keyed
from starmill.streaming.contents import ingest_contents


def event_stream(spark: SparkSession, root: str) -> DataFrame:
    """The pattern matches a single file as well as a folder of files."""
    schema = table(spark, root, "events").schema
    return ingest.parquet_stream(spark, f"{root}/event[s].parquet", schema).withColumn("ts", F.col("ts").cast("timestamp"))


def doubled(stream: DataFrame) -> DataFrame:
    """A third of the rows twice, the second copy one second later."""
    copies = F.when(F.col("event_id") % 3 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return stream.withColumn("copy", F.explode(copies)).withColumn(
        "seen_at", F.col("ts") + F.make_interval(secs=F.col("copy")))


@query("stream_ingest", f"SELECT {EVENT_OUT}, strftime(ts, '%Y-%m-%d') AS run_date FROM events")
def stream_ingest(spark, root):
    """Taken once: the second call finds nothing new."""
    path = work_folder(spark, "ingest")
    for _ in range(2):
        stream = event_stream(spark, root).withColumn("run_date", F.date_format("ts", "yyyy-MM-dd"))
        ingest.ingest(stream, f"{path}/table", f"{path}/checkpoint")
    rows = spark.read.option("recursiveFileLookup", "false").parquet(f"{path}/table")
    return rows.select("event_id", time_text(F.col("ts")).alias("ts"), "user_id", "event_type", "value",
                       F.col("run_date").cast("string").alias("run_date"))


@query("stream_clean", """SELECT event_id, upper(event_type) AS event_type, CASE WHEN event_id % 6 = 0 THEN 0 ELSE value END AS value,
  strftime(ts, '%Y-%m-%d') AS run_date FROM events""")
def stream_clean(spark, root):
    """Cleaned batch by batch while it arrives."""
    path = work_folder(spark, "clean")
    spec = TableSpec("events", ("event_id",), rules=(lambda df: df.withColumn("event_type", F.upper("event_type")),))
    stream = doubled(event_stream(spark, root)).select(
        "event_id", F.concat(F.lit("  "), "event_type").alias("Event Type"),
        F.when(F.col("event_id") % 6 != 0, F.col("value")).alias("value"),
        F.date_format("ts", "yyyy-MM-dd").alias("run_date"))
    ingest.clean_on_arrival(stream, spec, f"{path}/table", f"{path}/checkpoint")
    return spark.read.parquet(f"{path}/table").select(
        "event_id", "event_type", "value", F.col("run_date").cast("string").alias("run_date"))


@query("stream_dedup", f"SELECT {EVENT_OUT}, CAST(CASE WHEN event_id % 3 = 0 THEN 1 ELSE 0 END AS INTEGER) AS copy FROM events")
def stream_dedup(spark, root):
    """Newest row per key over all batches; no row is too late."""
    path = work_folder(spark, "latest")
    keyed.collect_latest(doubled(event_stream(spark, root)), ["event_id"], ["seen_at"], f"{path}/table", f"{path}/checkpoint")
    rows = keyed.latest(spark, f"{path}/table", ["event_id"], ["seen_at"])
    return events_out(rows, "copy")


@query("stream_first_wins", "SELECT event_id, user_id, event_type FROM events")
def stream_first_wins(spark, root):
    """The stateful form: first row per key within the watermark."""
    path = work_folder(spark, "first")
    stream = keyed.first_wins(doubled(event_stream(spark, root)), ["event_id"], "seen_at")
    ingest.run_available(stream, f"{path}/checkpoint", ingest.batch_writer(f"{path}/table"))
    return spark.read.parquet(f"{path}/table").select("event_id", "user_id", "event_type")


@query("stream_daily", """SELECT strftime(CAST(ts AS DATE), '%Y-%m-%d') AS day, event_type, count(*) AS n,
  CAST(sum(CAST(value AS DECIMAL(12,2))) AS DOUBLE) AS total FROM events GROUP BY 1, 2""")
def stream_daily(spark, root):
    """Daily totals from the partial totals of each batch: all days, late rows included."""
    path = work_folder(spark, "daily")
    stream = event_stream(spark, root).withColumn("value", F.col("value").cast("decimal(12,2)"))
    daily.collect_daily(stream, "ts", "value", ["event_type"], f"{path}/table", f"{path}/checkpoint")
    totals = daily.daily_totals(spark, f"{path}/table", ["event_type"])
    return totals.select(time_text(F.col("day"), "yyyy-MM-dd").alias("day"), "event_type", "n",
                         F.col("total").cast("double").alias("total"))


@query("stream_windows", """SELECT strftime(CAST(ts AS DATE), '%Y-%m-%d') AS day, event_type, count(*) AS n FROM events GROUP BY ALL""")
def stream_windows(spark, root):
    """The stateful form: every day, also those that the watermark has not closed."""
    path = work_folder(spark, "windows")
    daily.collect_windows(event_stream(spark, root), "ts", {"n": F.count("*")}, ["event_type"], f"{path}/table", f"{path}/checkpoint")
    days = daily.window_totals(spark, f"{path}/table", ["event_type"])
    return days.select(time_text(F.col("day"), "yyyy-MM-dd").alias("day"), "event_type", "n")


@query("stream_contents", "SELECT event_id::VARCHAR AS event_id, user_id::VARCHAR AS user_id, event_type FROM events")
def stream_contents(spark, root):
    """Every file is delivered twice, the second time under another name and on another day: its rows come once."""
    path = work_folder(spark, "contents")
    events = table(spark, root, "events").select("event_id", "user_id", "event_type")
    for day in ("2024-01-01", "2024-01-02"):
        write_files(events, f"{path}/raw/{day}/events", fmt="csv")
        for _ in range(2):
            stream = ingest.csv_stream(spark, f"{path}/raw", "events", "event_id string, user_id string, event_type string")
            ingest_contents(stream, f"{path}/table", f"{path}/checkpoint", f"{path}/ledger")
    return spark.read.parquet(f"{path}/table").select("event_id", "user_id", "event_type")
