"""Trigger events as a table: class, run date and files of each event in a JSON log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmill import fixed
from starmill.functions.columns import path_part, valid_day

EVENT_SCHEMA = (
    "Records array<struct<eventSource: string, s3: struct<object: struct<key: string>>>>, "
    "source string, `detail-type` string, trigger_type string, run_date string"
)


def trigger_class(event: Column) -> Column:
    """s3, schedule, historical, direct or unknown. A direct event names its own class, of which only
    the known ones are accepted."""
    first_source = F.try_element_at(event["Records"], F.lit(1))["eventSource"]
    scheduled = event["source"] == fixed.SCHEDULE_SOURCE
    historical = F.lower(F.coalesce(event["detail-type"], F.lit(""))).contains(fixed.TRIGGER_HISTORICAL)
    named = event["trigger_type"].isin(fixed.TRIGGER_DIRECT, fixed.TRIGGER_HISTORICAL,
                                       fixed.TRIGGER_FILE, fixed.TRIGGER_SCHEDULE)
    return (F.when(first_source == fixed.FILE_EVENT_SOURCE, fixed.TRIGGER_FILE)
            .when(scheduled & historical, fixed.TRIGGER_HISTORICAL)
            .when(scheduled, fixed.TRIGGER_SCHEDULE)
            .when(named, event["trigger_type"])
            .otherwise(fixed.TRIGGER_UNKNOWN))


def read_events(log: DataFrame, column: str = "event", today: Column | None = None) -> DataFrame:
    """One row per event record: trigger, object key, table and run date.

    All records of an event are kept. The run date is the explicit one, else the date folder of the
    object key, else ``today`` (UTC day of the session); a text that is no day gives NULL and leaves
    ``bad_date`` true.
    """
    event = F.from_json(F.col(column), EVENT_SCHEMA)
    rows = log.withColumn("__event", event).withColumn("trigger", trigger_class(F.col("__event")))
    is_file = F.col("trigger") == fixed.TRIGGER_FILE
    records = F.when(is_file, F.col("__event.Records"))
    rows = rows.select("*", F.explode_outer(records).alias("__record"))
    key = F.col("__record.s3.object.key")
    # Object key: zone / run date / table / file.
    stated = F.coalesce(F.col("__event.run_date"), F.when(is_file, path_part(key, 1)))
    fallback = F.date_format(F.current_date() if today is None else today, fixed.DAY_PATTERN)
    return rows.select(
        *log.columns, "trigger", key.alias("object_key"),
        F.when(is_file, path_part(key, 2)).alias("table"),
        F.when(stated.isNull(), fallback).otherwise(valid_day(stated)).alias("run_date"),
        F.coalesce(stated.isNotNull() & valid_day(stated).isNull(), F.lit(False)).alias("bad_date"),
    )


def trigger_counts(events: DataFrame) -> DataFrame:
    return events.groupBy("trigger", "run_date").agg(F.count("*").alias("n"))
