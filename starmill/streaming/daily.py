"""Daily totals of a stream."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starmill.operators.dedup import latest_per_key
from starmill.streaming.ingest import BATCH, batch_writer, run_available

_MOVED = "__local_time"


def daily_windows(stream: DataFrame, time: str, measures: Mapping[str, Column], by: Sequence[str] = (),
                  delay: str = "1 day") -> DataFrame:
    """Tumbling windows of one day of the session's time zone; a day comes out once, when the
    watermark has passed its end. Rows that are later than ``delay`` miss their day; use the partial
    totals where they must not."""
    # Windows are cut at UTC midnight, so the time is moved by the zone's offset first.
    zone = stream.sparkSession.conf.get("spark.sql.session.timeZone")
    moved = stream.withColumn(_MOVED, F.from_utc_timestamp(time, zone)).withWatermark(_MOVED, delay)
    days = moved.groupBy(F.window(_MOVED, "1 day"), *by).agg(*[c.alias(n) for n, c in measures.items()])
    number = (F.unix_seconds("window.start") / 86400).cast("int")
    return days.select(F.date_from_unix_date(number).alias("day"), *by, *measures)


def collect_windows(stream: DataFrame, time: str, measures: Mapping[str, Column], by: Sequence[str], target: str, checkpoint: str,
                    delay: str = "1 day") -> int:
    """The same windows, kept open: each batch writes the days it changed as they are by then, so days that the watermark has not
    closed are there as well. The state holds open days only; ``window_totals`` takes the newest line of each day."""
    return run_available(daily_windows(stream, time, measures, by, delay), checkpoint, batch_writer(target), "update")


def window_totals(spark: SparkSession, target: str, by: Sequence[str] = ()) -> DataFrame:
    """Every day once, as its last batch left it."""
    return latest_per_key(spark.read.parquet(target), ["day", *by], [BATCH]).drop(BATCH)


def collect_daily(stream: DataFrame, time: str, value: str, by: Sequence[str], target: str, checkpoint: str) -> int:
    """Partial totals of each batch by day; late rows of any age just add to their day."""
    def partial(df: DataFrame) -> DataFrame:
        return df.groupBy(F.to_date(time).alias("day"), *by).agg(
            F.count("*").alias("n"), F.sum(value).alias("total"))

    return run_available(stream, checkpoint, batch_writer(target, change=partial))


def daily_totals(spark: SparkSession, target: str, by: Sequence[str] = ()) -> DataFrame:
    partials = spark.read.parquet(target).drop(BATCH)
    return partials.groupBy("day", *by).agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
