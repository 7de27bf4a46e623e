"""Key dedup over a stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from starmill.operators.dedup import latest_per_key
from starmill.streaming.ingest import BATCH, batch_writer, run_available


def first_wins(stream: DataFrame, keys: Sequence[str], time: str, delay: str = "1 day") -> DataFrame:
    """The first row of a key; the state forgets a key ``delay`` after its time, so a copy that comes
    later than that passes, and a row behind the watermark is taken as such a copy. All copies of a key
    meet in one task of the state store; where one key may have a large share of the rows, use
    ``collect_latest``, which reduces copies before they are shuffled."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(list(keys))


def collect_latest(stream: DataFrame, keys: Sequence[str], order_by: Sequence[str], target: str,
                   checkpoint: str) -> int:
    """Keep the newest row per key of each batch; ``latest`` settles keys between batches.

    No state is held, so no row is ever too late.
    """
    return run_available(stream, checkpoint, batch_writer(
        target, change=lambda df: latest_per_key(df, keys, order_by)))


def latest(spark: SparkSession, target: str, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """Current rows: newest by ``order_by``, of equal ones the one that came last."""
    return latest_per_key(spark.read.parquet(target), keys, [*order_by, BATCH]).drop(BATCH)
