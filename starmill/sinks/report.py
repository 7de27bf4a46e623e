"""Outcome per table: go on after a failure, report all, fail at the end."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import astuple, dataclass

from pyspark.sql import DataFrame, SparkSession

REPORT_SCHEMA = "table string, status string, rows bigint, error string, seconds double"
log = logging.getLogger("starmill")


@dataclass(frozen=True)
class Outcome:
    """``status`` is written, empty, skipped or failed; only failed makes the run fail."""

    table: str
    status: str
    rows: int = 0
    error: str | None = None
    seconds: float = 0.0


def attempt(table: str, load: Callable[[], int]) -> Outcome:
    start = time.monotonic()
    try:
        rows = load()
    except Exception as error:  # noqa: BLE001  (one bad table must not stop the others)
        log.exception("table %s failed", table)
        return Outcome(table, "failed", 0, str(error), time.monotonic() - start)
    return Outcome(table, "written" if rows else "empty", rows, None, time.monotonic() - start)


def run_tables(loads: Mapping[str, Callable[[], int]], workers: int = 4) -> list[Outcome]:
    """Run the load of every table; tables overlap, so small ones do not leave the cluster idle."""
    with ThreadPoolExecutor(max_workers=max(1, workers)) as pool:
        return list(pool.map(lambda item: attempt(*item), loads.items()))


def report(spark: SparkSession, outcomes: list[Outcome]) -> DataFrame:
    return spark.createDataFrame([astuple(o) for o in outcomes], REPORT_SCHEMA)


class LoadFailed(RuntimeError):
    def __init__(self, outcomes: list[Outcome]):
        self.outcomes = outcomes
        super().__init__("failed tables: " + ", ".join(sorted(o.table for o in outcomes if o.status == "failed")))


def finish(outcomes: list[Outcome]) -> list[Outcome]:
    """Raise if any table failed, after all were tried."""
    if any(o.status == "failed" for o in outcomes):
        raise LoadFailed(outcomes)
    return outcomes
