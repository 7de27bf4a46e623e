"""Extract runs: everything once, then day by day."""

from __future__ import annotations

import time
import uuid
from collections.abc import Mapping
from functools import reduce
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmill import fixed
from starmill.operators import increment as inc
from starmill.operators.intervals import gaps, in_gaps, islands, merged
from starmill.sinks.files import read_table, write_chunks, write_files, write_increment
from starmill.sinks.report import Outcome, attempt, finish
from starmill.sources.files import CSV_READ


INTERVAL_SCHEMA = "table string, run bigint, low bigint, high bigint"


class Source(Protocol):
    spark: SparkSession

    def catalog(self) -> DataFrame: ...
    def read(self, table: str) -> DataFrame: ...
    def key_range(self, table: str, key: str) -> DataFrame: ...
    def day_counts(self, table: str, column: str) -> DataFrame: ...
    def read_by_key(self, table: str, key: str, rows: int, min_id: int | None, max_id: int) -> DataFrame: ...
    def read_by_day(self, table: str, column: str, days: Mapping[str | None, int],
                    key: str | None = None) -> DataFrame: ...


class Journal:
    """Marks and progress as append-only tables, so an entry is complete or absent, and no entry is
    lost when a later table fails."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _log(self, name: str, schema: str) -> DataFrame:
        log = read_table(self.spark, f"{self.path}/{name}", schema)
        return self.spark.createDataFrame([], schema) if log is None else log

    def state(self) -> DataFrame:
        return inc.current_state(self._log("state", inc.STATE_SCHEMA))

    def ledger(self) -> DataFrame:
        return inc.current_ledger(self._log("ledger", inc.LEDGER_SCHEMA))

    def days(self) -> DataFrame:
        return self._log("days", "table string, day string")

    def intervals(self, table: str, settle_runs: int | None = None) -> tuple[DataFrame, int | None]:
        """Loaded keys of a table as merged intervals, and the key up to which no more rows are waited for.

        Without ``settle_runs`` every gap stays open. With it, gaps below the largest key that was loaded that many runs
        ago are closed: what was assigned so long ago is committed or never will be.
        """
        log = self._log("intervals", INTERVAL_SCHEMA).filter(F.col("table") == table)
        settled = None
        if settle_runs is not None:
            newest = log.agg(F.max("run")).first()[0]
            settled = None if newest is None else log.filter(F.col("run") <= newest - settle_runs + 1).agg(F.max("high")).first()[0]
        return merged(log.select("low", "high")), settled

    def save_intervals(self, table: str, intervals: DataFrame) -> None:
        last = self._log("intervals", INTERVAL_SCHEMA).filter(F.col("table") == table).agg(F.max("run")).first()[0]
        rows = intervals.select(F.lit(table).alias("table"), F.lit((last or 0) + 1).cast("bigint").alias("run"), "low", "high")
        write_files(rows, f"{self.path}/intervals")

    def save_state(self, marks: DataFrame) -> None:
        write_files(marks.coalesce(1), f"{self.path}/state")

    def save_bootstrap(self) -> None:
        """Marks exist, also where no table has a key to mark."""
        self.save_state(self.spark.createDataFrame([("*", 0, True)], inc.STATE_SCHEMA))

    def save_day(self, table: str, day: str) -> None:
        write_files(self.spark.createDataFrame([(table, day)], "table string, day string").coalesce(1),
                    f"{self.path}/days")

    def save_progress(self, outcome: Outcome, max_pk: int | None) -> None:
        status = "error" if outcome.status == "failed" else "done"
        row = (outcome.table, status, outcome.rows, max_pk, outcome.error, outcome.seconds)
        entry = self.spark.createDataFrame([row], inc.LEDGER_SCHEMA.removesuffix(", saved_at timestamp"))
        write_files(entry.withColumn("saved_at", F.current_timestamp()).coalesce(1), f"{self.path}/ledger")


def extract_history(source: Source, target: str, journal: Journal, *, fmt: str = "csv",
                    chunk: int = fixed.CHUNK_ROWS, late_keys: bool = False) -> list[Outcome]:
    """Write every table once, by day, by key or in full; a table already done is not read again.

    A keyed table is read up to the largest key it had at the start. That key is its mark, saved
    right after the write, from which the increments go on: rows that arrive meanwhile come next time.
    The mark of a table with a change column is the last day that it had; increments read that day again.
    ``late_keys`` also saves which keys were written, for increments that look for late ones.
    """
    plan = inc.plan_extract(source.catalog())
    if not any(r["strategy"] == "key" for r in plan.collect()):
        journal.save_bootstrap()
    todo = inc.work_list(plan, journal.ledger()).orderBy("table").collect()
    outcomes = []
    for row in todo:
        table, strategy, mark, day = row["table"], row["strategy"], None, None
        try:
            rows, mark, day = _scan(source, table, row["keys"], strategy)
        except Exception as error:  # noqa: BLE001  (reported per table, raised at the end)
            outcome = Outcome(table, "failed", 0, str(error))
        else:
            column = fixed.CHANGE_COLUMN if strategy == "date" else None
            outcome = attempt(table, lambda: write_chunks(
                rows, f"{target.rstrip('/')}/{table}", column, fmt=fmt, chunk=chunk))
        if late_keys and strategy == "key" and outcome.status == "written":
            journal.save_intervals(table, islands(_written(source.spark, f"{target.rstrip('/')}/{table}", fmt), row["keys"][0]))
        if mark is not None and outcome.status != "failed":
            journal.save_state(source.spark.createDataFrame([(table, mark, True)], inc.STATE_SCHEMA))
        if day is not None and outcome.status != "failed":
            journal.save_day(table, day)
        journal.save_progress(outcome, mark)
        outcomes.append(outcome)
    return finish(outcomes)


def _scan(source: Source, table: str, keys: list[str], strategy: str) -> tuple[DataFrame, int | None, str | None]:
    """The rows to extract, and the mark they reach: a key or a day."""
    if strategy == "date":
        days = source.day_counts(table, fixed.CHANGE_COLUMN).collect()
        counts = {str(r["day"]) if r["day"] else None: r["rows"] for r in days}
        last = max((day for day in counts if day), default=None)
        return source.read_by_day(table, fixed.CHANGE_COLUMN, counts, _number_key(source.read(table), keys)), None, last
    if strategy == "key":
        rows, low, top = source.key_range(table, keys[0]).first()
        return source.read_by_key(table, keys[0], rows, low, top).filter(F.col(keys[0]) <= F.lit(top)), top, None
    return source.read(table), None, None


def _number_key(df: DataFrame, keys: list[str]) -> str | None:
    """The key, if its numbers can cut a heavy day into parts."""
    return next((k for k in keys[:1] if isinstance(df.schema[k].dataType, T.IntegralType)), None)


def history_manifest(source: Source, chunk: int = fixed.CHUNK_ROWS) -> DataFrame:
    """Dry run of ``extract_history``: rows and files per table and run date; nothing is written."""
    plan = inc.plan_extract(source.catalog()).collect()
    parts = [inc.load_manifest(source.read(r["table"]), r["table"],
                               fixed.CHANGE_COLUMN if r["strategy"] == "date" else None, chunk) for r in plan]
    return reduce(DataFrame.unionByName, parts)


def extract_increment(source: Source, target: str, journal: Journal, run_date: str, *, fmt: str = "csv",
                      from_zero: bool = False, run_id: str | None = None, late_keys: bool = False,
                      settle_runs: int | None = None) -> list[Outcome]:
    """Write what is new since the last run.

    The first run only seeds the marks, unless ``from_zero``. Tables with a change column give the days
    from the last one that was loaded, which is read again for its late rows, through ``run_date``, and
    all days if none was loaded; repeats go when the table is cleaned by key. Rows without a change time
    come with the history only. Tables with one key column give the keys
    above their mark, which moves after a good write. A key of several columns has no mark that all
    new rows lie above, so such tables come in full and are reduced by key when cleaned. Tables with
    neither are skipped.

    A transaction may commit a lower key after a higher one was read, which a mark never gives. With ``late_keys`` the loaded
    keys are kept as intervals and all gaps between them are read too, those of the last ``settle_runs`` runs or, without,
    all.
    """
    plan = inc.plan_extract(source.catalog()).collect()
    keyed = {r["table"]: r["keys"][0] for r in plan if r["strategy"] == "key"}
    state = {r["table"]: r for r in journal.state().collect()}
    if not from_zero and not any(r["bootstrapped"] for r in state.values()):
        if keyed:
            journal.save_state(inc.bootstrap_state({t: (source.read(t), k) for t, k in keyed.items()}))
            for t, k in keyed.items() if late_keys else ():
                journal.save_intervals(t, islands(source.read(t), k))
        else:
            journal.save_bootstrap()
        for r in plan:
            if r["strategy"] == "date":
                journal.save_day(r["table"], run_date)
        return [Outcome(r["table"], "skipped", 0, "marks seeded") for r in plan]

    last_day = {r[0]: r[1] for r in journal.days().groupBy("table").agg(F.max("day")).collect()}
    run_id = run_id or f"{int(time.time())}-{uuid.uuid4().hex[:8]}"
    outcomes = []
    for row in plan:
        table, path = row["table"], f"{target.rstrip('/')}/{row['table']}"
        if not row["in_increment"]:
            outcomes.append(Outcome(table, "skipped", 0, "no key and no change column"))
        elif row["strategy"] == "full":
            outcomes.append(attempt(table, lambda: write_increment(source.read(table), path, run_date, run_id, fmt=fmt)))
        elif row["strategy"] == "date":
            new = _changed(source.read(table), last_day.get(table), run_date)
            outcome = attempt(table, lambda: write_increment(new, path, run_date, run_id, fmt=fmt))
            if outcome.status != "failed":
                journal.save_day(table, run_date)
            outcomes.append(outcome)
        elif late_keys:
            outcomes.append(_load_gaps(source, table, keyed[table], path, run_date, run_id, fmt, journal, settle_runs))
        else:
            last_id = state[table]["last_id"] if table in state else 0
            outcomes.append(_load_keys(source, table, keyed[table], last_id, path, run_date, run_id, fmt, journal))
    return finish(outcomes)


def _load_keys(source: Source, table: str, key: str, last_id: int, path: str, run_date: str, run_id: str,
               fmt: str, journal: Journal) -> Outcome:
    # The upper bound is fixed before the write, so the mark never passes a row that was not written.
    rows, low, top = source.key_range(table, key).first()
    new = inc.key_increment(source.read_by_key(table, key, rows, max(last_id, low or 0), top), key, last_id).filter(F.col(key) <= F.lit(top))
    outcome = attempt(table, lambda: write_increment(new, path, run_date, run_id, fmt=fmt))
    if outcome.status == "written":
        journal.save_state(source.spark.createDataFrame([(table, top, True)], inc.STATE_SCHEMA))
    return outcome


def _load_gaps(source: Source, table: str, key: str, path: str, run_date: str, run_id: str, fmt: str, journal: Journal,
               settle_runs: int | None) -> Outcome:
    """Rows in the gaps of the loaded keys. Which keys they brought is read from the files, not from the source again."""
    _, low, top = source.key_range(table, key).first()
    loaded, settled = journal.intervals(table, settle_runs)
    low = top + 1 if low is None else low if settled is None else max(low, settled + 1)
    new = in_gaps(source.read(table), key, gaps(loaded, low, top))
    outcome = attempt(table, lambda: write_increment(new, path, run_date, run_id, fmt=fmt))
    if outcome.status == "written":
        written = _written(source.spark, f"{path}/run_date={run_date}/run_id={run_id}", fmt)
        journal.save_intervals(table, islands(written, key))
        journal.save_state(source.spark.createDataFrame([(table, top, True)], inc.STATE_SCHEMA))
    return outcome


def _written(spark: SparkSession, path: str, fmt: str) -> DataFrame:
    reader = spark.read.option("recursiveFileLookup", "true")
    return reader.options(**CSV_READ, multiLine=True).csv(path) if fmt == "csv" else reader.format(fmt).load(path)


def _changed(df: DataFrame, last: str | None, run_date: str) -> DataFrame:
    """Rows of the last loaded day through the run date, or of all days through it."""
    if last is None:
        return df.filter(F.col(fixed.CHANGE_COLUMN) < F.lit(run_date).cast("date") + F.expr("INTERVAL 1 DAY"))
    return inc.day_window(df, fixed.CHANGE_COLUMN, min(last, run_date), run_date)
