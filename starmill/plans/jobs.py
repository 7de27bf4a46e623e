"""Runs over the raw zone: clean, load a warehouse, build and load the star."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from starmill import fixed
from starmill.operators.clean import clean
from starmill.operators.refresh import refresh
from starmill.operators.star import BUILDERS, SHAPES, build_star, buildable, clean_registry
from starmill.sinks.files import read_table, replace_partitions, replace_table
from starmill.sinks.keyindex import append_indexed
from starmill.sinks.report import Outcome, finish, log, run_tables
from starmill.sources.files import read_registry
from starmill.specs import STAR_SPECS, TableSpec, spec_for

Sink = Callable[[DataFrame, TableSpec], int]


def clean_tables(tables: Mapping[str, DataFrame], sink: Sink, profile: str,
                 specs: Mapping[str, TableSpec] | None = None, workers: int = 4, **options) -> list[Outcome]:
    """Clean each table and hand it to the sink. Rows in and out are counted in the same job; rows in
    are for the log only, as a repeated map task counts again."""
    def load(name: str, df: DataFrame) -> Callable[[], int]:
        spec = spec_for(df, name, specs)

        def run() -> int:
            rows_in = Observation()
            counted = df.observe(rows_in, F.count(F.lit(1)).alias("n"))
            rows_out = sink(counted.transform(clean(spec, profile, **options)), spec)
            log.info("table %s: %s rows in, %s out", name, rows_in.get["n"], rows_out)
            return rows_out

        return run

    return finish(run_tables({name: load(name, df) for name, df in tables.items()}, workers))


def clean_day(spark: SparkSession, raw: str, target: str, run_date: str, *, layout: str = "zone", multi_line: bool = True,
              mixed: bool = False, fmt: str = "parquet", specs: Mapping[str, TableSpec] | None = None, workers: int = 4,
              **options) -> list[Outcome]:
    """Clean the raw files of one run date; running it again replaces that date only."""
    tables = read_registry(spark, raw, run_date, layout=layout, specs=specs, multi_line=multi_line, mixed=mixed)

    def sink(df: DataFrame, spec: TableSpec) -> int:
        return replace_partitions(df, f"{target}/{spec.name}", ["run_date"], constant={"run_date": run_date}, fmt=fmt)

    return clean_tables(tables, sink, "incremental", specs, workers, **options)


def clean_history(spark: SparkSession, raw: str, target: str, *, layout: str = "zone", multi_line: bool = True,
                  mixed: bool = True, fmt: str = "parquet", specs: Mapping[str, TableSpec] | None = None, workers: int = 4,
                  **options) -> list[Outcome]:
    """Clean all chunks of all dates as one table each, one row per key; chunks of a history may have other headers."""
    tables = read_registry(spark, raw, layout=layout, specs=specs, multi_line=multi_line, mixed=mixed)

    def sink(df: DataFrame, spec: TableSpec) -> int:
        return replace_table(df, f"{target}/{spec.name}", fmt=fmt)

    return clean_tables(tables, sink, "historical", specs, workers, **options)


def load_day(spark: SparkSession, raw: str, run_date: str, sink: Sink, *, layout: str = "zone",
             multi_line: bool = True, mixed: bool = False, specs: Mapping[str, TableSpec] | None = None, workers: int = 4,
             **options) -> list[Outcome]:
    """Clean the raw files of one run date and append them to a warehouse through ``sink``."""
    tables = read_registry(spark, raw, run_date, layout=layout, specs=specs, multi_line=multi_line, mixed=mixed)
    return clean_tables(tables, sink, "warehouse", specs, workers, **options)


def file_warehouse(target: str, run_date: str) -> Sink:
    """Warehouse on files: each load is a partition beside the earlier ones, and loading a date again
    replaces its partition, so no load has to read what is there already."""
    def sink(df: DataFrame, spec: TableSpec) -> int:
        return replace_partitions(df, f"{target}/{spec.name}", ["run_date"], constant={"run_date": run_date})

    return sink


def star_sink(target: str, partition_by: Sequence[str] = ("date_id",), *, unique: bool = False) -> Sink:
    """Star on files: dimensions are replaced, facts get the keys that are new. ``unique`` states that facts come with one row per
    key, as those of ``load_star`` do. Facts lie by day, or as told; a key
    that returns with another day, or without one, is known all the same, and only days that may hold
    a key are read (``sinks.keyindex``)."""
    def sink(df: DataFrame, spec: TableSpec, asked: DataFrame | None = None) -> int:
        path = f"{target}/{spec.name}"
        if spec.mode == "overwrite":
            return replace_table(df, path)
        return append_indexed(df, path, spec.keys, partition_by=list(partition_by), unique=unique, asked=asked)

    sink.asks_keys = True
    return sink


def load_star(tables: Mapping[str, DataFrame], sink: Sink, *, workers: int = 4, **options) -> list[Outcome]:
    """Build what the sources allow and load it; tables whose sources are missing are skipped."""
    missing = {name: need for name, need in buildable(tables).items() if need}
    sources = clean_registry({t: df for t, df in tables.items() if any(t in fixed.STAR_SOURCES[n] for n in fixed.STAR_SOURCES if n not in missing)},
                             **options)
    star = build_star(sources, cleaned=True)
    # a sink that asks for the keys of a fact first gets them from its base: no row is built for them
    keys = {n: {"asked": SHAPES[n](sources).keys()} for n in star if STAR_SPECS[n].mode != "overwrite" and getattr(sink, "asks_keys", False)}
    loads = {name: (lambda df=df, name=name: sink(df, STAR_SPECS[name], **keys.get(name, {}))) for name, df in star.items()}
    skipped = [Outcome(name, "skipped", 0, "missing sources: " + ", ".join(need)) for name, need in missing.items()]
    return finish([*run_tables(loads, workers), *skipped])


def refresh_dimensions(tables: Mapping[str, DataFrame], changes: Mapping[str, DataFrame], target: str, *, workers: int = 4,
                       **options) -> list[Outcome]:
    """Bring the dimensions of a star on files up to date by the changed rows of their sources, in old and new form.

    ``tables`` are the sources as they are now. A dimension that no change can reach by its sources is not touched; one that was
    never built is built. Facts are appended by key (``star_sink``).
    """
    sources = clean_registry(tables, **options)
    changed = clean_registry({t: df for t, df in changes.items() if t in tables}, **options)

    def load(name: str, need: list[str]) -> Callable[[], int]:
        own = {t: sources[t] for t in need}

        def run() -> int:
            path = f"{target}/{name}"
            old = read_table(next(iter(own.values())).sparkSession, path)
            return replace_table(BUILDERS[name](own) if old is None else refresh(name, old, own, changed), path)

        return run

    wanted = {n: fixed.STAR_SOURCES[n] for n, missing in buildable(tables).items() if not missing and STAR_SPECS[n].mode == "overwrite"}
    untouched = [n for n, need in wanted.items() if not set(need) & set(changed)]
    loads = {n: load(n, need) for n, need in wanted.items() if n not in untouched}
    return finish([*run_tables(loads, workers), *[Outcome(n, "skipped", 0, "no change reaches it") for n in untouched]])


def star_day(spark: SparkSession, raw: str, sink: Sink, run_date: str | None, *, layout: str = "zone",
             multi_line: bool = True, mixed: bool = False, **options) -> list[Outcome]:
    """Star of the raw files of one run date, or of all."""
    tables = read_registry(spark, raw, run_date, layout=layout, multi_line=multi_line, mixed=mixed)
    return load_star(tables, sink, **options)
