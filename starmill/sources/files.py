"""CSV and Parquet sources, and the discovery of raw files."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmill import fixed
from starmill.functions.columns import is_csv, path_part
from starmill.functions.names import normalise_columns
from starmill.operators.dedup import distinct_values
from starmill.sources.records import read_chunks
from starmill.specs import SOURCE_SPECS, TableSpec

# Reads what ``sinks.files`` writes: quotes inside cells are doubled, cells may hold line breaks.
CSV_READ = {"header": "true", "quote": '"', "escape": '"'}


def read_csv(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType | str | None = None, *,
             infer: bool = False, multi_line: bool = True, recursive: bool = False) -> DataFrame:
    """One frame over one or many CSV files, directories or globs.

    Without a schema every column is text and the cleaner types it by its spec, which saves the
    extra pass of inference; ``infer`` asks for that pass. A file whose header differs from the
    schema, or from the first file, raises instead of shifting columns. ``multi_line=False`` lets
    Spark split large files, for feeds without line breaks inside cells.
    """
    reader = spark.read.options(**CSV_READ, multiLine=multi_line, enforceSchema=False,
                                inferSchema=infer and schema is None, recursiveFileLookup=recursive)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv([paths] if isinstance(paths, str) else list(paths))


def text_schema(columns: Iterable[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def union_chunks(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of all chunks, matched by column name; a column a chunk lacks is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def discover_files(spark: SparkSession, root: str, run_date: str | None = None, *, layout: str = "zone") -> DataFrame:
    """CSV files of a raw zone with table and run date, from a distributed listing.

    ``layout="zone"``: ``root/<run date>/<table>/<file>.csv``, as object stores receive it;
    ``layout="hive"``: ``root/<table>/run_date=<run date>/...``, as the extracts here write it. Files
    that do not sit that deep are left out. ``run_date`` limits the listing; contents are not read.
    """
    root = root.rstrip("/")
    start = root if run_date is None else (f"{root}/{run_date}" if layout == "zone" else f"{root}/*/run_date={run_date}")
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
             .option("pathGlobFilter", f"*{fixed.CSV_SUFFIX}").load(start).select("path", "length"))
    tail = re.sub(r"^[^:/]+:/*", "", root).strip("/") + "/"
    inner = F.substr("path", F.instr("path", tail) + len(tail))
    return file_tables(files.withColumn("inner", inner), "inner", layout=layout).drop("inner")


def file_tables(files: DataFrame, column: str = "path", *, layout: str = "zone") -> DataFrame:
    """Add ``table`` and ``run_date`` to file paths relative to the zone; drop what is no table file."""
    path = F.col(column)
    kept = files.filter(is_csv(path) & (F.size(F.split(path, "/")) >= 3))
    if layout == "hive":
        return kept.withColumn("table", path_part(path, 0)).withColumn(
            "run_date", F.regexp_extract(path, "/run_date=([^/]+)/", 1))
    return kept.withColumn("table", path_part(path, 1)).withColumn("run_date", path_part(path, 0))


def table_files(files: DataFrame) -> DataFrame:
    """Files and bytes per table; the paths themselves stay distributed."""
    return files.groupBy("table").agg(F.count("*").alias("files"), F.sum("length").alias("bytes"))


def table_names(files: DataFrame) -> list[str]:
    """Names of the tables, of which there are few, however many files they have."""
    return sorted(r[0] for r in distinct_values(files, table=F.col("table")).collect())


def table_glob(root: str, table: str, run_date: str | None = None, *, layout: str = "zone") -> str:
    """Glob over the files of a table, so no file list passes through the driver program."""
    day = run_date or "*"
    inner = f"{table}/run_date={day}" if layout == "hive" else f"{day}/{table}/*{fixed.CSV_SUFFIX}"
    return f"{root.rstrip('/')}/{inner}"


def read_registry(spark: SparkSession, root: str, run_date: str | None = None, *, layout: str = "zone",
                  tables: Sequence[str] | None = None, specs: Mapping[str, TableSpec] | None = None,
                  views: bool = False, multi_line: bool = True, mixed: bool = False) -> dict[str, DataFrame]:
    """Every table of a run date (or of all dates) as a lazy frame with normalised names.

    Several files of one table are one frame. Tables with a spec are read as text, which the cleaner
    types; the types of others are inferred. Discovery is skipped when ``tables`` names them. ``mixed``
    is for files whose headers differ within a table, and for large files with line breaks in cells:
    their lines are staged in the work folder first (``sources.records``).
    """
    known = SOURCE_SPECS if specs is None else specs
    names = tables if tables is not None else table_names(discover_files(spark, root, run_date, layout=layout))
    out = {}
    for name in names:
        paths, recursive = table_glob(root, name, run_date, layout=layout), layout == "hive"
        if mixed:
            df = read_chunks(spark, paths, infer=name not in known, recursive=recursive)
        else:
            df = read_csv(spark, paths, infer=name not in known, multi_line=multi_line, recursive=recursive)
        out[name] = normalise_columns(df)
        if views:
            out[name].createOrReplaceTempView(name)
    return out


def read_parquet_registry(spark: SparkSession, root: str, tables: Sequence[str],
                          run_date: str | None = None) -> dict[str, DataFrame]:
    """Cleaned tables; with a run date only that partition of each is read."""
    out = {t: spark.read.parquet(f"{root.rstrip('/')}/{t}") for t in tables}
    if run_date is None:
        return out
    return {t: df.filter(F.col("run_date") == run_date).drop("run_date") for t, df in out.items()}
