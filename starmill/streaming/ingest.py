"""Raw files as streams: each file is taken once, tracked by the checkpoint."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmill.functions.columns import path_part, valid_day
from starmill.operators.clean import clean
from starmill.sinks.files import replace_partitions
from starmill.sources.files import CSV_READ, table_glob
from starmill.specs import TableSpec

BATCH = "batch_id"


def csv_stream(spark: SparkSession, root: str, table: str, schema: T.StructType | str, *,
               max_files: int | None = None, multi_line: bool = True) -> DataFrame:
    """Stream over the raw files ``root/<run date>/<table>/<file>.csv``, with run date and file from
    the path.

    A folder that is no date gives a NULL run date, which the sinks keep in its own partition.
    """
    reader = spark.readStream.schema(schema).options(**CSV_READ, multiLine=multi_line)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    path = F.col("_metadata.file_path")
    return reader.csv(table_glob(root, table)).select(
        "*", F.lit(table).alias("table"), valid_day(path_part(path, -3)).alias("run_date"), path.alias("file"))


def parquet_stream(spark: SparkSession, path: str, schema: T.StructType | str, *,
                   max_files: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def run_available(stream: DataFrame, checkpoint: str, on_batch: Callable[[DataFrame, int], int],
                  output_mode: str = "append") -> int:
    """Process everything that is there now, then stop; returns the sum of what ``on_batch`` returned,
    usually the rows it wrote.

    A batch that is repeated after a failure has the same id and the same rows, so ``on_batch`` must
    replace what that id wrote before.
    """
    done: dict[int, int] = {}

    def batch(df: DataFrame, batch_id: int) -> None:
        done[batch_id] = on_batch(df, batch_id)

    query = (stream.writeStream.foreachBatch(batch).outputMode(output_mode)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()
    return sum(done.values())


def batch_writer(target: str, partition_by: Sequence[str] = (), change: Callable[[DataFrame], DataFrame] | None = None,
                 ) -> Callable[..., int]:
    """Write each batch into partitions of its own, so repeating it replaces exactly its rows. ``constant`` holds partition
    columns known to have one value in the whole batch: its rows are neither gathered nor sorted by them."""
    def write(df: DataFrame, batch_id: int, constant: Mapping[str, object] | None = None) -> int:
        out = df.transform(change) if change else df
        return replace_partitions(out, target, [*partition_by, BATCH], constant={**(constant or {}), BATCH: batch_id})

    return write


def ingest(stream: DataFrame, target: str, checkpoint: str, partition_by: Sequence[str] = ("run_date",)) -> int:
    """Append new rows to ``target``, exactly once."""
    return run_available(stream, checkpoint, batch_writer(target, partition_by))


def clean_on_arrival(stream: DataFrame, spec: TableSpec, target: str, checkpoint: str, *,
                     profile: str = "incremental", **options) -> int:
    """Clean the files that arrived since the last call and write them by run date."""
    cleaner = clean(spec, profile, carry=("run_date",), **options)

    def change(df: DataFrame) -> DataFrame:
        extra = [c for c in ("table", "file") if c in df.columns]
        return cleaner(df.drop(*extra))

    return run_available(stream, checkpoint, batch_writer(target, ("run_date",), change))
