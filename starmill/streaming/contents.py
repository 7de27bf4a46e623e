"""Files told by what they hold: a digest of the lines of each file, and the ledger of digests that were loaded."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmill.sinks.files import read_table, replace_partitions
from starmill.streaming.ingest import BATCH, batch_writer, run_available

ROW_BITS = 33   # fixed value: monotonically_increasing_id holds the partition above that many bits
HASH_BITS = 48  # so that sums over any file fit a decimal
LEDGER = f"digest string, file string, {BATCH} bigint"


def file_digests(spark: SparkSession, paths: str | Sequence[str], *, recursive: bool = False) -> DataFrame:
    """file, lines, digest: equal for files with equal lines in equal order, whatever they are called and however they are split.

    Each split of a file gives its number of lines and the sums of their hashes and of their hashes times their place in the
    split; with the lines of the splits before, these make the sums for the whole file. Lines are not shuffled, and
    a file of any size is many tasks.
    """
    lines = spark.read.option("lineSep", "\n").option("recursiveFileLookup", recursive).text([paths] if isinstance(paths, str) else list(paths))
    place = F.monotonically_increasing_id().bitwiseAND((1 << ROW_BITS) - 1)
    lines = lines.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
                         place.cast("decimal(12,0)").alias("place"), *[
        F.xxhash64(F.lit(salt), "value").bitwiseAND((1 << HASH_BITS) - 1).cast("decimal(15,0)").alias(f"h{salt}") for salt in (0, 1)])
    sums = lines.groupBy("file", "split").agg(
        F.count("*").alias("lines"), F.min("place").alias("first"),
        *[F.sum(f"h{k}").cast("decimal(38,0)").alias(f"b{k}") for k in (0, 1)],
        *[F.sum((F.col("place") * F.col(f"h{k}")).cast("decimal(27,0)")).cast("decimal(38,0)").alias(f"a{k}") for k in (0, 1)])
    before = F.coalesce(F.sum("lines").over(Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shift = (before - F.col("first") + 1).cast("decimal(12,0)")
    sums = sums.withColumn("shift", shift)
    whole = sums.groupBy("file").agg(
        F.sum("lines").alias("lines"), *[F.sum(f"b{k}").alias(f"b{k}") for k in (0, 1)],
        *[F.sum((F.col(f"a{k}") + (F.col("shift") * F.col(f"b{k}").cast("decimal(26,0)")).cast("decimal(38,0)")).cast("decimal(38,0)")).alias(f"a{k}")
          for k in (0, 1)])
    return whole.select("file", "lines", F.sha2(F.concat_ws(":", *[F.col(c).cast("string") for c in ("lines", "a0", "b0", "a1", "b1")]), 256).alias("digest"))


def new_contents(digests: DataFrame, ledger: DataFrame | None) -> DataFrame:
    """digest, file: the first file, by name, of each content that the ledger does not list."""
    first = digests.groupBy("digest").agg(F.min("file").alias("file"))
    return first if ledger is None else first.join(ledger.select("digest").distinct(), "digest", "left_anti")


def files_and_constants(df: DataFrame, columns: Sequence[str]) -> tuple[list[str], dict[str, str]]:
    """The files of a batch, and the text columns of ``columns`` that have one value in all its rows (none of them NULL)."""
    texts = [c for c in columns if c in df.columns and isinstance(df.schema[c].dataType, T.StringType)]
    # distinct rows first: they are hashed, while the ends of texts are sorted for
    ends = df.select("file", *texts).distinct().groupBy("file").agg(*[f(c).alias(f"{f.__name__}_{c}") for c in texts for f in (F.min, F.max)],
                                  *[F.count_if(F.col(c).isNull()).alias(f"nulls_{c}") for c in texts])
    found = (ends if texts else df.select("file").distinct()).collect()  # maxFilesPerTrigger bounds the files of a batch
    constant = {}
    for c in texts:
        values = {r[f"{end}_{c}"] for r in found for end in ("min", "max")}
        if len(values) == 1 and not any(r[f"nulls_{c}"] for r in found):
            constant[c] = values.pop()
    return [r["file"] for r in found], constant


def ingest_contents(stream: DataFrame, target: str, checkpoint: str, ledger: str, *, partition_by: Sequence[str] = ("run_date",),
                    change: Callable[[DataFrame], DataFrame] | None = None) -> int:
    """Append the rows of files whose content was never loaded; a file that is delivered again under another name adds none.

    ``stream`` has a column ``file``. The ledger is written after the rows, by batch: a batch that is repeated replaces its rows and
    its lines of the ledger, and does not count the latter as known. The rows of a batch of one day are written as they are read:
    no task holds or sorts them.
    """
    spark, write = stream.sparkSession, batch_writer(target, partition_by, change)

    def on_batch(df: DataFrame, batch_id: int) -> int:
        names, constant = files_and_constants(df, [] if change else partition_by)
        if not names:
            return 0
        known = read_table(spark, ledger, LEDGER)
        known = None if known is None else known.filter(F.col(BATCH) != batch_id)
        fresh = new_contents(file_digests(spark, names), known)
        replace_partitions(fresh, ledger + "-staged", [BATCH], constant={BATCH: batch_id})
        fresh = spark.read.schema(LEDGER).parquet(ledger + "-staged").filter(F.col(BATCH) == batch_id)
        rows = write(df.join(fresh.select("file"), "file", "left_semi"), batch_id, constant)
        replace_partitions(fresh.drop(BATCH), ledger, [BATCH], constant={BATCH: batch_id})
        return rows

    return run_available(stream, checkpoint, on_batch)
