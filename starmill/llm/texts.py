"""Shared helpers: whole texts in bounded Arrow batches, and tables kept in the shared work folder."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator, Sequence
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmill.session import work_folder

BATCH_BYTES = 4 << 20


PACKAGE = Path(__file__).resolve().parents[1]
_sent: set[str] = set()


def send_package(spark: SparkSession) -> None:
    """Let Spark hand this package's source to the executors, once for each application."""
    context = spark.sparkContext
    if context.applicationId in _sent:
        return
    archive = f"{tempfile.mkdtemp(prefix='starmill-source-')}/starmill.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(PACKAGE.rglob("*.py")):
            out.write(file, file.relative_to(PACKAGE.parent))
    context.addPyFile(archive)
    _sent.add(context.applicationId)


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    send_package(spark)
    return spark.read.parquet(f"{root}/{name}.parquet")


def documents(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "documents")


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the two columns an operator reads, under fixed names; other columns can't clash with them."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def by_bytes(batches: Iterable[pa.RecordBatch], column: str = "text",
             most: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in order, in slices of about ``most`` bytes of ``column``; a longer text is a slice of its own."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        start, total = 0, 0
        for at, size in enumerate(sizes.tolist()):
            if total and total + size > most:
                yield batch.slice(start, at - start)
                start, total = at, 0
            total += size
        if start < batch.num_rows:
            yield batch.slice(start)


def strings(column: pa.Array) -> list[str]:
    """Python strings; null is the empty text."""
    return ["" if x is None else x for x in column.to_pylist()]


def map_texts(frame: DataFrame, make: Callable[[pa.RecordBatch, list[str]], Sequence], schema: str,
              column: str = "text") -> DataFrame:
    """``make(batch, texts)`` gives the output columns of a bounded batch, in the order of ``schema``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, column):
            yield record(make(batch, strings(batch.column(column))), fields)

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    fields = to_arrow_schema(_parse_datatype_string(schema))
    return frame.mapInArrow(run, schema)


def record(columns: Sequence, fields: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c.cast(f.type) if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, fields, strict=True)],
        schema=fields)


def keep(frame: DataFrame, purpose: str) -> DataFrame:
    """``frame`` written to the shared work folder and read back: the lineage ends there."""
    spark = frame.sparkSession
    path = work_folder(spark, purpose)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)
