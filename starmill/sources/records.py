"""CSV files cut anywhere: many tasks for one file with line breaks in cells, and files with other headers in one frame.

A file is read as plain lines, in as many splits as Spark makes of it. A line with an odd number of quotes opens or closes a
cell that holds a line break; where such a line stands in its split is counted while it is read, how many came in the splits
before is a prefix sum over the splits of the file. So each line knows whether it begins inside a cell, and lines of one record,
also those of different splits, are put together by the number of the line that opened it. Lines that are a record by themselves,
mostly all, are neither shuffled nor grouped.

The numbered lines are written to the work folder once: all that follows (headers, splits, records) reads them there, so splits
can't differ between two reads of a file. Quotes stand around whole cells and are doubled inside, as ``sinks.files`` writes them;
lines end with LF or CR LF. A text without closing quote runs to the end of its file, as in any reader.
"""

from __future__ import annotations

import csv
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starmill.functions.names import normal_names
from starmill.operators.types import with_inferred_types
from starmill.session import work_folder

LINES = "file string, split bigint, line bigint, toggles bigint, odd boolean, text string"
PARSE = {"quote": '"', "escape": '"', "multiLine": "true"}
BOM = "\ufeff"


def numbered_lines(spark: SparkSession, paths: str | Sequence[str], *, split_bytes: int | None = None,
                   recursive: bool = False) -> DataFrame:
    """LINES: each line with its place in its split and the odd lines before it there, kept in the work folder.

    ``split_bytes`` is the largest split of a file, if it is not to be the session's.
    """
    session = spark if split_bytes is None else spark.newSession()
    if split_bytes is not None:
        session.conf.set("spark.sql.files.maxPartitionBytes", split_bytes)
        session.conf.set("spark.sql.files.openCostInBytes", min(split_bytes, 4 << 20))
    lines = session.read.option("lineSep", "\n").option("recursiveFileLookup", recursive).text(
        [paths] if isinstance(paths, str) else list(paths))
    lines = lines.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
                         F.col("value").alias("text"))
    path = work_folder(spark, "lines")
    lines.mapInArrow(_numbering(), LINES).write.parquet(path)
    return spark.read.schema(LINES).parquet(path)


def _numbering():
    """The function for tasks; it brings its own code along, so executors need no package."""

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, line, toggles = None, 0, 0
        for batch in batches:
            files, splits = batch.column("file").to_pylist(), batch.column("split").to_numpy()
            odd = pc.count_substring(pc.fill_null(batch.column("text"), ""), '"').to_numpy(zero_copy_only=False) % 2 == 1
            lines, before = np.zeros(len(odd), np.int64), np.zeros(len(odd), np.int64)
            edges = [k for k in range(len(files)) if k == 0 or splits[k] != splits[k - 1] or files[k] != files[k - 1]]
            for start, end in zip(edges, [*edges[1:], len(files)], strict=True):
                if (files[start], splits[start]) != place:
                    place, line, toggles = (files[start], splits[start]), 0, 0
                upto = np.cumsum(odd[start:end])
                lines[start:end] = line + np.arange(end - start)
                before[start:end] = toggles + upto - odd[start:end]
                line, toggles = line + end - start, toggles + int(upto[-1])
            yield pa.RecordBatch.from_arrays(
                [batch.column("file"), batch.column("split"), pa.array(lines), pa.array(before), pa.array(odd), batch.column("text")],
                names=["file", "split", "line", "toggles", "odd", "text"])

    return number


def records(lines: DataFrame) -> DataFrame:
    """file, split, line (of the first line), record: whole records, CR of the line end taken off, empty ones left out."""
    before = F.sum("n").over(Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1))
    splits = lines.filter("odd").groupBy("file", "split").agg(F.count("*").alias("n"))
    starts = lines.select("file", "split").distinct().join(splits, ["file", "split"], "left").fillna(0, ["n"])
    starts = starts.withColumn("before", F.coalesce(before, F.lit(0))).filter("before > 0").select("file", "split", "before")
    path = work_folder(lines.sparkSession, "splits")
    starts.write.parquet(path)  # a row for each split; its size is known when it is joined
    starts = lines.sparkSession.read.schema(starts.schema).parquet(path)

    placed = lines.join(starts, ["file", "split"], "left").withColumn("toggles", F.col("toggles") + F.coalesce("before", F.lit(0)))
    inside = F.col("toggles") % 2 == 1
    whole = placed.filter(~inside & ~F.col("odd")).select("file", "split", "line", F.col("text").alias("record"))
    parts = placed.filter(inside | F.col("odd")).groupBy("file", (F.col("toggles") - inside.cast("bigint")).alias("opener")).agg(
        F.sort_array(F.collect_list(F.struct("split", "line", "text"))).alias("parts"))
    joined = parts.select("file", F.col("parts")[0]["split"].alias("split"), F.col("parts")[0]["line"].alias("line"),
                          F.array_join(F.transform("parts", lambda p: p["text"]), "\n").alias("record"))
    every = whole.unionByName(joined).withColumn("record", F.regexp_replace("record", "\r$", ""))
    return every.filter("record <> ''")


def is_first(split: str = "split", line: str = "line") -> Column:
    """A file's header."""
    return (F.col(split) == 0) & (F.col(line) == 0)


def headers(rows: DataFrame) -> tuple[DataFrame, list[str]]:
    """file and header of each file, and the distinct headers, in the order of their first files.

    There are as few headers as a table had layouts; they become columns, so they have to come to the driver.
    """
    by_file = rows.filter(is_first()).select("file", F.ltrim("record", F.lit(BOM)).alias("header"))
    path = work_folder(rows.sparkSession, "headers")
    by_file.write.parquet(path)
    by_file = rows.sparkSession.read.schema("file string, header string").parquet(path)
    return by_file, [r[0] for r in by_file.groupBy("header").agg(F.min("file").alias("f")).orderBy("f").select("header").collect()]


def column_names(header: str) -> list[str]:
    return normal_names(next(csv.reader([header])))


def parsed(record: Column, names: Sequence[str], wanted: Sequence[str]) -> Column:
    """A struct of the ``wanted`` columns of a record whose cells have ``names``; a column it lacks is NULL."""
    quoted = ", ".join(f"`c{i}` string" for i in range(len(names)))
    cells = F.from_csv(record, quoted, PARSE)
    place = {name: i for i, name in enumerate(names)}
    return F.struct(*(cells[f"c{place[w]}"].alias(w) if w in place else F.lit(None).cast("string").alias(w) for w in wanted))


def read_chunks(spark: SparkSession, paths: str | Sequence[str], *, infer: bool = False, split_bytes: int | None = None,
                recursive: bool = False) -> DataFrame:
    """All rows of all files, whatever columns each file's header names, in whatever order.

    Columns meet by normalised name, in the order in which files bring them; one that a file lacks is NULL in its rows. All
    columns are text, or, with ``infer``, of the narrowest type that holds the values of all files. Files are cut anywhere
    (above), and all layouts are parsed in one pass over the records. Files without any line give nothing.
    """
    rows = records(numbered_lines(spark, paths, split_bytes=split_bytes, recursive=recursive))
    by_file, layouts = headers(rows)
    names = [column_names(h) for h in layouts]
    wanted = list(dict.fromkeys(n for layout in names for n in layout))
    if not wanted:
        return spark.range(0).select()
    cells = rows.filter(~is_first())
    if len(layouts) == 1:
        parts = cells.select(parsed(F.col("record"), names[0], wanted).alias("row"))
    else:
        each = [F.when(F.col("header") == header, parsed(F.col("record"), layout, wanted))
                for header, layout in zip(layouts, names, strict=True)]
        parts = cells.join(by_file, "file").select(F.coalesce(*each).alias("row"))
    out = parts.select("row.*")
    return with_inferred_types(out) if infer else out
