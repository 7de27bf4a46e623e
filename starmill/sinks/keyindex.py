"""Keyed appends to large tables: an index beside the table says which partitions may hold a key.

For each load and partition the index has a zone (range of the first key column) and a Bloom filter, kept as rows: a key falls into one
of ``2 ** size`` words of 64 bits and sets a few bits there. Building one is a grouping by word, asking many is a join on
(size, word); nothing of it passes through one task or the driver, and it takes about a quarter of the keys' own space. An append
asks the index, reads the keys of the partitions that may hold some, and joins them exactly, so a wrong "maybe" costs a read
and never a row. The index of a load is written before its rows: a load that fails in between leaves only such maybes behind.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmill.operators.dedup import latest_per_key
from starmill.session import work_folder
from starmill.sinks.files import new_rows, read_table, write_files

INDEX = "_keys"  # a folder that readers of the table skip
KEYS_PER_WORD = 4
SET_BITS = 4
ASKED_FIRST = 64  # one key in so many is asked first where a single hit settles it
LEAST_SIZE = 8  # so that small filters spread over tasks too


def _hashed(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``hash`` and ``mask``: where a key falls, and its bits there; integers of any width are alike."""
    plain = [F.col(k).cast("bigint") if isinstance(df.schema[k].dataType, T.IntegralType) else F.col(k) for k in keys]
    first, second = F.xxhash64(*plain, *(c.isNull() for c in plain)), F.xxhash64(F.lit("bits"), *plain)
    bits = [F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.shiftrightunsigned(second, 6 * i) % 64).cast("int")) for i in range(SET_BITS)]
    return df.withColumns({"hash": first, "mask": reduce(Column.bitwiseOR, bits)})


def _word(size: Column) -> Column:
    return F.col("hash").bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("bigint"), size) - 1)


def add_to_index(rows: DataFrame, path: str, keys: Sequence[str], partition_by: Sequence[str]) -> None:
    """Index the keys of ``rows`` as one load, whichever partitions they are for."""
    load = uuid.uuid4().hex
    parts = [F.col(c).alias(f"part_{c}") for c in partition_by]
    names = [f"part_{c}" for c in partition_by]
    keyed = _hashed(rows, keys).select(*parts, F.col(keys[0]).alias("key"), "hash", "mask")
    size = F.greatest(F.lit(LEAST_SIZE), F.ceil(F.log2(F.count("*") / KEYS_PER_WORD))).cast("int")
    zones = keyed.groupBy(*names).agg(size.alias("size"), F.min("key").alias("low"), F.max("key").alias("high"),
                                      (F.count("*") > F.count("key")).alias("nulls"), F.count("*").alias("keys"))
    stage = work_folder(rows.sparkSession, "zones")
    zones.filter("keys > 0").withColumn("load", F.lit(load)).write.parquet(stage)
    zones = rows.sparkSession.read.schema(zones.withColumn("load", F.lit(load)).schema).parquet(stage)
    same = reduce(Column.__and__, [keyed[n].eqNullSafe(zones[n]) for n in names], F.lit(True))
    sized = keyed.join(zones.select(*names, "size"), same).select(*[zones[n] for n in names], zones["size"], "hash", "mask")
    words = sized.groupBy(*names, "size", _word(F.col("size")).alias("word")).agg(F.bit_or("mask").alias("bits"))
    words.withColumn("load", F.lit(load)).write.mode("append").parquet(f"{path}/{INDEX}/words")
    zones.write.mode("append").parquet(f"{path}/{INDEX}/zones")


def partitions_to_read(batch: DataFrame, path: str, keys: Sequence[str], partition_by: Sequence[str]) -> list[tuple]:
    """Values of the partitions that may hold a key of ``batch``; the partitions of a table are as few as its folders."""
    spark, names = batch.sparkSession, [f"part_{c}" for c in partition_by]
    zones = spark.read.parquet(f"{path}/{INDEX}/zones")
    low, high, nulls = batch.agg(F.min(keys[0]), F.max(keys[0]), F.count_if(F.col(keys[0]).isNull()) > 0).first()
    ranges = F.lit(False) if low is None else (F.col("low") <= F.lit(high)) & (F.col("high") >= F.lit(low))
    zones = zones.filter(ranges | (F.col("nulls") & F.lit(bool(nulls))))
    sizes = [r[0] for r in zones.select("size").distinct().collect()]
    if not sizes:
        return []
    hashed = _hashed(batch, keys).select(F.col(keys[0]).alias("key"), "hash", "mask", F.explode(F.array(*map(F.lit, sizes))).alias("size"))
    hashed = hashed.withColumn("word", _word(F.col("size")))
    words = spark.read.parquet(f"{path}/{INDEX}/words").select("load", *names, "size", "word", "bits")
    same = reduce(Column.__and__, [words[n].eqNullSafe(zones[n]) for n in names], words["load"] == zones["load"])
    words = words.join(zones, same).select(words["size"], words["word"], words["bits"], *[zones[n] for n in names], "low", "high", "nulls")
    inside = F.coalesce(F.col("key").between(F.col("low"), F.col("high")), F.col("key").isNull() & F.col("nulls"))

    def hits(asked: DataFrame) -> DataFrame:
        return asked.join(words, ["size", "word"]).filter(inside & (F.col("bits").bitwiseAND(F.col("mask")) == F.col("mask")))

    if names:
        return [tuple(r) for r in hits(hashed).select(*names, F.lit(1).alias("one")).distinct().drop("one").collect()]
    # one hit settles it: a few keys are asked first, the others only if none of these hits
    few = F.pmod("hash", F.lit(ASKED_FIRST)) == 0
    return [()] if hits(hashed.filter(few)).head(1) or hits(hashed.filter(~few)).head(1) else []


def held_rows(spark: SparkSession, path: str, parts: Sequence[tuple], partition_by: Sequence[str]) -> DataFrame:
    """The rows of these partitions; only their folders are read."""
    df = read_table(spark, path)
    if len(partition_by) == 1:
        column, values = F.col(partition_by[0]), [p[0] for p in parts]
        known = column.isin([v for v in values if v is not None])
        return df.filter(known | column.isNull() if None in values else known)
    return df.filter(_any([reduce(Column.__and__, [F.col(c).eqNullSafe(F.lit(v)) for c, v in zip(partition_by, p, strict=True)], F.lit(True))
                           for p in parts]))


def _any(tests: Sequence[Column]) -> Column:
    """Joined by halves: thousands of tests are a tree a few levels deep."""
    if len(tests) < 2:
        return tests[0] if tests else F.lit(False)
    return _any(tests[:len(tests) // 2]) | _any(tests[len(tests) // 2:])


def build_index(spark: SparkSession, path: str, keys: Sequence[str], partition_by: Sequence[str]) -> None:
    """Index a table that has none, as one load."""
    add_to_index(read_table(spark, path), path, keys, partition_by)


def append_indexed(df: DataFrame, path: str, keys: Sequence[str], *, partition_by: Sequence[str] = (), unique: bool = False,
                   asked: DataFrame | None = None) -> int:
    """Append the rows whose key is new (``sinks.files.append_new``); of the table only partitions that may hold a key are read.

    All appends to a table have to come this way. A table without index gets one first. ``unique`` states that ``df`` has one row
    per key; ``asked`` has the same keys as ``df``, in any number, where they come at less cost than its rows. To a table that is
    there, the keys come first: rows are made and staged only if some key is new.
    """
    spark = df.sparkSession
    rows = df if unique else latest_per_key(df, keys)
    if read_table(spark, path) is None:  # a table that is written and not indexed is indexed by its next append
        added = write_files(rows, path, partition_by=partition_by, rebalance=bool(partition_by))
        add_to_index(spark.read.schema(df.schema).parquet(path), path, keys, partition_by)
        return added
    if read_table(spark, f"{path}/{INDEX}/zones") is None:
        build_index(spark, path, keys, partition_by)
    new = new_keys(df if asked is None else asked, path, keys, partition_by)
    if new is None:
        return 0
    stage = work_folder(spark, "append")
    rows.join(new, _same_key(rows, new, keys), "left_semi").write.parquet(stage)
    batch = spark.read.schema(df.schema).parquet(stage)
    add_to_index(batch, path, keys, partition_by)
    return write_files(batch, path, partition_by=partition_by, rebalance=bool(partition_by))


def _same_key(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> Column:
    return reduce(Column.__and__, [a[k].eqNullSafe(b[k]) for k in keys])


def new_keys(df: DataFrame, path: str, keys: Sequence[str], partition_by: Sequence[str]) -> DataFrame | None:
    """The keys of ``df`` that the table lacks, staged; None if it holds all. Nothing but keys is shuffled."""
    spark, stage = df.sparkSession, work_folder(df.sparkSession, "append-keys")
    df.select(*keys).distinct().write.parquet(f"{stage}/asked")
    asked = spark.read.schema(df.select(*keys).schema).parquet(f"{stage}/asked")
    parts = partitions_to_read(asked, path, keys, partition_by)
    if not parts:
        return asked if asked.head(1) else None
    held = held_rows(spark, path, parts, partition_by).select(*keys)
    asked.join(held, _same_key(asked, held, keys), "left_anti").write.parquet(f"{stage}/new")
    new = spark.read.schema(asked.schema).parquet(f"{stage}/new")
    return new if new.head(1) else None
